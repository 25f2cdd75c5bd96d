import re

import pytest
from pyspark.sql import functions as F

from sonotheca.llm import url_filter as U


def rule(url):
    """(host, path, rule, verdict) by hand."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


URLS = [
    "http://a.com/x", "https://EXAMPLE.com/en/1?q=/es/", "http://www.example.com/en/2", "http://x.www.example.com/en/", "http://com/",
    "http://telecom/x", "http://a.net/es/1", "http://a.net/fr/#/es/", "http://a.net/de/", "http://a.org/en/", "ftp://h", "http://a.com?x=1/",
    "no scheme.com/", "", None, "http://", "://x.com/y", "http://a.com/é/日本#f", "http://a.com/#://b", "http://badexample.com/en/1",
    "http://Éa.NET/ES/", "a://b://c.com/d",
]


def test_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id BIGINT, url STRING").withColumn("html", F.lit(None).cast("string"))
    rows = {r["id"]: r for r in U.judged(df.withColumn("host", F.lit(1)).withColumn("score", F.lit(2))).collect()}
    assert len(rows) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, name, verdict = rule(url)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, name), url
        assert rows[i]["verdict"] == verdict if verdict else rows[i]["verdict"] in ("allow", "block")


def test_names_are_split_into_known_words(spark):
    html = "<html><body class='x'>best online casino games, free news and the weather; play the best games online</body></html>"
    hosts = ["bestonlinecasino.org", "freenews-weather.org", "xqzplaygames.com", "casino.org", "", "é.org"]
    df = spark.createDataFrame([(i, f"http://{h}/", html) for i, h in enumerate(hosts)], "page_id BIGINT, url STRING, html STRING")
    words = {r["host"]: r["words"] for r in U.judged(df).collect()}
    assert words["bestonlinecasino.org"][:3] == ["best", "online", "casino"]
    assert words["freenews-weather.org"][:3] == ["free", "news", "weather"]
    assert words["xqzplaygames.com"][1:3] == ["play", "games"]
    assert all("".join(w) == re.sub(r"[^a-z0-9é]", "", h) for h, w in words.items() if w)


def test_viterbi_is_optimal():
    known = {"the": 50, "rest": 10, "there": 5, "st": 7, "t": 3, "he": 20}
    from itertools import combinations
    from math import log
    total = 200
    cost = lambda p: log(total) - log(known[p]) if p in known else log(total) + len(p) * log(10)
    for label in ("therest", "thethe", "xthe", "therestt"):
        cuts = range(1, len(label))
        splits = [[label[a:b] for a, b in zip((0, *c), (*c, len(label)))] for n in range(len(label)) for c in combinations(cuts, n)]
        assert sum(map(cost, U.viterbi(label, known, total))) == pytest.approx(min(sum(map(cost, s)) for s in splits))
    assert "".join(U.viterbi("a" * 5000, {}, 10)) == "a" * 5000 and U.viterbi("", {}, 10) == []


def test_bayes_learns_from_the_rules(spark):
    rows = [(i, f"http://{name}{i}.com/blog/post-{i}", None) for i, name in enumerate(["garden", "news"] * 20)]
    rows += [(100 + i, f"http://casino{i}.net/fr/bet/{i}", None) for i in range(40)]
    rows += [(500, "http://casino.org/bet/9", None), (501, "http://garden.org/blog/post-9", None), (500, "http://casino.org/bet/9", None)]
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    found = U.judged(df).where("id >= 500").collect()
    assert sorted((r["id"], r["verdict"]) for r in found) == [(500, "block"), (500, "block"), (501, "allow")]


def test_without_training_rows(spark):
    df = spark.createDataFrame([(1, "http://a.org/", "x"), (None, None, None)], "page_id BIGINT, url STRING, html STRING")
    assert {r["verdict"] for r in U.judged(df).collect()} == {"allow"}
    only = spark.createDataFrame([(1, "http://a.org/", "x"), (2, "http://b.net/es/", "x")], "page_id BIGINT, url STRING, html STRING")
    assert {r["verdict"] for r in U.judged(only).collect()} == {"block"}
    assert U.judged(df.limit(0)).count() == 0

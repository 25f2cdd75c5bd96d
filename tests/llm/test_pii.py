import random
import re

import pytest
from pyspark.sql import functions as F

from sonotheca.llm import pii as P


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


ODD = [
    "a@b.c_x@d.e a@b c@d. .@-.- x@y.z@w.v a@@b.c", "é a.b@c.d 日本 x@y.zé", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 1.2.3.4 00000000000000000000001.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111 411111111111111", "+1 (736) 555-2678 +1 2 +49.30.123456-78. ++1 23456789 +1+23456789012",
    "", "+", "@", "1", "." * 50, "1-" * 30, "𝒳 a@b.cd 𝒳 1.1.1.1", "a@b.c\na@b.c\u00a0+4912345678901 x", "1.2.3", "99999999999999999999.1.1.1",
]


def spans_of(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    rows = df.select("text", P.base_spans(F.col("text")).alias("s")).collect()
    return [(r["text"], [tuple(s) for s in r["s"]]) for r in rows]


def test_base_spans_on_odd_texts(spark):
    for text, spans in spans_of(spark, ODD):
        assert spans == base(text), text


def test_base_spans_on_random_texts(spark):
    rnd = random.Random(5)
    pieces = ["a", "@", ".", "b-c", "1", "22", "255", "256", ".", "-", " ", "+", "(", ")", "4111111111111111", "%", "_", "é", "\n"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 60))) for _ in range(1500)]
    for text, spans in spans_of(spark, texts):
        assert spans == base(text), text


@pytest.mark.parametrize("unit,n", [("a", 100_000), ("a.", 50_000), ("1.", 50_000), ("1 ", 50_000), ("a@b.c ", 20_000), ("@", 100_000), ("+1 ", 40_000)])
def test_very_long_texts(spark, unit, n):
    (text, spans), = spans_of(spark, [unit * n])
    assert spans == base(text)


def documents():
    rnd = random.Random(7)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))

    def card():
        body = digits(15)
        return body + next(c for c in "0123456789" if luhn(body + c))

    rows = []
    for i in range(400):
        kind = i % 4
        thing = [f"user{i}@mail{i}.example.com", ".".join(str(rnd.randrange(256)) for _ in range(4)), card(),
                 f"+1 ({digits(3)}) 555-{digits(4)}"][kind]
        rows.append((i, f"some plain words {thing} and more words"))
    rows += [(1000 + i, f"plain words {digits(16)} and more words") for i in range(200)]
    rows += [(2000, "some plain words (736) 555-2678 and more words"), (2001, "some words user [at] mail9 (dot) example (dot) com end"),
             (2002, "born in 1999 at 10:30 with 12 of 345"), (2003, None), (None, "x a@b.cd"), (5000, "again a@b.cd"), (5000, "again a@b.cd")]
    return rows


def test_spans_keep_the_base_and_add_few(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("base", F.lit(1)).withColumn("held", F.lit(2))
    got = P.personal_data(df).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t)
    added = {}
    for r in got:
        own = [tuple(s) for s in r["base"]]
        assert own == base(texts[r["id"]] or "")
        every = [tuple(s) for s in r["spans"]]
        assert every == sorted(set(every)) and set(own) <= set(every)
        if set(every) - set(own):
            added[r["id"]] = [texts[r["id"]][a:b] for a, _, b in sorted(set(every) - set(own))]
    assert added.pop(2000) == ["(736) 555-2678"] and added.pop(2001)[0].startswith("user [at]")
    assert not added  # numbers that fail the check digit, and plain numbers, stay


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert P.personal_data(df).count() == 0


def test_trees_and_threshold():
    cells = [((d, 0, 0, 0, 0, 0, c), 40.0 * c * (d > 5), 40.0) for d in range(10) for c in (0, 1)]
    model = P.fit_trees(cells)
    assert all((P.score(model, f) > 0) == (good > 0) for f, good, _ in cells)
    limit = P.threshold(model, cells)
    assert all((P.score(model, f) >= limit) == (good > 0) for f, good, _ in cells)
    assert P.threshold(model, [(f, 0.0, n) for f, _, n in cells]) == float("inf")


def test_redaction(spark):
    df = spark.createDataFrame([("x a@b.cd, +1 234 567 890 end",), ("none",)], "text STRING")
    rows = df.select(P.redacted(F.col("text"), P.base_spans(F.col("text"))).alias("t")).collect()
    assert [r["t"] for r in rows] == ["x [redacted], [redacted] end", "none"]


def test_plan_is_native(spark, plan_of):
    df = spark.createDataFrame([(1, "a@b.cd")], "doc_id BIGINT, text STRING")
    assert "Python" not in plan_of(P.personal_data(df)) and "Arrow" not in plan_of(P.personal_data(df))


def test_a_candidate_yields_only_to_one_that_is_kept(spark):
    chain = [(0.2, 18, 30), (0.9, 0, 10), (0.5, 8, 20), (0.1, 40, 50), (0.1, 45, 60)]
    df = spark.createDataFrame([(chain,), ([],)], "c ARRAY<STRUCT<score: DOUBLE, start: INT, end: INT>>")
    got = [[tuple(c) for c in r["kept"]] for r in df.select(P._apart(F.col("c")).alias("kept")).collect()]
    assert got == [[(0.9, 0, 10), (0.2, 18, 30), (0.1, 45, 60)], []]

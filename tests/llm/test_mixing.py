import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sonotheca.llm import mixing as M


def test_permutation_is_a_bijection_for_any_size(spark):
    for n in (1, 2, 3, 10, 257):
        got = spark.range(n).select(M.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(9)).alias("x")).collect()
        assert sorted(r["x"] for r in got) == list(range(n))


def test_word_counts(spark):
    texts = ["", None, " ", "a", " a\tb\nc\u000bd\u000ce\rf ", "é x y", "日本 語"]
    rows = spark.createDataFrame([(t,) for t in texts], "text STRING").select("text", M.n_words(F.col("text")).alias("n")).collect()
    assert [r["n"] for r in rows] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def water(sizes, total=1.5, most=2):
    """Targets by repeated resharing over sources in order, weights 5, 2, 1 repeating."""
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    share, capped = {}, set()
    while True:
        left = total * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        open_ = sum(w for s, w in weight.items() if s not in capped)
        share = {s: most * sizes[s] if s in capped else left * weight[s] / open_ for s in sizes}
        over = {s for s in sizes if share[s] > most * sizes[s]}
        if not over:
            return share
        capped |= over


def documents(seed=1, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        source = rnd.choice(["a", "a", "a", "B", "é", "z", None])
        rows.append((i, " ".join(f"w{i}_{j}" for j in range(rnd.choice([0, 1, 5, 63, 64, 65, 200]))), source))
    rows += [(3, "again words", "a"), (3, "again words", "a"), (None, "no id here", "a"), (5, None, "z"), (6, "", None),
             (7, " ".join(f"long{j}" for j in range(30_000)), "z")]
    return rows


def test_mix_against_plain_rules(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING").withColumn("size", F.lit("x")).withColumn("place", F.lit(1))
    mix = M.Mix(docs)
    got = mix.taken().collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want, taken = water(sizes), defaultdict(int)
    own = Counter((i, len((t or "").split()), sizes[s]) for i, t, s in rows)
    assert own == Counter((r["id"], r["size"], r["source_size"]) for r in got)
    source_of = {v: k for k, v in sizes.items()}
    for r in got:
        s = source_of[r["source_size"]]
        assert r["target"] == pytest.approx(want[s]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.05 * want[s], 3 * M.BLOCK)
    again = M.Mix(docs.repartition(7)).taken().collect()
    key = lambda r: str(r)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_blocks_hold_what_taken_counts(spark):
    rows = [r for r in documents(2, 150) if r[0] is not None and r[0] not in (3, 5, 6, 7)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    mix = M.Mix(docs, shard=16)
    blocks = mix.blocks().collect()
    words = Counter(w for b in blocks for w in b["text"].split())
    taken = {r["id"]: r["taken"] for r in mix.taken().collect()}
    for i, text, _ in rows:
        assert sum(words[w] for w in text.split()) == taken[i]
    assert all(len(b["text"].split()) <= M.BLOCK for b in blocks)
    full = sum(len(b["text"].split()) == M.BLOCK for b in blocks)
    assert full > 0.9 * len(blocks)
    shards = Counter(b["out_shard"] for b in blocks)
    assert len(shards) > 3 and max(shards.values()) < 40


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (None, None, "b")]])
def test_nothing_to_mix(spark, rows):
    mix = M.Mix(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING"))
    assert [(r["taken"], r["target"]) for r in mix.taken().collect()] == [(0, 0.0)] * len(rows)
    assert mix.blocks().count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_a_tiny_source_beside_a_huge_one_keeps_its_share(spark, seed):
    rows = [(0, " ".join(["z"] * 3 * M.BLOCK), "z")] + [(i, " ".join(["a"] * M.BLOCK), "a") for i in range(1, 202)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    # 20 shards of 15 slots of the one and 0.3 of the other
    slots = M.Mix(docs, shard=16, seed=seed).slots.collect()
    assert Counter(r["place"] for r in slots) == {0: 300, 1: 6}
    assert len({r["out_shard"] for r in slots if r["place"] == 1}) > 1 and {r["out_shard"] for r in slots} == set(range(20))
    assert len({(r["place"], r["nth"]) for r in slots}) == 306

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from sonotheca.llm import merkle, queries
from sonotheca.session import written

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row, more=0):
    doc_id, text, lang, source, n_chars = row
    n_chars = None if n_chars is None else n_chars + more
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(hashes):
    """Levels of a tree from its leaves to its root."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return levels


def proof(levels, at):
    """Siblings of a leaf as (left, right), bottom to top."""
    out = []
    for level in levels[:-1]:
        pair = level[at - at % 2:at - at % 2 + 2]
        out.append((pair[0] if at % 2 else "", pair[1] if at % 2 == 0 and len(pair) > 1 else ""))
        at //= 2
    return out


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for group in order:
        ranked = sorted(((r[0] is not None, r[0] or 0, leaf_of(r), r) for r in groups[group]), key=lambda x: x[:3])
        trees[group] = [r for *_, r in ranked], climb([leaf for _, _, leaf, _ in ranked])
    top = climb([trees[g][1][-1][0] for g in order])
    out = []
    for at, group in enumerate(order):
        members, levels = trees[group]
        for i, row in enumerate(members):
            steps = proof(levels, i) + proof(top, at)
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf_of(row, 1 if changed else 0)
            for left, right in steps:
                node = sha(left, node, right)
            out.append((row[0], levels[0][i], levels[-1][0], top[-1][0], sha(*(a + b for a, b in steps)), node, node == top[-1][0]))
    return sorted(out, key=repr)


def made(seed, n):
    rnd = random.Random(seed)
    langs = [None, "", "en", "en", "en", "é", "zz"]
    rows = [(i, rnd.choice([None, "", "x" * i, "日本 ü"]), rnd.choice(langs), rnd.choice([None, "s"]), rnd.choice([None, i])) for i in range(n)]
    return rows + [(None, "no id", "en", None, 1), (4, "again", "en", "s", 5), (4, "again", "en", "s", 5), (5, "y" * 300_000, "lone", "s", 6)]


def via_query(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("tree", "rank", "n", "hash", "payload", "grp", "steps", "node", "leaf", "changed"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in queries.op13_merkle(spark, str(tmp_path)).collect()), key=repr)


def test_query_against_plain_trees(spark, tmp_path):
    rows = made(1, 300)
    assert via_query(spark, rows, tmp_path) == brute(rows)


def test_one_row_and_no_rows(spark, tmp_path):
    one = [(7, "t", "en", "s", 1)]
    assert via_query(spark, one, tmp_path / "one") == brute(one)
    assert brute(one)[0][4] == sha("")
    assert via_query(spark, [], tmp_path / "none") == []


def test_several_storeys_and_any_size(spark):
    for n in (3, 17, 70):
        rows = [(i, f"t{i}", "g" if i % 3 else None, None, i) for i in range(n)]
        given = spark.createDataFrame([(r[2], r[0], leaf_of(r)) for r in rows], "grp STRING, id BIGINT, leaf STRING")
        found = merkle.manifest(given, ["id"], levels=2).withColumn("proof", merkle.proof_hash(F.col("steps"))) \
            .withColumn("up", merkle.folded(F.col("leaf"), F.col("steps"))).collect()
        want = {r[0]: r for r in brute(rows)}
        assert {r["id"]: (r["leaf"], r["subroot"], r["root"], r["proof"]) for r in found} == {i: w[1:5] for i, w in want.items()}
        assert all(r["up"] == r["root"] for r in found)


def test_grouping_the_digits_away_needs_one_shuffle(spark, plan_of):
    nodes = spark.range(1000).select(F.lit("t").alias("tree"), F.col("id").alias("rank"), F.lit(1000).cast("bigint").alias("n"),
                                     F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("hash"), F.struct("id").alias("payload"))
    assert plan_of(merkle.blocks(written(nodes, "nodes"), 4)).count("Exchange hashpartitioning") == 1

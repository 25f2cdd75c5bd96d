import random

import xxhash
from pyspark.sql import functions as F

from sonotheca.llm import simhash as S
from sonotheca.llm.components import components


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lowered).split(" ") if x]
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows, radius=2):
    """Smallest id reachable, by all pairs."""
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return prints, [least.get(find(i)) for i in range(len(rows))]


def some_rows():
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünit", "A b"]
    rows = []
    for k in range(40):
        text = [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 200))]
        rows.append((100 - k, " ".join(text)))
        for c in range(rnd.choice([0, 0, 1, 4])):
            copy = list(text)
            copy[rnd.randrange(len(copy))] = "x"
            rows.append((200 + 10 * k + c, "\n ".join(copy)))
    rows += [(5, None), (3, ""), (None, " \t"), (7, "one"), (8, "ONE"), (9, "one two"), (None, rows[0][1]), rows[1], rows[1]]
    return rows


def test_agrees_with_brute_force(spark):
    rows = some_rows()
    prints, least = classes(rows)
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("fp", F.lit(1)).withColumn("id", F.lit("z"))
    got = sorted((r["id"] is None, r["id"] or 0, r["fp"] & (1 << 64) - 1, r["component"]) for r in S.near_duplicates(df).collect())
    assert got == sorted((k is None, k or 0, p, c) for (k, _), p, c in zip(rows, prints, least))


def test_small_shards_give_the_same_links(spark):
    rnd = random.Random(6)
    codes = {0, (1 << 64) - 1}
    for _ in range(4):
        centre = rnd.getrandbits(64)
        for _ in range(60):
            codes.add(centre ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64))
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fp BIGINT")

    def groups(edges):
        out = {}
        for r in components(edges).collect():
            out.setdefault(r["root"], set()).add(r["node"])
        return {frozenset(g) for g in out.values()}

    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    want = {}
    for c, s in zip(codes, signed):
        want.setdefault(find(c), set()).add(s)
    want = {frozenset(g) for g in want.values() if len(g) > 1}
    assert groups(S.links(df, 2, 4096)) == want
    assert groups(S.links(df, 2, 8)) == want  # several levels of cuts


def test_tree_search_is_complete():
    rnd = random.Random(2)
    tree, codes = S.BKTree(), [rnd.getrandbits(12) for _ in range(300)]
    for c in codes:
        tree.add(c)
    query = rnd.getrandbits(12)
    assert {tree.codes[i] for i in tree.within(query, 2)} == {c for c in codes if (c ^ query).bit_count() <= 2}


def test_one_row_of_each_group_stays(spark):
    rows = some_rows()
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("root", F.lit(1))
    _, least = classes(rows)
    kept = S.deduplicated(df)
    assert kept.columns == df.columns
    got = sorted((r["doc_id"] for r in kept.collect()))
    assert got == sorted(set(least))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert S.near_duplicates(empty).count() == 0 and S.deduplicated(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(50)}}


def test_very_long_text():
    text = " ".join(f"w{i % 5000}" for i in range(60_000))
    assert S.fingerprint(text.encode()) == fingerprint(text)

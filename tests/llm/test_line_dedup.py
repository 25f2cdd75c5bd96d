import random
import re

import pytest
from pyspark.sql import functions as F

from sonotheca.llm import line_dedup as L


def split(text):
    return re.split(r"(?<=\n)|(?<=[.!?][ \t])", text)


def n_words(unit):
    bare = re.sub(r"[\t\n\x0b\x0c\r]", " ", unit).strip(" ")
    return bare.count(" ") + 1 if bare else 0


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("k", F.lit(1)).withColumn("runs", F.lit(2))
    out = L.without_repeats(df, **options)
    assert out.columns[:4] == df.columns
    return out.collect()


def sentences(rnd, n, tag):
    return [" ".join(f"{tag}{rnd.randrange(10 ** 6)}" for _ in range(rnd.randint(1, 14))) + ". " for _ in range(n)]


def test_units_join_to_the_text(spark):
    texts = ["", "a", "a.\nb. c", "\n\n", "x. ", "one.  two\t!", "é. 日本. ", "no end"]
    rows = spark.createDataFrame([(t,) for t in texts], "text STRING").select("text", L.units(F.col("text")).alias("u")).collect()
    assert all("".join(r["u"]) == r["text"] and r["u"] == split(r["text"]) for r in rows)


def test_passages_go_and_the_first_stays(spark):
    rnd = random.Random(8)
    passages = [sentences(rnd, 8, f"p{i}_") for i in range(3)]
    passages.append([" ".join(f"long{i}" for i in range(60)) + ".\n"])
    rows, want = [], {}
    seen = set()
    for d in range(40):
        parts, kept = [], []
        for s in range(4):
            own = sentences(rnd, 3, f"d{d}_{s}_")
            parts += own
            kept += own
            if rnd.random() < 0.6:
                p = rnd.randrange(len(passages))
                parts += passages[p]
                if p not in seen:
                    kept += passages[p]
                seen.add(p)
        rows.append((d, "".join(parts)))
        want[d] = "".join(kept)
    shuffled = list(rows)
    rnd.shuffle(shuffled)
    got = {r["doc_id"]: r for r in run(spark, shuffled)}
    for d, text in rows:
        assert got[d]["text"] == want[d]
        assert got[d]["_units"] == len(split(text))
        assert got[d]["_deleted"] == len(split(text)) - len(split(want[d]))


def test_short_and_chance_repeats_stay(spark):
    rows = [(i, f"Yes. No. Licensed under the same terms.\nSome unique words {i} {i * 7} here follow.\nOk.") for i in range(30)]
    assert all(r["text"] == t and r["_deleted"] == 0 for r, (_, t) in zip(sorted(run(spark, rows), key=lambda r: r["doc_id"]), rows))


def test_repeats_inside_one_document(spark):
    line = "these same words come again and again in one text.\n"
    (r,) = run(spark, [(1, line * 500)])
    assert r["text"] == line and r["_deleted"] == 499  # the split leaves an empty last unit


def test_copies_ties_and_odd_rows(spark):
    text = "".join(sentences(random.Random(1), 12, "c"))
    rows = [(5, text), (3, text), (9, text), (None, text), (3, text), (4, None), (6, ""), (7, "  \n \n"), (None, None)]
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in run(spark, rows)), key=str)
    assert got == sorted([(False, 5, ""), (False, 3, text), (False, 9, ""), (True, 0, ""), (False, 3, text), (False, 4, None),
                          (False, 6, ""), (False, 7, "  \n \n"), (True, 0, None)], key=str)
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    kept = L.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [3, 3, 4, 6, 7, None]))


def test_rows_with_one_id_and_different_texts(spark):
    rnd = random.Random(2)
    shared, a, b = sentences(rnd, 6, "s"), sentences(rnd, 4, "a"), sentences(rnd, 4, "b")
    texts = ["".join(a + shared), "".join(b + shared)]
    kept = {tuple(sorted([texts[0], "".join(b)])), tuple(sorted([texts[1], "".join(a)]))}  # the order of the texts' hashes decides
    assert tuple(sorted(r["text"] for r in run(spark, [(1, t) for t in texts]))) in kept


def test_long_text(spark):
    rnd = random.Random(3)
    text = "".join(sentences(rnd, 20_000, "w"))
    got = {r["doc_id"]: r for r in run(spark, [(1, text), (2, "A few own words come first here. " + text)])}
    assert got[1]["_deleted"] == 0 and got[2]["text"].strip() == "A few own words come first here."


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "")]])
def test_nothing_to_do(spark, rows):
    assert [r["_deleted"] for r in run(spark, rows)] == [0] * len(rows)


def first_kept(rows, least=20):
    """By brute force: the texts without units in a run of ``least`` words or more that came before."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        parts = split(text)
        real = [i for i, u in enumerate(parts) if n_words(u)]
        bare = [re.sub(r"[\t\n\x0b\x0c\r]", " ", parts[i]).strip(" ") for i in real]
        gone = set()
        for a in range(len(real)):
            for b in range(a + 1, min(a + least, len(real)) + 1):
                if sum(n_words(u) for u in bare[a:b]) >= least:
                    run = tuple(bare[a:b])
                    if run in seen:
                        gone.update(range(real[a], real[b - 1] + 1))
                    seen.add(run)
        out[d] = "".join(u for i, u in enumerate(parts) if i not in gone)
    return out


def test_a_run_finds_the_place_that_holds_all_of_it(spark):
    s1, s2, s3 = (" ".join(f"{tag}{i}" for i in range(18)) + ". " for tag in "abc")
    for alone in (s1, s2, s3):
        rows = [(1, f"One. {alone}Here."), (2, f"Two. {s1}{s2}{s3}There."), (3, f"Three. {alone}And. {s1}{s2}{s3}Then.")]
        got = {r["doc_id"]: r["text"] for r in run(spark, rows)}
        assert got == {**dict(rows), 3: f"Three. {alone}And. Then."} == first_kept(rows)


def test_against_brute_force(spark):
    rnd = random.Random(11)
    pool = [" ".join(f"u{j}w{i}" for i in range(rnd.choice([1, 2, 5, 9, 13, 21]))) + rnd.choice([". ", ".\n", "\n", "!\t"]) for j in range(25)]
    rows = [(d, "".join(rnd.choice(["\n", "own. ", *pool * 2]) if rnd.random() < 0.5 else "".join(pool[a:a + rnd.randint(1, 6)])
                        for a in (rnd.randrange(25) for _ in range(12)))) for d in range(40)]
    got = {r["doc_id"]: r["text"] for r in run(spark, rows)}
    assert got == first_kept(rows) and got != dict(rows)


def test_tabs_and_carriage_returns_count_as_spaces(spark):
    rnd = random.Random(5)
    lines = [" ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(9)) for _ in range(6)]
    table = "".join("\t".join(f"cell{i}{j}" for j in range(8)) + "\n" for i in range(4))
    rows = [(1, "\n".join(lines) + "\n" + table + "own end."), (2, "Own start.\r\n" + "\r\n".join(lines) + "\r\nOwn end.\r\n"),
            (3, "Start.\n" + "".join(f"\t\x0b{line}\x0c\n" for line in lines) + "End."), (4, f"Start.\n{table}End.")]
    got = {r["doc_id"]: r for r in run(spark, rows)}
    assert [got[d]["text"] for d in (1, 2, 3, 4)] == [rows[0][1], "Own start.\r\nOwn end.\r\n", "Start.\nEnd.", "Start.\nEnd."]
    assert all(r["_units"] == len(split(dict(rows)[d])) for d, r in got.items())


def test_few_units_are_selected_and_every_window_holds_one(spark):
    rnd = random.Random(9)
    for size in (1, 3, 8):
        units = [" ".join(f"v{rnd.randrange(10 ** 6)}" for _ in range(rnd.randint(1, size))) + "\n" for _ in range(400)]
        rows = spark.createDataFrame([(1, "".join(units))], "doc_id BIGINT, text STRING")
        (r,) = L._hashed(rows, "doc_id", "text", 20).collect()
        words, hashes, picks = r["v"]["w"], r["v"]["h"], set(r["picks"])
        assert words == [n_words(u) for u in units] and len(picks) < len(units) * (0.4 + size / 30)
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                if sum(words[i:j]) >= 20:
                    assert min(range(i, j), key=lambda x: (hashes[x], x)) in picks
                    break


def test_runs_are_found_by_steps_alone(spark, plan_of):
    rnd = random.Random(13)
    rows = [([],), ([1] * 50,), ([25],), ([3, 30, 1],)] + [([rnd.choice([1, 1, 2, 9, 40]) for _ in range(rnd.randint(1, 60))],) for _ in range(30)]
    df = spark.createDataFrame(rows, "w ARRAY<INT>")
    for least in (1, 5, 20, 40):  # the last one is beyond the steps
        found = df.select("w", L._reaches(F.col("w"), least).alias("r"))
        assert ("aggregate" in plan_of(found)) == (least > 32)
        for w, r in found.collect():
            assert r == [next((j for j in range(i + 1, len(w) + 1) if sum(w[i:j]) >= least), None) for i in range(len(w))]


def test_texts_of_short_and_equal_units_against_brute_force(spark):
    rnd = random.Random(12)
    pool = ["a\n", "b c\n", "d\n", " ".join(f"x{i}" for i in range(25)) + "\n", "e f g. ", " ".join(f"y{i}" for i in range(12)) + "\n"]
    rows = [(d, "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 30)))) for d in range(60)]
    got = {r["doc_id"]: r["text"] for r in run(spark, rows)}
    assert got == first_kept(rows)


def test_ends_are_found_without_slices_and_windows_are_whole(spark, plan_of):
    rnd = random.Random(14)
    rows = []
    for n in [1, 2, 7, *[60] * 12]:
        words = [rnd.choice([1, 2, 6, 11, 25]) for _ in range(n)]
        rows.append(([rnd.randrange(-9, 9) for _ in words], words, [3 * i for i in range(n)], rnd.sample(range(n), rnd.randint(1, n))))
    df = spark.createDataFrame(rows, "h ARRAY<BIGINT>, w ARRAY<INT>, at ARRAY<INT>, shared ARRAY<INT>")
    assert "slice(" not in plan_of(df.select(L._reaches(F.col("w"), 20)))
    v = F.struct("h", "w", "at")
    got = df.select("h", "w", "shared", L._extended(v, F.col("shared"), 20).alias("r")).collect()
    want = {}
    for t, (h, w, at, shared) in enumerate(rows):
        ends = [next((j for j in range(i + 1, len(w) + 1) if sum(w[i:j]) >= 20), None) for i in range(len(w))] + [None]
        for i, e in enumerate(ends):
            last = e and max(e, (ends[i + 1] or len(w) + 1) - 1)
            if e and (len(shared) * 2 >= len(w) or set(shared) & set(range(i, last))):
                want.update({(t, at[i], at[j - 1] + 1): h[i:j] for j in range(e, last + 1)})
    found = {(t, x["start"], x["end"]): x["h"] for t, r in enumerate(got) for x in r["r"]}
    hashes = spark.createDataFrame([(*k, x) for k, x in want.items()], "t INT, a INT, b INT, h ARRAY<BIGINT>").select("t", "a", "b", F.xxhash64("h")).collect()
    assert found == {(t, a, b): x for t, a, b, x in hashes} and max(map(len, want.values())) > L._NEAR

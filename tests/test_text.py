import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sonotheca.functions import text as tx


def packed(text, size, overlap):
    """Brute force: apply the packing rules to the list of sentences."""
    sentences = re.split(r"(?<=[.!?]) +", text)
    first, out = 0, []
    for i in range(1, len(sentences)):
        if sum(map(len, sentences[first : i + 1])) > size and i > first:
            out.append(sentences[first:i])
            while first < i and sum(map(len, sentences[first:i])) >= overlap:
                first += 1
    out.append(sentences[first:])
    return [" ".join(c) for c in out]


def spark_chunks(spark, texts, size, overlap):
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
    rows = df.select("i", tx.chunk_text("text", size, overlap).alias("c")).collect()
    return [list(r.c) for r in sorted(rows, key=lambda r: r.i)]


def sentence(n):
    return "x" * (n - 1) + "."


EDGES = {
    "exactly 1000": " ".join([sentence(500), sentence(500), sentence(10)]),
    "exactly 1001": " ".join([sentence(500), sentence(501), sentence(10)]),
    "tail of 99": " ".join([sentence(901), sentence(99), sentence(50)]),
    "tail of 100": " ".join([sentence(900), sentence(100), sentence(50)]),
    "one long sentence": sentence(5000),
    "long after short": " ".join([sentence(20), sentence(5000), sentence(20)]),
    "many tiny": " ".join(["."] * 3000),
    "several spaces": "One.   Two!  Three?    Four",
    "newline does not split": "One.\nTwo. Three.\tFour",
    "trailing break": "One. Two. ",
    "no end": "word " * 400,
    "empty": "",
    "only spaces": "   ",
}


@pytest.mark.parametrize("size,overlap", [(1000, 100), (50, 10), (50, 200), (1, 0)])
def test_chunks_of_edge_texts(spark, size, overlap):
    texts = list(EDGES.values())
    for name, got, text in zip(EDGES, spark_chunks(spark, texts, size, overlap), texts):
        assert got == packed(text, size, overlap), name


def test_chunk_edges_by_hand(spark):
    got = dict(zip(EDGES, spark_chunks(spark, list(EDGES.values()), 1000, 100)))
    assert len(got["exactly 1000"]) == 2  # 1000 fits, the third sentence does not
    assert len(got["exactly 1001"]) == 2 and got["exactly 1001"][0] == sentence(500)
    assert got["tail of 99"][1] == f"{sentence(99)} {sentence(50)}"
    assert got["tail of 100"][1] == sentence(50)
    assert got["one long sentence"] == [sentence(5000)]
    assert got["empty"] == [""]


def test_chunks_of_random_texts(spark):
    rng = random.Random(7)
    alphabet = ["a", "bb", "é", ".", "!", "? ", " ", "  ", ". ", "\n", "mot "]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(400))) for _ in range(400)]
    for size, overlap in ((100, 20), (30, 30)):
        assert spark_chunks(spark, texts, size, overlap) == [packed(t, size, overlap) for t in texts]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text("ab.!? \n", max_size=120), min_size=1, max_size=30), st.integers(1, 60), st.integers(0, 60))
def test_chunks_property(spark, texts, size, overlap):
    assert spark_chunks(spark, texts, size, overlap) == [packed(t, size, overlap) for t in texts]


def test_sentences_survive_chunking(spark):
    """Without the repeated sentences the chunk ranges give every sentence once, in order."""
    texts = [v for v in EDGES.values()]
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    lengths = F.transform(tx.split_sentences("text"), F.length)
    for row in df.select(F.size(lengths).alias("n"), tx.chunk_ranges(lengths).alias("r")).collect():
        reached = 0
        for first, n in row.r:
            assert first <= reached < first + n
            reached = first + n
        assert reached == row.n


def test_long_document_is_linear_enough(spark):
    text = " ".join(f"Sentence number {i} of a very long talk." for i in range(60000))
    [got] = spark_chunks(spark, [text], 1000, 100)
    assert got == packed_fast(text)


def packed_fast(text):
    sentences = re.split(r"(?<=\.) +", text)
    out, held, chars = [], [], 0
    for s in sentences:
        if held and chars + len(s) > 1000:
            out.append(" ".join(held))
            tail, n = [], 0
            while held and n + len(held[-1]) < 100:
                n += len(held[-1])
                tail.append(held.pop())
            held, chars = tail[::-1], n
        held.append(s)
        chars += len(s)
    return out + [" ".join(held)]


def test_non_blank_and_strip_follow_unicode(spark):
    values = ["", "  ", "  ", "\x1c\n", " a ", "\x1fb \t", "é"]
    df = spark.createDataFrame([(v,) for v in values], "t STRING")
    for row in df.select("t", tx.non_blank("t").alias("n"), tx.strip("t").alias("s")).collect():
        assert row.n == bool(row.t.strip())
        assert row.s == row.t.strip()


def test_safe_title_for_every_character(spark):
    points = spark.range(0x110000).filter("id < 55296 OR id > 57343")
    chars = points.select("id", F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    kept = chars.select("id", tx.safe_title(F.concat("c", F.lit("x"))).alias("s"))
    got = {r.id for r in kept.filter(F.length("s") == 2).select("id").collect()}
    want = {
        p for p in range(0x110000)
        if not 0xD800 <= p <= 0xDFFF and (chr(p).isalpha() or chr(p).isdigit() or p == 32)
    }
    # Characters of newer Unicode versions than the running Python knows may be kept too.
    assert want <= got
    assert {p for p in got - want if chr(p).isprintable()} == set()


def test_names(spark):
    row = spark.range(1).select(
        tx.safe_title(F.lit("Ép. 1: l'été — n²!  ")).alias("title"),
        tx.chunk_id(F.lit("My talk.txt.txt"), F.lit(3)).alias("id"),
        tx.stem_path(F.lit("a.mp3/b.mp3"), ".mp3", ".txt").alias("path"),
    ).first()
    assert row.title == "Ép 1 lété  n²"
    assert row.id == "My_talk_3"
    assert row.path == "a.txt/b.txt"


def test_sql_functions_agree_with_the_columns(spark, plan_of):
    from sonotheca.functions.sql import register_functions
    from sonotheca.operators.chunking import chunk_transcripts

    register_functions(spark)
    rng = random.Random(3)
    texts = ["", " ", None, "One. Two! Three? ", "no end", "a.  b.   c. \n d", "é" * 1500 + ". x"]
    texts += ["".join(rng.choice(["w" * rng.randint(1, 300) + ".", "!", "?", " ", "  ", " ", "\n"]) for _ in range(200)) for _ in range(8)]
    df = spark.createDataFrame([(i, f"f {i}.txt", t) for i, t in enumerate(texts)], "i INT, file STRING, text STRING")
    df.createOrReplaceTempView("sql_texts")
    found = spark.sql("SELECT t.i, c.chunk_ix, c.document, chunk_id(t.file, c.chunk_ix) AS id FROM sql_texts t, LATERAL chunk_text(t.text) c")
    want = chunk_transcripts(df).select("i", "chunk_ix", "document", "id")
    assert sorted(found.collect()) == sorted(want.collect()) and "Python" not in plan_of(found)
    small = spark.sql("SELECT t.i, c.* FROM sql_texts t, LATERAL chunk_text(t.text, 50, 20) c")
    assert sorted(small.collect()) == sorted(chunk_transcripts(df, chunk_size=50, overlap=20).select("i", "chunk_ix", "document").collect())
    titles = ["Été: 7² _x ", "a\nb", "٣ ⑨", None]
    given = spark.createDataFrame([(t,) for t in titles], "title STRING")
    given.createOrReplaceTempView("sql_titles")
    assert spark.sql("SELECT safe_title(title) AS s FROM sql_titles").collect() == given.select(tx.safe_title("title").alias("s")).collect()
    assert spark.sql("SELECT split_sentences('a. b!  c') AS s").first()["s"] == ["a.", "b!", "c"]
    assert [tuple(r) for r in spark.sql("SELECT * FROM sentence_rows('a. b')").collect()] == [(0, "a."), (1, "b")]

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sonotheca.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
PLAIN.encode_special_tokens = True
ENCODER = packing.Encoder(PATH)


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'.,1é日 　 \n\t\r s<|>-")) | st.characters(exclude_categories=["Cs"]), max_size=60))
def test_encoder_agrees_with_plain_encoding(text):
    assert ENCODER.encode([text])[0].tolist() == plain_ids(text)[:-1]


TRICKY = ["", " ", "a\n\nb", "a\n b", "a \n  b\t\tc", "it's 'tis we'll 's", "x'", "3rd v2.0, (a)", "é'ê ñ", "word\u00a0 word", "a\u3000 b",
          "\u0085x", "naïve café", "Привет, мир! 5%", "日本 語 a", "a\x1c b", "\r\n\r\nend\n", "co\u0301te", "<|endoftext|> x"]


def test_texts_of_a_batch_are_told_apart():
    assert [ids.tolist() for ids in ENCODER.encode(TRICKY)] == [plain_ids(t)[:-1] for t in TRICKY]
    assert [ids.tolist() for ids in ENCODER.encode([])] == [] and [ids.tolist() for ids in ENCODER.encode(["", ""])] == [[], []]


def test_every_two_classes_beside_each_other():
    signs = list("aZ9'.\n\t \r-éß²½\u0301я٣\u00a0\u2003語")
    texts = ["".join(t) for t in itertools.product(signs, repeat=3)]
    assert [ids.tolist() for ids in ENCODER.encode(texts)] == [plain_ids(t)[:-1] for t in texts]


def test_special_tokens_as_such_on_request():
    as_such = packing.Encoder(PATH, special_as_text=False)
    got = as_such.encode(["a b <|endoftext|> c d <|endoftext|>", "plain"])
    assert got[0].tolist() == Tokenizer.from_file(PATH).encode("a b <|endoftext|> c d <|endoftext|>", add_special_tokens=False).ids
    assert got[0].tolist().count(50256) == 2 and got[1].tolist() == plain_ids("plain")[:-1]


def test_forgetting_known_parts_changes_nothing():
    encoder = packing.Encoder(PATH, most=5)
    for text in ("one two three four five six seven one two", "eight nine one ten", "a b c d e f g h i j k"):
        assert encoder.encode([text])[0].tolist() == plain_ids(text)[:-1]


def test_hashes_that_collide_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "mixed", lambda x: x & np.uint64(7))
    encoder = packing.Encoder(PATH)
    for texts in (["one two three", "four five six"], ["seven eight, nine", "ten"]):
        assert [ids.tolist() for ids in encoder.encode(texts)] == [plain_ids(t)[:-1] for t in texts]


@pytest.mark.parametrize("capacity, slack", [(1024, 16), (64, 0), (64, 8)])
def test_cuts_cover_a_document_and_fill_their_class(capacity, slack):
    for total in range(1, 3 * capacity):
        found = list(packing.cuts(total, capacity, slack))
        assert sum(length for length, _ in found) == total
        assert all(capacity - slack <= per * length <= capacity for length, per in found)


def documents():
    rnd = random.Random(4)
    words = ["alpha", "beta", "naïve", "日本", "x1", "don't", "..."]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 3, 40, 400, 900])))) for i in range(150)]
    return rows + [(None, "no id"), (3, "again"), (3, "again"), (500, None), (501, ""), (502, "long word " * 30_000), (503, "<|endoftext|> \n\n  end  ")]


def check(rows, pieces, capacity=1024):
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[(p["id"], p["doc_tokens"])].append(p)
    want = defaultdict(list)
    for key, text in rows:
        ids = plain_ids(text)
        want[(key, len(ids))].append(ids)
    assert by_doc.keys() == want.keys()
    for key, own in by_doc.items():
        copies = len(want[key])
        joined = defaultdict(list)
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["length"] == len(p["ids"]) // 4
            joined[p["start"]].append(np.frombuffer(p["ids"], "<u4").tolist())
        starts = sorted(joined)
        if copies == 1:
            assert sum((joined[s][0] for s in starts), []) == want[key][0]
        assert sum(len(x) for s in starts for x in joined[s]) == key[1] * copies
    bins = defaultdict(list)
    for p in pieces:
        bins[p["sequence_id"]].append(p)
    padding = 0
    for own in bins.values():
        own.sort(key=lambda p: p["offset"])
        at = 0
        for p in own:
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / sum(p["length"] for p in pieces)


def test_every_id_lies_in_one_gapless_place(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)
    for name in ("id", "start", "length", "ids", "per", "slot", "shard", "sequence_id"):
        docs = docs.withColumn(name, F.lit("clash"))
    pieces = packing.packed(docs)
    assert check(rows, pieces.collect()) <= 16 / 1008


def test_only_full_sequences_and_powers_of_two_without_slack(spark):
    rows = documents()
    pieces = packing.packed(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3), slack=0, capacity=64)
    assert check(rows, pieces.collect(), 64) == 0


def test_whole_sequences_hold_the_documents(spark):
    rows = [r for r in documents() if r[0] not in (None, 3)]
    whole = packing.sequences(packing.packed(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))).collect()
    found = defaultdict(list)
    for s in whole:
        ids = np.frombuffer(s["ids"], "<u4")
        assert len(ids) == (s["length"] if s["length"].bit_count() == 1 else 1024)
        for p in s["parts"]:
            found[p["id"]].append((p["start"], ids[p["offset"]:p["offset"] + p["length"]].tolist()))
    assert {k: sum((x for _, x in sorted(v)), []) for k, v in found.items()} == {k: plain_ids(t) for k, t in rows}


def test_query_columns_and_empty_table(spark, tmp_path):
    rows = [(1, "one two"), (2, None)]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").write.parquet(f"{tmp_path}/a/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op12_packing(spark, f"{tmp_path}/a").collect() if r["start"] == 0 and r["length"] == r["doc_tokens"]}
    for key, text in rows:
        ids = np.array(plain_ids(text), "<u4").tobytes()
        if key in got:
            assert got[key]["ids_crc32"] == zlib.crc32(ids)
    spark.createDataFrame([], "doc_id BIGINT, text STRING").write.parquet(f"{tmp_path}/b/documents.parquet")
    assert queries.op12_packing(spark, f"{tmp_path}/b").count() == 0

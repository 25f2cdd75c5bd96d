import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonotheca.llm import katz


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + ["</s>"]


class Plain:
    """The same model with dictionaries, word by word."""

    def __init__(self, texts, order):
        self.order, self.memo = order, {}
        self.counts = [None] + [Counter() for _ in range(order)]
        for text in texts:
            w = tokens(text)
            for n in range(1, order + 1):
                p = ["<s>"] * (n - 1) + w
                self.counts[n].update(tuple(p[j:j + n]) for j in range(len(w)))
        self.total, self.size = sum(self.counts[1].values()), len(self.counts[1])
        self.discount = {n: katz.Discount([sum(c == r for c in self.counts[n].values()) for r in range(1, katz.K + 2)])
                         for n in range(1, order + 1)}
        self.after = {n: defaultdict(list) for n in range(2, order + 1)}
        for n in self.after:
            for gram, c in self.counts[n].items():
                self.after[n][gram[:-1]].append((gram[-1], c))

    def cut(self, n, c):
        return float(self.discount[n](np.array([float(c)]))[0])

    def prob(self, history, word):
        if not history:
            c, lost = self.counts[1][(word,)], self.discount[1].lost
            whole = self.total if lost else self.total + 1
            return (self.cut(1, c) if c else lost or 1) / whole
        n, seen = len(history) + 1, self.after[len(history) + 1].get(history)
        if not seen:
            return self.prob(history[1:], word)
        if history not in self.memo:
            whole, kept = sum(c for _, c in seen), sum(self.cut(n, c) for _, c in seen)
            whole += kept >= whole
            self.memo[history] = whole, (1 - kept / whole) / (1 - sum(self.prob(history[1:], w) for w, _ in seen))
        whole, backoff = self.memo[history]
        c = self.counts[n][(*history, word)]
        return self.cut(n, c) / whole if c else backoff * self.prob(history[1:], word)

    def score(self, text):
        w = tokens(text)
        p = ["<s>"] * (self.order - 1) + w
        return sum(math.log10(self.prob(tuple(p[j:j + self.order - 1]), w[j])) for j in range(len(w)))


def corpus(seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(150)] + ["É", "Ab", "aB", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.randint(0, 60))), i % 5 > 0) for i in range(160)]
    rows += [(None, "w1 w2 unknown\tw3", True), (3, None, True), (4, "", False), (5, " \n", None), rows[2], rows[2],
             (900, "never seen words only", False)]
    return rows


@pytest.mark.parametrize("order", [1, 2, 3])
def test_agrees_with_dictionaries_and_sums_to_one(spark, order, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_KEYS", 500)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, fit BOOLEAN").withColumn("id", F.lit(1)).withColumn("train", F.lit(2))
    got = katz.scored(df, F.col("fit"), order=order, chunk_tokens=300).collect()
    model = Plain([t for _, t, fit in rows if fit], order)
    want = Counter()
    for i, text, fit in rows:
        w = tokens(text)
        base = sum(math.log10((model.counts[1][(x,)] + 1) / (model.total + model.size + 1)) for x in w)
        want[i, bool(fit), len(w), sum(model.counts[1][(x,)] > 0 for x in w), model.total, round(base, 6), round(model.score(text), 6)] += 1
    assert want == Counter((r["id"], r["train"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6),
                            round(r["score"], 6)) for r in got)
    words = [w for w, in model.counts[1]] + ["<unknown>"]
    for history in [(), ("w0",), ("<s>",), ("zzz",)]:
        if len(history) < order:
            assert sum(model.prob(history, w) for w in words) == pytest.approx(1)


def test_discount_falls_back_where_good_turing_fails():
    for stats in ([0] * 6, [5, 0, 0, 0, 0, 0], [1, 50, 1, 50, 1, 50], [100, 40, 20, 12, 9, 7]):
        factor = katz.Discount(stats).factor[1:]
        assert ((factor > 0) & (factor < 1)).all()


def test_packing_round_trip():
    draw = np.random.default_rng(0)
    for values in (draw.integers(0, 2 ** 63, 1000).astype(np.uint64), np.empty(0, np.int32), draw.normal(size=7), np.array([3], np.uint8)):
        assert np.array_equal(katz.unpacked(katz.packed(values), values.dtype), values)


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id BIGINT, text STRING")
    assert [r["score"] for r in katz.scored(df, F.lit(False)).collect()] == [0.0, 0.0]
    assert katz.scored(df.limit(0), F.lit(True)).count() == 0


def test_one_word_makes_up_most_of_the_corpus(spark):
    rows = [(i, "the " * 2000 + f"w{i}", True) for i in range(20)] + [(99, "the end", False)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, fit BOOLEAN")
    got = {r["id"]: r["score"] for r in katz.scored(df, F.col("fit"), chunk_tokens=5000).collect()}
    model = Plain([t for _, t, fit in rows if fit], 2)
    assert got[99] == pytest.approx(model.score("the end")) and got[3] == pytest.approx(model.score(rows[3][1]))

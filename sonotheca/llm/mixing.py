"""Mixing sources to target weights, with DataFrame functions only.

1. **Pack.** The words of a source, document after document, are one stream cut into
   blocks of ``block`` words.  A document's offset is a running sum in two levels: over
   the totals of hashed buckets of the source, then inside a bucket.  There are as many
   buckets as rows in a bucket, the square root of all rows, so no task sorts more than
   that however large one source is.
2. **Draw.** The mix is ``n`` slots in output shards of ``shard`` slots on average.  A source
   gets the whole part of the slots it wants and one draw for the fraction, over all shards,
   so its total does not depend on theirs.  Every shard takes an equal whole part of it; the
   slots that are left fall to shards at random, which makes them multinomial.
3. **Map.** The r-th slot of a source, counted over all shards, takes the block at
   position r (modulo the number of blocks) of a pseudorandom permutation of the source's
   blocks: a swap-or-not cipher on exactly that many numbers.  A source is thus gone
   through once before any block repeats, and no source has more slots than two rounds.
4. **Join** slots and blocks by source and index.

Targets: a source's weight share of ``total`` times all words, but at most ``most`` times
its own words; what is cut off goes to the others by weight until none is above.

Everything is a function of the rows and ``seed``, so reruns and retried tasks agree.

Nulls and edge cases: a null text has no words; a null source is a source of its own,
the last one.  A source without words gets and gives nothing.  An empty table gives an
empty mix.  Rows equal in source, id and text are interchangeable; their offsets are
dealt in any order.  Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonotheca.session import written

BLOCK = 64
SHARD = 1024
WEIGHTS = (5, 2, 1)
TOTAL = 1.5
MOST = 2
ROUNDS = 16
#: Slots that one task numbers.
TASK_SLOTS = 100_000
#: Words between white space.
_WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    """The number of words; null has none."""
    marks = F.regexp_replace(F.translate(text, "\t\n\u000b\f\r", "     "), "[^ ]+", "x")
    return F.coalesce(F.length(F.replace(marks, F.lit(" "))), F.lit(0)).cast("bigint")


def _unit(*parts: Column | int) -> Column:
    """A pseudorandom number in [0, 1) that depends on nothing but ``parts``."""
    number = F.xxhash64(*(F.lit(p) if isinstance(p, int) else p for p in parts))
    return F.shiftrightunsigned(number, 11) / float(1 << 53)


def permuted(index: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """Where a pseudorandom permutation of ``0 .. n-1``, chosen by ``key``, takes ``index``.

    Swap-or-not: each round pairs ``x`` with ``k - x`` modulo ``n`` and swaps the pair or
    leaves it by one bit of the larger member, so every round is a bijection for any ``n``.
    """
    def swap_or_not(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        bit = F.xxhash64(key, r, F.lit("swap"), F.greatest(x, partner)) % 2
        return F.when(bit == 0, x).otherwise(partner)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("bigint"), swap_or_not)


def targets(sizes: DataFrame, total: float = TOTAL, most: int = MOST) -> DataFrame:
    """``sizes`` (``source_size``, ``weight``) with ``target``: shares by weight, capped and reshared.

    A source is capped if its share at the current level exceeds its cap.  Capping frees
    words for the others and so only ever raises the level, hence a few rounds settle it.
    Each round is one aggregate over one row per source.
    """
    cap = F.col("source_size") * most
    whole = sizes.agg(F.sum("source_size")).first()[0] or 0
    rest, weight = total * whole, sizes.agg(F.sum("weight")).first()[0] or 1
    while True:
        # compared as rest * weight >= cap * all weights, which stays exact for large counts
        over = F.col("weight") * F.lit(float(rest)) >= cap * F.lit(float(weight))
        capped, used, open_weight = sizes.agg(
            F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        left = total * whole - used
        if (left, open_weight) == (rest, weight) or not open_weight:
            break
        rest, weight = left, open_weight
    level = F.col("weight") * F.lit(float(rest)) / F.lit(float(weight))
    return sizes.withColumn("target", F.when(over, cap.cast("double")).otherwise(level))


class Mix:
    """The tables of one mix: ``placed`` documents, ``sources``, ``slots`` and ``takes``."""

    def __init__(
        self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL, most: int = MOST,
        block: int = BLOCK, shard: int = SHARD, seed: int = 1,
    ):
        self.docs, self.block, self.shard, self.seed, self.most = docs, block, shard, seed, most
        self.id_col, self.text_col, self.source_col = id_col, text_col, source_col
        self.sized = sized = written(
            docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                        F.xxhash64(text_col).alias("text_hash"), n_words(F.col(text_col)).alias("size")), "sizes")
        self.sources = written(self._sources(sized, weights, total), "sources")
        # as many buckets as rows in a bucket: neither the sums over buckets nor a bucket get large
        self.buckets = math.isqrt(sized.count()) + 1
        self.starts = written(self._starts(sized), "starts")
        with_words = sized.where("size > 0").withColumn("bucket", self._bucket())
        self.placed = written(self._place(with_words, self.starts), "placed")
        self.slots = written(self._slots(), "slots")

    def _sources(self, sized: DataFrame, weights: tuple[int, ...], total: float) -> DataFrame:
        """One row per source: rank, weight, size, target, blocks and slots."""
        sums = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
        # ranks over one row per source
        place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).cast("bigint")
        cycle = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
        ranked = written(sums.withColumn("place", place).withColumn("weight", cycle), "source-ranks")
        blocks = F.ceil(F.col("source_size") / self.block)
        return targets(ranked, total, self.most).withColumn("n_blocks", blocks).withColumn(
            "want", F.least(F.col("target") / self.block, blocks * self.most))

    def _place(self, rows: DataFrame, starts: DataFrame) -> DataFrame:
        """``rows`` with the ``place`` of their source and the ``start`` of their first word in its stream."""
        inside = Window.partitionBy("source", "bucket").orderBy("id", "text_hash", "size").rowsBetween(
            Window.unboundedPreceding, -1)
        r = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("r")
        s = starts.alias("s")
        joined = r.join(s, F.col("r.source").eqNullSafe(F.col("s.source")) & (F.col("r.bucket") == F.col("s.bucket")))
        return joined.select(*(f"r.{c}" for c in rows.columns if c != "bucket"), "s.place",
                             (F.col("s.base") + F.col("inside")).alias("start"))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("id", "text_hash", F.lit(self.seed)), F.lit(self.buckets))

    def _starts(self, sized: DataFrame) -> DataFrame:
        """``base`` of every bucket of a source: the words in its earlier buckets."""
        sums = sized.where("size > 0").withColumn("bucket", self._bucket()).groupBy("source", "bucket").agg(
            F.sum("size").alias("in_bucket"))
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        based = sums.withColumn("base", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
        ranks = self.sources.select(F.col("source").alias("_source"), "place")
        return based.join(ranks, F.col("source").eqNullSafe(F.col("_source"))).select("source", "bucket", "base", "place")

    def _slots(self) -> DataFrame:
        """``out_shard``, ``place``, ``nth`` (of the source, over all shards) and ``index`` of the block."""
        all_slots = self.sources.agg(F.sum("want")).first()[0]
        shards = int(-(-(all_slots or 0) // self.shard))
        # the whole part of what a source wants, and one draw for its fraction
        total = F.floor("want") + (_unit(self.seed, F.col("place"), F.lit("total")) < F.col("want") - F.floor("want")).cast("bigint")
        plan = self.sources.where("want > 0").select(
            "place", "n_blocks", F.least(total, F.col("n_blocks") * self.most).alias("total"))
        plan = written(plan.withColumn("whole", F.floor(F.col("total") / max(1, shards)))
                       .withColumn("rest", F.col("total") - F.col("whole") * shards), "plan")
        upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
        sure = plan.where("whole > 0").select("place", upto(F.lit(max(1, shards)).cast("bigint")).alias("out_shard"), F.col("whole").alias("n"))
        drawn = plan.where("rest > 0").select("place", upto(F.col("rest")).alias("ticket")).select(
            "place", F.floor(_unit(self.seed, F.col("place"), F.col("ticket")) * shards).alias("out_shard"),
            F.lit(1).cast("bigint").alias("n"))
        per_shard = written(sure.unionByName(drawn).groupBy("place", "out_shard").agg(F.sum("n").alias("n")), "shard-counts")
        before = Window.partitionBy("place").orderBy("out_shard").rowsBetween(Window.unboundedPreceding, -1)
        numbered = written(per_shard.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "numbered")
        # few rows that make many slots: dealt out by their number of slots
        numbered = numbered.repartition(max(1, int(-(-(all_slots or 0) // TASK_SLOTS))))
        each = numbered.select("place", "out_shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("nth"))
        index = permuted(F.pmod("nth", "n_blocks"), F.col("n_blocks"), F.col("place") * 31 + self.seed)
        return each.join(plan.select("place", "n_blocks"), "place").select("out_shard", "place", "nth", index.alias("index"))

    def pieces(self) -> DataFrame:
        """The part of every document in every block: ``index``, ``from`` and ``length`` in the document."""
        last = F.floor((F.col("start") + F.col("size") - 1) / self.block)
        cut = self.placed.select("id", "place", "text_hash", "size", "start", F.explode(
            F.sequence(F.floor(F.col("start") / self.block), last)).alias("index"))
        begin = F.greatest(F.col("start"), F.col("index") * self.block)
        end = F.least(F.col("start") + F.col("size"), (F.col("index") + 1) * self.block)
        return cut.select("*", (begin - F.col("start")).alias("from"), (end - begin).alias("length"))

    def taken(self) -> DataFrame:
        """One row per row of ``docs``: ``id``, ``size``, ``source_size``, ``target``, ``taken``."""
        times = written(self.slots.groupBy("place", "index").agg(F.count(F.lit(1)).alias("times")), "times")
        used = self.pieces().join(times, ["place", "index"]).groupBy("place", "start").agg(
            F.sum(F.col("length") * F.col("times")).alias("taken"))
        used = written(used, "taken")
        placed = self.placed.join(used, ["place", "start"], "left").select(
            "id", "source", "size", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
        empty = self.sized.where("size = 0").select("id", "source", "size", F.lit(0).cast("bigint").alias("taken"))
        totals = self.sources.select(F.col("source").alias("_source"), "source_size", "target")
        return placed.unionByName(empty).join(totals, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    def blocks(self) -> DataFrame:
        """The mix itself: ``out_shard``, ``source``, ``nth``, ``doc_ids`` and ``text`` of every slot's block."""
        # the text travels as it is; it is cut into words where it arrives
        rows = self.docs.select(
            F.col(self.id_col).alias("id"), F.col(self.source_col).alias("source"),
            F.xxhash64(self.text_col).alias("text_hash"), F.col(self.text_col).alias("text"),
            n_words(F.col(self.text_col)).alias("size")).where("size > 0").withColumn("bucket", self._bucket())
        starts = self._place(rows, self.starts).withColumn("words", F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)))
        block = F.lit(self.block)
        first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)

        def piece(index):
            begin = F.greatest(F.col("start"), index * block) - F.col("start")
            end = F.least(F.col("size"), (index + 1) * block - F.col("start"))
            return F.struct(index.alias("index"), begin.alias("from"), F.array_join(
                F.slice("words", (begin + 1).cast("int"), (end - begin).cast("int")), " ").alias("words"))

        cut = starts.select("id", "source", "place", "start", F.explode(F.transform(F.sequence(first, last), piece)).alias("p"))
        # grouped by the keys of the join, so a block is shuffled once
        whole = cut.groupBy("place", F.col("p.index").alias("index")).agg(F.first("source").alias("source"), F.sort_array(
            F.collect_list(F.struct((F.col("start") + F.col("p.from")).alias("at"), "id", F.col("p.words").alias("words")))).alias("parts"))
        filled = whole.select("place", "source", "index", F.col("parts.id").alias("doc_ids"),
                              F.array_join("parts.words", " ").alias("text"))
        return self.slots.join(filled, ["place", "index"]).select("out_shard", "source", "nth", "doc_ids", "text")

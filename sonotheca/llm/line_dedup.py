"""Line dedup by winnowing over line hashes, with DataFrame functions only.

A text is cut into units: lines, and inside a line sentences, so that a passage that was
pasted into a paragraph is still a run of whole units.  Each unit has a 63-bit hash.

1. **Winnow.**  A window is a run of units that reaches ``least`` words and would not without
   its first or without its last unit.  The least unit hash of every window is its
   fingerprint (of equal ones the first).  Two places that share a run of ``least`` words share
   a window, and so select the same unit of it.
2. **Join.**  Fingerprints that occur once are dropped by a count; the places of all others
   are joined with it.
3. **Extend.**  From each such place the run grows to the left and to the right, to every window
   that holds it.  Each is compared as a whole with the first place of its hash, so a repeat
   always meets a place that holds all of it; windows that follow one another add up to the
   longest repeated run.
4. **Delete** the units of every window but the first of its hash.  A unit that goes has an
   equal one before it, so the first occurrence of a run always stays.

Hot lines only meet in counts and minima, which are combined before the shuffle, and in
joins of plain tables with one row per hash or document, which Spark may split.

Nulls and edge cases: a null text stays null and an empty one empty.  A null id comes
after all others.  Rows equal in id and text are one document: what repeats between them
is not deleted from either.  Rows that share only the id are told apart by their text.
Blank units are passed over when runs are compared; those inside a run go with it.  Tabs,
vertical tabs, form feeds and carriage returns count as spaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonotheca.session import written

LEAST = 20
#: Runs of so many units are looked up unit by unit, longer ones as a whole.
_NEAR = 4
#: Runs of so many units are found step by step; longer ones by a fold, which costs far more.
_STEPPED = 32
#: Up to so many shared units of a text are looked up one by one.
_LOOKED_UP = 256
#: Units end at a line break, or at white space after a full stop, exclamation or question mark; the first part skips most places.
_UNIT_END = r"(?<=[\n \t])(?<=\n|[.!?][ \t])"
#: The same places, taking the character before them along; tried at white space only.
_SEPARATOR = r"[\n \t](?<=\n|[.!?][ \t])"


def units(text: Column) -> Column:
    """The units of a text; joined again they are the text."""
    return F.split(text, _UNIT_END, -1)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _held(v: Column, body) -> Column:
    """``body`` of the arrays of a document, each looked up in the row once."""
    return _let(F.struct(*(v[name].alias(name) for name in ("h", "w", "at"))), body)


def _spaced(text: Column) -> Column:
    """``text`` with every vertical tab, form feed and carriage return as a space."""
    return F.translate(text, "\u000b\f\r", "   ")


def _words(bare: Column) -> Column:
    """Words of a trimmed unit that is not empty, counted by its spaces."""
    return (F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(" "))) + 1).cast("int")


def _key(id_col: str, text_col: str) -> Column:
    """Documents in order: by id, a null one last, then by text."""
    return F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
                    F.xxhash64(text_col).alias("text_hash"))


def _hashed(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """``k``, ``n_units``, ``v`` and ``picks``, one row per document with text.

    ``v`` holds the units with words as arrays: ``h``, ``w`` and ``at``, the place among all units;
    ``picks`` are the numbers of the selected ones.
    """
    def bare(d: Column) -> Column:
        # a carriage return ends no sentence as a space does, so it is replaced after the split
        raw = F.split(d["text"], _SEPARATOR, -1)
        return F.when(d["odd"], F.transform(raw, lambda u: F.trim(_spaced(u)))).otherwise(F.transform(raw, lambda u: F.trim(u)))

    def places(every: Column, real: Column) -> Column:
        some = F.filter(F.transform(every, lambda u, i: F.when(u != "", i)), lambda i: i.isNotNull())
        return F.when(F.size(every) == F.size(real), F.sequence(F.lit(0), F.size(every) - 1)).otherwise(some)

    def arrays(every: Column, real: Column) -> Column:
        return F.struct(F.transform(real, lambda u: F.xxhash64(u)).alias("h"), F.transform(real, lambda u: _words(u)).alias("w"),
                        places(every, real).alias("at"))

    def parts(every: Column) -> Column:
        v = _let(F.array_remove(every, ""), lambda real: arrays(every, real))
        return _let(v, lambda v: F.struct(F.size(every).alias("n_units"), v.alias("v"), _picks(v, least).alias("picks")))

    text = F.col(text_col)
    odd = F.contains(text, F.lit("\r")) | F.contains(text, F.lit("\f")) | F.contains(text, F.lit("\u000b"))
    # all in one expression, so that no array of strings or structs is laid out as a row in between
    found = _let(F.struct(F.replace(text, F.lit("\t"), F.lit(" ")).alias("text"), odd.alias("odd")), lambda d: _let(bare(d), parts))
    return docs.where(text != "").select(_key(id_col, text_col).alias("k"), found.alias("f")).select("k", "f.n_units", "f.v", "f.picks")


def _get(values: Column, i: Column, c: int) -> Column:
    return F.get(values, i + c if c >= 0 else i - (-c))


def _ends(v: Column, i: Column, side: int, c: int) -> Column:
    """Whether the windows that select unit ``i`` end before the ``c``-th unit on one ``side``.

    ``i`` is the least of them: what stands before it is greater, what follows is not less.
    """
    own, other = F.get(v["h"], i), _get(v["h"], i, side * c)
    return F.coalesce(other <= own if side < 0 else other < own, F.lit(True))


def _picks(v: Column, least: int) -> Column:
    """The units that are the least of some window, and few others in long runs of very short units.

    The run around a unit in which it is the least is measured up to ``_NEAR`` units to each side.
    """
    def words(i: Column, side: int) -> Column:
        total, chain = F.lit(0), F.when(_ends(v, i, side, 1), 0)
        for c in range(1, _NEAR):
            total = total + _get(v["w"], i, side * c)
            chain = chain.when(_ends(v, i, side, c + 1), total)
        return chain.otherwise(least)

    every = F.when(F.size(v["w"]) > 0, F.sequence(F.lit(0), F.size(v["w"]) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(every, lambda i: (F.get(v["w"], i) >= least) | (F.get(v["w"], i) + words(i, -1) + words(i, 1) >= least))


def _reaches(words: Column, least: int) -> Column:
    """Where the shortest run of ``least`` words from each unit on ends; null if too few follow.  It has ``least`` units at most.

    Words are summed over 1, 2, 4 ... units, up to where every sum of a text suffices.  All units skip the largest such
    parts first, as long as these leave them short of ``least``; they hold the skipped units and the words of these in one number.
    """
    bits = (2 * least).bit_length()
    levels = (min(least, _STEPPED) - 1).bit_length()

    def far(i: Column) -> Column:
        return F.aggregate(F.slice(words, i + 1, least), F.struct(F.lit(0).alias("c"), F.lit(0).alias("w")), lambda got, w: F.when(
            got["w"] >= least, got).otherwise(F.struct((got["c"] + 1).alias("c"), (got["w"] + w).alias("w"))),
            lambda got: F.when(got["w"] >= least, i + got["c"]))

    def end(held: Column, i: Column) -> Column:
        at = i + F.shiftright(held, bits)
        # every unit has a word, so up to the steps nothing but the end of the text is left
        return F.when(at < F.size(words), at + 1 if least <= _STEPPED else far(i))

    def skip(part: Column, units: int):
        def one(held: Column, i: Column) -> Column:
            then = held + F.get(part, i + F.shiftright(held, bits)) + (units << bits)
            return F.when(then.bitwiseAND(2 ** bits - 1) < least, then).otherwise(held)

        return one

    def summed(part: Column, units: int) -> Column:
        # a part that the text is too short for counts as long enough, so none skips it
        return F.transform(part, lambda w, i: F.least(w + F.get(part, i + units), F.lit(least)))

    def skipped(parts: list) -> Column:
        held = F.array_repeat(F.lit(0), F.size(words))
        for c in reversed(range(len(parts))):
            held = F.transform(held, skip(parts[c], 2 ** c))
        return F.transform(held, end)

    def level(parts: list, part: Column) -> Column:
        every = [*parts, part]
        more = _let(summed(part, 2 ** len(parts)), lambda wider: level(every, wider)) if len(every) < levels else skipped(every)
        return F.when(F.array_min(part) >= least, skipped(parts)).otherwise(more)

    if not levels:
        return skipped([])
    return _let(F.transform(words, lambda w: F.least(w, F.lit(least))), lambda part: level([], part))


def _extended(v: Column, shared: Column, least: int) -> Column:
    """The windows that hold a ``shared`` unit, as structs of ``h`` (the hash of all units), ``start`` and ``end``.

    A window from unit ``i`` on is the shortest that reaches ``least`` words, or a longer one that
    does not reach them without ``i``: the shortest back from its last unit.  Where very many
    units of a text are shared, all of its windows are taken; what occurs once drops out later.
    """
    n = F.size(v["w"])
    few = (F.size(shared) <= _LOOKED_UP) & (F.size(shared) * 2 < n)
    marks = F.when(few, F.transform(v["w"], lambda _, i: F.array_contains(shared, i)))

    def lasts(ends: Column) -> Column:
        # the runs back from units behind e start at i as well, up to where the next run on ends
        return F.transform(F.filter(ends, lambda e: e.isNotNull()), lambda e, i: F.greatest(e, F.coalesce(F.get(ends, i + 1) - 1, n)))

    def hashed(i: Column, j: Column) -> Column:
        # the hash of an array is that of its elements; nulls count for nothing, and a slice costs far more
        near = [F.get(v["h"], i), *(F.when(j > i + c, F.get(v["h"], i + c)) for c in range(1, _NEAR))]
        return F.when(j <= i + _NEAR, F.xxhash64(*near)).otherwise(F.xxhash64(F.slice(v["h"], i + 1, j - i)))

    def from_start(e: Column, last: Column, i: Column) -> Column:
        window = lambda j: F.struct(
            hashed(i, j).alias("h"), F.get(v["at"], i).alias("start"), (F.get(v["at"], j - 1) + 1).alias("end"))
        return F.when(e == last, F.array(window(e))).otherwise(F.transform(F.sequence(e, last), window))

    def holds(marked: Column, i: Column, stop: Column) -> Column:
        rest = F.exists(F.sequence(i + 2, stop - 1), lambda x: F.get(marked, x))
        return marked.isNull() | F.get(marked, i) | ((stop > i + 1) & F.get(marked, i + 1)) | F.when(stop > i + 2, rest).otherwise(False)

    def every(ends: Column, marked: Column) -> Column:
        runs = F.transform(lasts(ends), lambda last, i: F.when(holds(marked, i, last), from_start(F.get(ends, i), last, i)))
        return F.flatten(F.filter(runs, lambda r: r.isNotNull()))

    return _let(_reaches(v["w"], least), lambda ends: _let(marks, lambda marked: every(ends, marked)))


def _merged(runs: Column) -> Column:
    """Windows of one document as maximal runs; sorted by start they are sorted by end too."""
    def joined(every: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(every) - 1)
        gap = lambda i: F.get(every, i)["start"] > F.get(every, i - 1)["end"]
        return F.zip_with(F.filter(at, lambda i: F.coalesce(gap(i), F.lit(True))), F.filter(at, lambda i: F.coalesce(gap(i + 1), F.lit(True))),
                          lambda a, b: F.struct(F.get(every, a)["start"].alias("start"), F.get(every, b)["end"].alias("end")))

    return _let(F.array_sort(runs), joined)


def repeated_runs(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
) -> DataFrame:
    """``k`` (no_id, id, text_hash), ``n_units`` and ``runs`` of every different document with text.

    ``runs`` are the unit ranges that repeat something earlier; null if there are none.
    """
    hashed = written(_hashed(docs, id_col, text_col, least), "units")
    if hashed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").head(1):
        hashed = written(hashed.dropDuplicates(["k"]), "units")
    picks = hashed.select("k", F.explode(F.transform("picks", lambda i: F.struct(F.get("v.h", i).alias("h"), i.alias("i")))).alias("p"))
    prints = picks.select("p.h", "k", "p.i")
    often = written(prints.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "often")
    shared = prints.join(often, "h").groupBy("k").agg(F.collect_list("i").alias("shared"))
    windows = _held(F.col("v"), lambda v: _let(F.col("shared"), lambda some: _extended(v, some, least)))
    found = written(hashed.join(shared, "k").select("k", F.explode(windows).alias("r")).select("r.h", "k", "r.start", "r.end"), "windows")
    # what occurs once is the first run itself, so it need not meet it
    first = written(found.groupBy("h").agg(F.min(F.struct("k", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "first")
    # the first run of all stays, every other one goes
    later = found.join(first, "h").where(F.struct("k", "start") > F.col("first")).select("k", "start", "end")
    runs = later.groupBy("k").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    return hashed.select("k", "n_units").join(runs.select("k", _merged(F.col("runs")).alias("runs")), "k", "left")


def without_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    least: int = LEAST,
) -> DataFrame:
    """``docs`` with repeated runs deleted from ``text_col``, and ``n_units``, ``n_deleted``."""
    runs = written(repeated_runs(docs, id_col=id_col, text_col=text_col, least=least), "runs")
    parts = units(F.col(text_col))
    kept = F.filter(parts, lambda u, i: ~F.exists("_runs", lambda r: (i >= r["start"]) & (i < r["end"])))
    changed = F.col("_runs").isNotNull()
    runs = runs.select(F.col("k").alias("_k"), F.col("runs").alias("_runs"), F.col("n_units").alias("_n"))
    joined = docs.join(runs, _key(id_col, text_col) == F.col("_k"), "left")
    own = [F.when(changed, F.array_join(kept, "")).otherwise(F.col(c)).alias(c) if c == text_col else F.col(c)
           for c in docs.columns]
    covered = F.aggregate("_runs", F.lit(0), lambda n, r: n + r["end"] - r["start"])  # merged runs share no unit
    return joined.select(*own, F.coalesce("_n", F.lit(0)).cast("bigint").alias("_units"),
                         F.when(changed, covered).otherwise(0).cast("bigint").alias("_deleted"))


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated runs deleted, without the rows of which nothing is left."""
    found = without_repeats(docs, id_col=id_col, text_col=text_col, **options)
    emptied = (F.col("_deleted") > 0) & (F.trim(F.translate(F.col(text_col), "\t\n\u000b\f\r", "     ")) == "")
    return found.where(~emptied).select(docs.columns)

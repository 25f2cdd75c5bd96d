"""Text expressions: sentences, chunks, names.  All of them are native columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonotheca.fixed_values import (
    CHUNK_OVERLAP,
    CHUNK_SIZE,
    NEWER_LETTERS,
    OTHER_DIGITS,
    SENTENCE_BREAK,
)

# White space as Unicode text stripping sees it, that is the
# White_Space property plus the four ASCII separators.
_SPACE = r"\s\x1c-\x1f"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column | str) -> Column:
    """Remove leading and trailing Unicode white space (``trim`` removes only spaces)."""
    return F.regexp_replace(_col(text), f"(?U)^[{_SPACE}]+|[{_SPACE}]+$", "")


def non_blank(text: Column | str) -> Column:
    """True when something other than white space is left."""
    return _col(text).rlike(f"(?U)[^{_SPACE}]")


def split_sentences(text: Column | str) -> Column:
    """Cut after ``.``, ``!`` or ``?`` at runs of spaces; a trailing empty sentence stays."""
    return F.split(_col(text), SENTENCE_BREAK, -1)


def _kept_tail(lengths: Column, overlap: int) -> Column:
    """How many last entries stay strictly below ``overlap`` together, and their sum."""
    start = F.struct(
        F.lit(0).alias("n"), F.lit(0).alias("chars"), F.lit(True).alias("open")
    )

    def step(acc: Column, length: Column) -> Column:
        fits = acc["open"] & (acc["chars"] + length < overlap)
        return F.when(
            fits,
            F.struct(
                (acc["n"] + 1).alias("n"),
                (acc["chars"] + length).alias("chars"),
                F.lit(True).alias("open"),
            ),
        ).otherwise(
            F.struct(acc["n"].alias("n"), acc["chars"].alias("chars"), F.lit(False).alias("open"))
        )

    return F.aggregate(F.reverse(lengths), start, step)


# Sentences folded together before their finished ranges join the others.  Spark copies
# the state of a fold at every step, so the state has to stay small in long texts.
_FOLD_BLOCK = 1024


def chunk_ranges(lengths: Column, chunk_size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Sentence ranges ``(first, n)`` of the chunks, from the sentence lengths.

    One pass over the sentences, in blocks.  The state of a block holds the ranges
    finished in it and the lengths in the open chunk, not those of the whole text.
    """
    no_ranges = F.array().cast("array<struct<first:int,n:int>>")

    def state(done: Column, first: Column, held: Column, chars: Column) -> Column:
        return F.struct(
            done.alias("done"), first.alias("first"), held.alias("held"), chars.alias("chars")
        )

    def cut(acc: Column, length: Column, tail: Column) -> Column:
        n = F.size(acc["held"])
        return state(
            F.concat(acc["done"], F.array(F.struct(acc["first"].alias("first"), n.alias("n")))),
            acc["first"] + n - tail["n"],
            F.concat(F.slice(acc["held"], n - tail["n"] + 1, tail["n"]), F.array(length)),
            tail["chars"] + length,
        )

    def add(acc: Column, length: Column) -> Column:
        full = (F.size(acc["held"]) > 0) & (acc["chars"] + length > chunk_size)
        grown = state(
            acc["done"], acc["first"], F.concat(acc["held"], F.array(length)), acc["chars"] + length
        )
        return F.when(
            full, let(_kept_tail(acc["held"], overlap), lambda tail: cut(acc, length, tail))
        ).otherwise(grown)

    def add_block(acc: Column, block: Column) -> Column:
        opened = state(no_ranges, acc["first"], acc["held"], acc["chars"])
        return let(
            F.aggregate(block, opened, add),
            lambda b: state(F.concat(acc["done"], b["done"]), b["first"], b["held"], b["chars"]),
        )

    def finish(acc: Column) -> Column:
        last = F.struct(acc["first"].alias("first"), F.size(acc["held"]).alias("n"))
        return F.concat(acc["done"], F.array(last))

    def fold(all_lengths: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(all_lengths), F.lit(_FOLD_BLOCK))
        blocks = F.transform(starts, lambda i: F.slice(all_lengths, i, F.lit(_FOLD_BLOCK)))
        empty = state(no_ranges, F.lit(0), F.array().cast("array<int>"), F.lit(0))
        return F.aggregate(blocks, empty, add_block, finish)

    return let(lengths, fold)


def chunk_text(text: Column | str, chunk_size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Overlapping, sentence-aligned chunks of a text, in order.

    Sentences are packed until the next one would push the sum of their lengths
    over ``chunk_size``; joining spaces do not count.  The next chunk repeats the
    longest run of last sentences that stays strictly below ``overlap``.
    Sentences are never cut, so a chunk can exceed ``chunk_size``.
    """

    def assemble(sentences: Column) -> Column:
        ranges = chunk_ranges(F.transform(sentences, F.length), chunk_size, overlap)
        return F.transform(
            ranges, lambda r: F.array_join(F.slice(sentences, r["first"] + 1, r["n"]), " ")
        )

    return let(split_sentences(text), assemble)


def safe_title(title: Column | str) -> Column:
    """Letters, digits and spaces of a title, right-trimmed: the stem of its files.

    The long lists of rare characters are looked at only for a character that the
    common classes do not hold.
    """
    dropped = rf"(?s)(?=[^\p{{L}}\p{{Nd}} ])(?![{OTHER_DIGITS}{NEWER_LETTERS}])."
    return F.rtrim(F.regexp_replace(_col(title), dropped, ""))


def chunk_id(filename: Column | str, chunk_ix: Column | str) -> Column:
    """``My file.txt``, 3 -> ``My_file_3``."""
    name = F.replace(F.replace(_col(filename), F.lit(" "), F.lit("_")), F.lit(".txt"), F.lit(""))
    return F.concat(name, F.lit("_"), _col(chunk_ix).cast("string"))


def stem_path(path: Column | str, old: str, new: str) -> Column:
    """Swap a suffix.  Case-sensitive, and every occurrence is replaced."""
    return F.replace(_col(path), F.lit(old), F.lit(new))

"""Harmonic packing of documents into fixed-length sequences.

A document is the ids of its text and one end id.  It is cut into whole sequences and a rest.
A length that lies in the reciprocal class *j* (between ``capacity / (j + 1)`` and
``capacity / j``) shares a sequence with *j* - 1 others of its class.  A rest stays in one
piece if *j* of its length leave at most ``slack`` ids open; otherwise the largest power of
two is cut off, which fills its class exactly, and the remainder is looked at again.  So a
class's sequences take a fixed number of pieces and are never more than ``slack`` short.

Every task fills the sequences of its own documents and needs to know nothing of the others.
What it holds at any time is one open sequence per class.  Those that are still open at its
end are filled up in the same way over all tasks, which leaves one open sequence per class;
these few pieces are cut freely into full sequences and at last powers of two, which need no
padding.

Texts are encoded by ``tokenizers``.  A text is first split where the encoder never joins, mostly
into words, and every distinct part is encoded once per Python worker, so a very long text
is never encoded at once and a frequent word costs a lookup.

Nulls and edge cases: a null or empty text is the end id alone.  Bytes that are no UTF-8 are
read as replacement characters.  Strings that look like special tokens are ordinary text
unless ``special_as_text`` is off.  Rows that repeat, also with a null id, are each packed;
other columns are ignored.  An empty table gives no pieces.  Sequence ids are unique but not
dense, and follow the partitions of the table.
"""

from __future__ import annotations

import functools
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonotheca.llm.words import GROUP_BYTES, groups, mixed
from sonotheca.session import written

CAPACITY = 1024
SLACK = 16
END = 0
KNOWN_PARTS = 2_000_000
_FLUSH = 1 << 20
_SHARD = 1 << 32
_SHARED, _LAST = (1 << 30) * _SHARD, (1 << 30) * _SHARD + (1 << 29) * _SHARD

# Classes of characters up to Cyrillic as the encoder's first split sees them; all others, control
# characters and the wide spaces are of no known class, and nothing is cut beside them.
_LETTER, _NUMBER, _SIGN, _SPACE, _BREAK = 1, 2, 3, 4, 5
_KNOWN = 0x530
_CLASS = np.zeros(_KNOWN + 1, dtype=np.int8)
for _code in range(0x21, _KNOWN):
    _kind = unicodedata.category(chr(_code))[0]
    _CLASS[_code] = {"L": _LETTER, "N": _NUMBER, "M": _SIGN, "P": _SIGN, "S": _SIGN}.get(_kind, 0)
_CLASS[0x20] = _SPACE
_CLASS[[0x09, 0x0A, 0x0D]] = _BREAK
_APOSTROPHE = 0x27

_COLUMNS = [
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()), T.StructField("shard", T.LongType()), T.StructField("per", T.IntegerType()),
    T.StructField("slot", T.LongType()),
]


def part_starts(codes: np.ndarray) -> np.ndarray:
    """Where a text, given as code points, may be cut so that its parts encode as they do in it.

    The encoder never joins letters, digits, signs and white space, but for one space before
    a word and for an apostrophe with letters behind it.  How it takes a run of white space
    depends on what follows, so only a single line break or tab is cut off from what is behind it.
    """
    kind = _CLASS[np.minimum(codes, _KNOWN)]
    before, here = kind[:-1], kind[1:]
    blank = (before == _SPACE) | (before == _BREAK)
    alone = np.ones(len(before), dtype=bool)  # a break that follows no white space and nothing unknown
    alone[1:] = (kind[:-2] == _LETTER) | (kind[:-2] == _NUMBER) | (kind[:-2] == _SIGN)
    parted = (before != here) & (here > 0) & np.where(blank, (before == _BREAK) & alone & (here != _SPACE), before > 0)
    parted &= ~((codes[:-1] == _APOSTROPHE) & (here == _LETTER))
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(codes)), dtype=bool), parted)))


class Encoder:
    """Texts to little-endian 32-bit ids; every distinct part of all texts is encoded once.

    Parts are known by two 64-bit hashes.  What is known is kept sorted in arrays of numbers, and
    is forgotten when it exceeds ``most`` parts.
    """

    def __init__(self, path: str, special_as_text: bool = True, most: int = KNOWN_PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = special_as_text
        self.special = [] if special_as_text else [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.most = most
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty((2, 0), np.uint64)
        self.begins, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, "<u4")

    def _learn(self, keys: np.ndarray, parts: list[str]) -> None:
        """Add parts; each is split by itself, and the numbers of the parts come back with the ids."""
        ids, counts = [self.ids], []
        for at in range(0, len(parts), 1 << 14):
            run = parts[at:at + (1 << 14)]
            found = self.model.encode(run, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, dtype="<u4"))
            counts.append(np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(run)))
        counts = np.concatenate(counts)
        begins = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate(ids)
        place = np.searchsorted(self.keys[0], keys[0])
        self.keys = np.insert(self.keys, place, keys, axis=1)
        self.begins, self.counts = np.insert(self.begins, place, begins), np.insert(self.counts, place, counts)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of keys among the known ones, and which of them are known."""
        place = np.minimum(np.searchsorted(self.keys[0], keys[0]), max(0, self.keys.shape[1] - 1))
        if not self.keys.shape[1]:
            return place, np.zeros(keys.shape[1], dtype=bool)
        return place, (self.keys[:, place] == keys).all(axis=0)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        if any(special in text for special in self.special for text in texts):
            return [np.array(self.model.encode(t, add_special_tokens=False).ids, dtype="<u4") for t in texts]
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype="<u4")
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        cuts, at = [], 0
        for end in ends:
            cuts.append(part_starts(codes[at:end]) + at)
            at = end
        starts = np.concatenate([*cuts, np.empty(0, np.int64)]).astype(np.int64)
        if not len(starts):
            return [self.ids[:0]] * len(texts)
        stops = np.append(starts[1:], len(codes))
        keys = np.stack([_hashes(codes, starts, stops, odd) for odd in _ODDS])
        _, first, which = np.unique(keys[0], return_index=True, return_inverse=True)
        own = keys[:, first]
        if self.keys.shape[1] + len(first) > self.most:
            self._forget()
        _, known = self._find(own)
        if not known.all():
            new = first[~known]
            self._learn(own[:, ~known], [joined[a:b] for a, b in zip(starts[new].tolist(), stops[new].tolist())])
        place, known = self._find(own)
        if not known.all() or (keys[1] != own[1][which]).any():  # two parts share the first hash
            return [np.array(self.model.encode(t, add_special_tokens=False).ids, dtype="<u4") for t in texts]
        begins, counts = self.begins[place][which], self.counts[place][which]
        done = np.cumsum(counts)
        every = self.ids[np.repeat(begins - (done - counts), counts) + np.arange(done[-1])]
        parts_before = np.searchsorted(starts, np.concatenate(([0], ends)))
        return np.split(every, np.concatenate(([0], done))[parts_before[1:-1]]) if len(texts) > 1 else [every]


_ODDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _hashes(codes: np.ndarray, starts: np.ndarray, stops: np.ndarray, odd: np.uint64) -> np.ndarray:
    """A hash of every part, from prefix sums of code * odd**position; ``codes`` up to some megabytes."""
    n = len(codes)
    if int(odd) not in _powers or len(_powers[int(odd)][0]) < n:
        inverse = np.uint64(pow(int(odd), -1, 1 << 64))
        tables = []
        for base in (odd, inverse):
            steps = np.full(n + n // 8 + 1, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[int(odd)] = tuple(tables)
    up, down = _powers[int(odd)]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64)))
    return mixed((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))


@functools.lru_cache(maxsize=2)
def _encoder(path: str, special_as_text: bool) -> Encoder:
    return Encoder(path, special_as_text)


def cuts(total: int, capacity: int = CAPACITY, slack: int = SLACK) -> Iterator[tuple[int, int]]:
    """Lengths of the pieces of a document of ``total`` ids, each with its class."""
    for _ in range(total // capacity):
        yield capacity, 1
    rest = total % capacity
    while rest:
        per = capacity // rest
        length = rest if per * rest >= capacity - slack else 1 << (rest.bit_length() - 1)
        yield length, capacity // length
        rest -= length


class _Rows:
    """Pieces on their way out, in batches of about a megabyte."""

    def __init__(self, id_type: pa.DataType):
        self.schema = pa.schema([("id", id_type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                                 ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                                 ("shard", pa.int64()), ("per", pa.int32()), ("slot", pa.int64())])
        self.rows, self.size = [], 0

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        self.size += len(row[3]) + 64

    def full(self) -> bool:
        return self.size > _FLUSH

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[]] * len(self.schema)
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
        self.rows, self.size = [], 0
        return out


def _encoded(encoder: Encoder, batch: pa.RecordBatch) -> Iterator[tuple[object, np.ndarray]]:
    """The id column and the ids of every row, encoded in groups of about a megabyte."""
    for first, texts in groups(batch.column(1), GROUP_BYTES):
        keys = batch.column(0).slice(first, len(texts)).to_pylist()
        yield from zip(keys, encoder.encode([t.decode("utf-8", "replace") for t in texts]))


def _piece_rows(
    path: str, special_as_text: bool, capacity: int, slack: int, end: int, batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    encoder, shard = _encoder(path, special_as_text), TaskContext.get().partitionId()
    out, filled, waiting = None, 0, {}
    ending = end.to_bytes(4, "little")
    for batch in batches:
        out = out or _Rows(batch.schema.field(0).type)
        for key, ids in _encoded(encoder, batch):
            ids = ids.tobytes() + ending
            total, start = len(ids) // 4, 0
            for length, per in cuts(total, capacity, slack):
                pieces = waiting.setdefault(per, [])
                pieces.append((key, start, length, ids[4 * start:4 * (start + length)], total))
                start += length
                if len(pieces) == per:
                    offset = 0
                    for slot, piece in enumerate(pieces):
                        out.add((*piece, shard * _SHARD + filled, offset, shard, per, slot))
                        offset += piece[2]
                    filled += 1
                    pieces.clear()
                    if out.full():
                        yield out.batch()
    if out:
        for per, pieces in waiting.items():
            for slot, piece in enumerate(pieces):
                out.add((*piece, None, None, shard, per, slot))
        yield out.batch()


def _cut_freely(capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last open sequence of every class, cut into full sequences and powers of two."""
    rows, out = [], None
    for batch in batches:
        out = out or _Rows(batch.schema.field(0).type)
        rows += zip(*(c.to_pylist() for c in batch.columns))
    if not rows:
        return
    rows.sort(key=lambda r: (-r[8], r[9]))  # classes from the shortest pieces on, so that long ones are cut
    total = sum(r[2] for r in rows)
    ends = list(range(capacity, total + 1, capacity))
    while (done := ends[-1] if ends else 0) < total:
        ends.append(done + (1 << ((total - done).bit_length() - 1)))
    place, at = 0, 0
    for key, start, length, ids, doc_tokens, _, _, shard, per, slot in rows:
        taken = 0
        while taken < length:
            step = min(length - taken, ends[place] - at)
            offset = at - (ends[place - 1] if place else 0)
            out.add((key, start + taken, step, ids[4 * taken:4 * (taken + step)], doc_tokens, _LAST + place, offset, shard, per, slot))
            taken, at = taken + step, at + step
            place += at == ends[place]
    yield out.batch()


def packed(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    capacity: int = CAPACITY, slack: int = SLACK, end: int = END, special_as_text: bool = True,
) -> DataFrame:
    """``id, start, length, ids, doc_tokens, sequence_id, offset``: one row for every piece.

    ``vocabulary`` is the path of a tokenizer file that every worker can read; ``capacity`` is a
    power of two.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    names = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType([T.StructField("id", own.schema["id"].dataType), *_COLUMNS])
    made = written(own.mapInArrow(
        functools.partial(_piece_rows, vocabulary, special_as_text, capacity, slack, end), schema), "pieces")

    # what tasks left open: at most one sequence for each class and task
    waiting = made.where(F.col("sequence_id").isNull())
    left = waiting.groupBy("per", "shard").agg(F.count("*").alias("_own"))
    classes = Window.partitionBy("per")
    before = left.select(
        "per", "shard", F.sum("_own").over(classes).alias("_all"),
        (F.sum("_own").over(classes.orderBy("shard")) - F.col("_own")).alias("_before"))
    placed = (
        waiting.join(before, ["per", "shard"])
        .withColumn("slot", F.col("_before") + F.col("slot"))
        .withColumn("_bin", F.floor(F.col("slot") / F.col("per")))
    )
    placed = written(placed, "waiting")
    is_full = (F.col("_bin") + 1) * F.col("per") <= F.col("_all")
    in_bin = Window.partitionBy("per", "_bin").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    shared = (
        placed.where(is_full)
        .withColumn("sequence_id", F.lit(_SHARED) + F.col("per").cast("bigint") * _SHARD + F.col("_bin"))
        .withColumn("offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0)))
    )
    # less than one sequence for each class, whatever the number of rows
    last = (placed.where(~is_full).select(schema.names).repartition(1)
            .mapInArrow(functools.partial(_cut_freely, capacity), schema))
    return (made.where(F.col("sequence_id").isNotNull()).select("id", *names)
            .unionByName(shared.select("id", *names)).unionByName(last.select("id", *names)))


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad: int = END) -> DataFrame:
    """``sequence_id, length, ids, parts``: whole sequences, padded unless their length is a power of two.

    A sequence holds at most ``capacity`` pieces.  ``parts`` lists ids and positions of its documents.
    """
    part = F.struct("offset", "length", "id", "start", "ids")
    whole = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.array_sort(F.collect_list(part)).alias("_parts"))
    joined = F.aggregate("_parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"]))
    power = F.bit_count("length") == 1
    padding = F.unhex(F.repeat(F.lit(pad.to_bytes(4, "little").hex()), (F.lit(capacity) - F.col("length")).cast("int")))
    return whole.select(
        "sequence_id", "length", F.when(power, joined).otherwise(F.concat(joined, padding)).alias("ids"),
        F.transform("_parts", lambda p: F.struct(p["id"].alias("id"), p["start"].alias("start"), p["length"].alias("length"),
                                                 p["offset"].alias("offset"))).alias("parts"))

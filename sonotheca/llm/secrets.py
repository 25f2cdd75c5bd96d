"""Secret scan with a recursive decoding worklist.

A text is a layer.  Every layer is scanned for secrets and unwrapped: percent escapes and
Unicode escapes anywhere in it give a decoded copy; runs of base64, also wrapped in lines
or with other characters before them, give bytes.  Of bytes, each readable piece (UTF-8, or
UTF-16 of ASCII characters) is a layer, and gzip or zlib data anywhere in them, of one or more
members, gives bytes again.  Layers and bytes go through one worklist until nothing new
appears; what was seen before (same content from the same place) is not entered again, which
also ends cycles.  Each layer keeps, for every character, where in the original text it comes
from, so every finding maps to a span of the original.

The work is done per row in Arrow batches and shuffles nothing.  Its time follows the length
of the layers: runs are decoded once for each of four offsets, and places are looked up only
for pieces that are found.  A compressed stream is inflated in parts of at most
``MOST_INFLATED`` bytes, each looked through before the next is inflated; parts share
``OVERLAP`` bytes, so what is shorter is found whole.  A stream of several parts is also
reported as an ``oversize`` span, since data inside it that is compressed once more and longer
than a part is read to the end of the part only.

Nulls and edge cases: a null text counts as empty and has no spans.  Repeated rows are
reported each.  Spans of one kind, start and end are reported once, whichever layer they
were found in.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_INFLATED = 64 << 20
OVERLAP = 1 << 20
_FED = 1 << 16
KINDS = ("assign", "access", "hex", "oversize")

# What counts as a secret.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
LEAST_ASSIGNED = 12
#: Runs are taken whole, so asking for the least length equals dropping shorter ones.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
#: The shortest secret has 16 characters, which base64 makes 22.
#: A run may be wrapped in lines of 22 characters or more, of which the last may be shorter.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{22,}(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]{22,})*(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]{1,21}(?![^\s=]))?={0,2}")
#: Where gzip or zlib data may start: of any window, without a preset dictionary, with the header's check right.
_PACKED = re.compile(rb"\x1f\x8b\x08|" + b"|".join(
    re.escape(bytes((method, flags))) for method in range(0x08, 0x80, 0x10) for flags in range(256)
    if (method << 8 | flags) % 31 == 0 and not flags & 0x20))
_ASCII_16 = tuple(re.compile(p) for p in (rb"(?:[\t\n\r\x20-\x7e]\x00){16,}", rb"(?:\x00[\t\n\r\x20-\x7e]){16,}"))
_URL_SAFE = bytes.maketrans(b"-_", b"+/")
#: UTF-8 without control characters other than white space, as long as the shortest secret.
_READABLE = re.compile(rb"(?:[\t-\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
                       rb"|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){16,}")


class Layer:
    """Text and where its characters come from: each its own range, all the same one, or the text itself."""

    __slots__ = ("text", "starts", "ends", "whole")

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None,
                 whole: tuple[int, int] | None = None):
        self.text, self.starts, self.ends, self.whole = text, starts, ends, whole

    def origin(self, a: int, b: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        if self.starts is None:
            return a, b
        return int(self.starts[a]), int(self.ends[b - 1])

    def origins(self) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of all characters; worked out once."""
        if self.starts is None:
            at = np.arange(len(self.text))
            self.starts, self.ends = at, at + 1
        return self.starts, self.ends


class Data:
    """Decoded bytes, and the range of the original that they come from."""

    __slots__ = ("content", "whole")

    def __init__(self, content: bytes, whole: tuple[int, int]):
        self.content, self.whole = content, whole


def scan(text: str) -> Iterator[tuple[str, int, int]]:
    """Secrets in one layer: kind, start, end."""
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= LEAST_ASSIGNED:
            yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end()


def _rewritten(layer: Layer, found: Iterator[tuple[int, int, str]]) -> Layer | None:
    """A copy of the layer with each (start, end) replaced; a replacement's characters share the range."""
    texts, lows, highs, at = [], [], [], 0
    if layer.whole:
        for a, b, new in found:
            texts += [layer.text[at:a], new]
            at = b
        return Layer("".join([*texts, layer.text[at:]]), whole=layer.whole) if texts else None
    starts, ends = layer.origins()
    for a, b, new in found:
        texts += [layer.text[at:a], new]
        lows += [starts[at:a], np.full(len(new), starts[a])]
        highs += [ends[at:a], np.full(len(new), ends[b - 1])]
        at = b
    if not texts:
        return None
    texts.append(layer.text[at:])
    lows.append(starts[at:])
    highs.append(ends[at:])
    return Layer("".join(texts), np.concatenate(lows), np.concatenate(highs))


def _percent(layer: Layer) -> Layer | None:
    """Percent escapes decoded as UTF-8; escapes that are none stay as they are.

    Each decoded character is mapped to its own escapes.
    """
    def found():
        for m in PERCENT.finditer(layer.text):
            raw = bytes.fromhex(m[0].replace("%", ""))
            at = 0
            while at < len(raw):
                for size in (1, 2, 3, 4):
                    try:
                        new = raw[at:at + size].decode()
                    except UnicodeDecodeError:
                        continue
                    if new:
                        yield m.start() + 3 * at, m.start() + 3 * (at + size), new
                        at += size
                        break
                else:
                    at += 1

    return _rewritten(layer, found()) if "%" in layer.text else None


def _unicode(layer: Layer) -> Layer | None:
    """Unicode escapes and numeric character references decoded; surrogate pairs are joined."""
    if "\\" not in layer.text and "&#" not in layer.text:
        return None

    def found():
        high = None
        for m in UNICODE.finditer(layer.text):
            code = int(m[6]) if m[6] else int(next(g for g in m.groups() if g), 16)
            if 0xD800 <= code < 0xDC00:
                high = (m.start(), m.end(), code)
                continue
            if 0xDC00 <= code < 0xE000:
                if high and high[1] == m.start():
                    yield high[0], m.end(), chr(0x10000 + ((high[2] - 0xD800) << 10) + code - 0xDC00)
                high = None
                continue
            high = None
            if code < 0x110000:
                yield m.start(), m.end(), chr(code)

    return _rewritten(layer, found())


def _inflated(data: memoryview, at: int, most: int) -> Iterator[bytes | int]:
    """The parts of the compressed data at ``at``, all members, and at last where it ends; nothing if it is none.

    A part is cut where it exceeds ``most``, and begins with the last ``OVERLAP`` bytes of the one before.
    """
    out, size, end, shared = [], 0, None, min(OVERLAP, most // 4)
    while _PACKED.match(data, at):
        stream, fed = zlib.decompressobj(47), at
        try:
            while not stream.eof and (fed < len(data) or stream.unconsumed_tail):
                given = stream.unconsumed_tail or data[fed:fed + _FED]
                fed += 0 if stream.unconsumed_tail else len(given)
                out.append(stream.decompress(given, most + 1 - size))
                size += len(out[-1])
                if size > most:
                    part = b"".join(out)
                    yield part
                    out, size = [part[-shared:]], shared
        except zlib.error:
            pass
        if not stream.eof and not size:
            break
        end = at = fed - len(stream.unused_data) - len(stream.unconsumed_tail) if stream.eof else fed
    if end is not None:
        yield b"".join(out)
        yield end


def _opened(data: Data, most: int) -> Iterator[Layer | Data | tuple[int, int]]:
    """What is inside bytes: readable pieces, the contents of compressed data, and the origin of streams in parts."""
    content = memoryview(data.content)
    for piece in _READABLE.finditer(data.content):
        yield Layer(piece[0].decode(), whole=data.whole)
    for order, pattern in enumerate(_ASCII_16):
        for piece in pattern.finditer(data.content):
            yield Layer(piece[0][order::2].decode(), whole=data.whole)
    at = 0
    while found := _PACKED.search(content, at):
        at, parts = found.start() + 1, 0
        for part in _inflated(content, found.start(), most):
            if isinstance(part, int):
                at = max(at, part)
            elif part:
                parts += 1
                yield Data(part, data.whole)
        if parts > 1:
            yield data.whole


def _base64(layer: Layer) -> Iterator[Layer | Data]:
    """What runs of base64 decode to: readable pieces with the place of each character, and bytes that may be compressed.

    A run may start with other characters of the alphabet, so it is decoded from each of its
    first four.  Line breaks inside a run are left out.
    """
    for m in BASE64.finditer(layer.text):
        raw = m[0].encode()
        run = raw.translate(_URL_SAFE, b" \t\r\n=")
        for offset in range(4):
            size = len(run) - offset
            size -= size % 4 == 1
            part = run[offset:offset + size]
            data = base64.b64decode(part + b"=" * (-size % 4))
            if _PACKED.search(data):
                yield Data(data, layer.origin(m.start(), m.end()))
            for piece in _READABLE.finditer(data):
                text = piece[0].decode()
                widths = np.ones(len(text), np.int64) if text.isascii() else np.fromiter((len(c.encode()) for c in text), np.int64, len(text))
                yield _placed(layer, m.start(), raw, offset, size, text, piece.start(), widths)
            for order, pattern in enumerate(_ASCII_16):
                for piece in pattern.finditer(data):
                    text = piece[0][order::2].decode()
                    yield _placed(layer, m.start(), raw, offset, size, text, piece.start(), np.full(len(text), 2))


def _placed(layer: Layer, start: int, raw: bytes, offset: int, size: int, text: str, at: int, widths: np.ndarray) -> Layer:
    """A layer of ``text``, whose characters take ``widths`` bytes from byte ``at`` on of what a run decodes to."""
    if layer.whole:
        return Layer(text, whole=layer.whole)
    last = at + np.cumsum(widths) - 1
    first = last - widths + 1
    # byte i comes from characters i * 4 // 3 and (i * 4 + 4) // 3 of the part
    a, b = first[0] * 4 // 3, min(int(last[-1] * 4 + 4) // 3, size - 1)
    solid = np.frombuffer(raw, np.uint8)
    if len(raw) > offset + size + 2:  # wrapped in lines
        own = start + np.flatnonzero(~np.isin(solid, np.frombuffer(b" \t\r\n=", np.uint8)))[offset + a:offset + b + 1]
    else:
        own = start + np.arange(offset + a, offset + b + 1)
    starts, ends = layer.origins()
    return Layer(text, starts[own[first * 4 // 3 - a]], ends[own[np.minimum((last * 4 + 4) // 3, size - 1) - a]])


def _unwrapped(layer: Layer) -> Iterator[Layer | Data]:
    for new in (_percent(layer), _unicode(layer)):
        if new is not None:
            yield new
    yield from _base64(layer)


def find(text: str, most: int = MOST_INFLATED) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int]:
    """Base spans of the text itself, all spans, and how many layers were unwrapped."""
    base = sorted(scan(text), key=_order)
    spans, seen, layers = set(base), set(), 0
    work = [_unwrapped(Layer(text))]
    while work:
        # one item at a time: what it holds is looked through before the next is decoded
        new = next(work[-1], None)
        if new is None:
            work.pop()
        elif isinstance(new, tuple):
            spans.add(("oversize", *new))
        else:
            is_data = isinstance(new, Data)
            content = new.content if is_data else new.text.encode("utf-8", "surrogatepass")
            place = new.whole if is_data else new.origin(0, len(new.text)) if new.text else None
            mark = hashlib.blake2b(content, digest_size=16).digest(), is_data, place
            if mark in seen:
                continue
            seen.add(mark)
            if is_data:
                work.append(_opened(new, most))
                continue
            layers += 1
            spans.update((kind, *new.origin(a, b)) for kind, a, b in scan(new.text))
            work.append(_unwrapped(new))
    return base, sorted(spans, key=_order), layers


def _order(span: tuple[str, int, int]) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def _find_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    as_rows = lambda found: [{"kind": k, "start": a, "end": b} for k, a, b in found]
    for batch in batches:
        base, spans, layers = [], [], []
        for text in batch.column(1):
            own, every, n = find(text.as_py() or "")
            base.append(as_rows(own))
            spans.append(as_rows(every))
            layers.append(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(base, pa.list_(span)), pa.array(spans, pa.list_(span)), pa.array(layers, pa.int64())],
            names=["id", "base", "spans", "layers"])


def secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``base`` and ``spans`` (kind, start, end in characters) and ``layers`` unwrapped, per row."""
    span = "ARRAY<STRUCT<kind: STRING, start: BIGINT, end: BIGINT>>"
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           *T.StructType.fromDDL(f"base {span}, spans {span}, layers BIGINT").fields])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_find_rows, schema)

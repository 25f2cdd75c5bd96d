"""Expressions over audio listings: suffix, format, size class, part names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonotheca.fixed_values import AUDIO_SUFFIXES, MAX_UPLOAD_BYTES, SAFE_UPLOAD_MIB, TOO_LARGE, UNSUPPORTED
from sonotheca.functions.text import _col


def suffix(path: Column | str) -> Column:
    """Last suffix of the file name with its case; hidden files like ``.mp3`` have none."""
    return F.regexp_extract(_col(path), r"[^/](\.[^./]+)$", 1)


def stem(path: Column | str) -> Column:
    """File name without its last suffix."""
    name = F.regexp_extract(_col(path), r"([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^./]+$", "")


def is_audio(path: Column | str) -> Column:
    return F.lower(suffix(path)).isin(*AUDIO_SUFFIXES)


def format_error(path: Column | str) -> Column:
    """Null for a supported format, otherwise the reason it is refused."""
    return F.when(
        ~is_audio(path), F.concat(F.lit(UNSUPPORTED), F.lower(suffix(path)))
    )


def size_class(n_bytes: Column | str, auto_split: bool = True) -> Column:
    """``single`` up to and including the upload limit, beyond it ``split`` or ``too_large``."""
    beyond = F.lit("split" if auto_split else "too_large")
    return F.when(_col(n_bytes) > MAX_UPLOAD_BYTES, beyond).otherwise(F.lit("single"))


def size_error(n_bytes: Column | str, auto_split: bool = True) -> Column:
    """Null when the size can be handled, otherwise the reason it cannot."""
    mib = F.format_string("%.1f", _col(n_bytes) / F.lit(1048576.0))
    return F.when(
        size_class(n_bytes, auto_split) == "too_large",
        F.concat(F.lit(TOO_LARGE[0]), mib, F.lit(TOO_LARGE[1])),
    )


def needs_splitting(n_bytes: Column | str, max_mib: float = SAFE_UPLOAD_MIB) -> Column:
    return _col(n_bytes) / F.lit(1048576.0) > F.lit(float(max_mib))


def part_name(path: Column | str, part_ix: Column | str) -> Column:
    """``talk.mp3``, 7 -> ``talk_chunk007.mp3``."""
    return F.format_string("%s_chunk%03d%s", stem(path), _col(part_ix), suffix(path))


def transcript_path(path: Column | str, input_dir: str, output_dir: str) -> Column:
    """Where the text of a recording goes: the same relative path with suffix ``.txt``."""
    start = len(input_dir.rstrip("/")) + 1
    relative = F.substring(_col(path), start + 1, 2**31 - 1 - start)
    return F.concat(
        F.lit(output_dir.rstrip("/") + "/"),
        F.regexp_replace(relative, r"(?<=[^/])\.[^./]+$", ""), F.lit(".txt"),
    )

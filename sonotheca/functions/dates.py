"""Publication dates: feed text to instants, instants to ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonotheca.functions.text import _col, let, strip

# Date layouts found in feeds, tried in this order.
_FEED_LAYOUTS = (
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy HH:mm:ss z",
    "d MMM yyyy HH:mm Z",
    "d MMM yyyy HH:mm z",
    "d MMM yy HH:mm:ss Z",
    "d MMM yy HH:mm:ss z",
)
_ISO_LAYOUT = "yyyy-MM-dd'T'HH:mm:ss"
_HAS_ZONE = r"([+-]\d{2}:?\d{2}|[A-Za-z]+)$"


def parse_published(published: Column | str) -> Column:
    """Instant of a feed date (RFC 822 or ISO 8601), null when absent or unreadable.

    The weekday is dropped before parsing, and a date without zone counts as UTC.
    """
    bare = F.regexp_replace(strip(published), r"^[A-Za-z]+,?\s+", "")
    zoned = F.when(bare.rlike(_HAS_ZONE), bare).otherwise(F.concat(bare, F.lit(" +0000")))
    zoned = F.regexp_replace(F.regexp_replace(zoned, r"\b(UT|Z)$", "+0000"), r"\s+", " ")
    tried = let(
        zoned, lambda d: F.coalesce(*(F.try_to_timestamp(d, F.lit(f)) for f in _FEED_LAYOUTS))
    )
    return F.when(bare.rlike(r"^\d{4}-"), parse_iso(bare)).otherwise(tried)


def parse_iso(text: Column | str) -> Column:
    """Instant of ISO text; unreadable text gives null instead of an error."""
    return _col(text).try_cast("timestamp")


def published_iso(ts: Column | str) -> Column:
    """ISO text to the second, null stays null."""
    return F.date_format(_col(ts), _ISO_LAYOUT)

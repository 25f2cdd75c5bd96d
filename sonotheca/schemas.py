"""Fixed schemas of every table; nothing is inferred at read time."""

from pyspark.sql import types as T

_STR, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_BOOL, _TIME = T.BooleanType(), T.TimestampType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


LINKS = T.ArrayType(_schema(type=_STR, href=_STR))
#: The fixed fields of a segment, and ``other``: every further key of the response, as it came.
_OTHER = T.MapType(_STR, T.VariantType())
SEGMENTS = T.ArrayType(_schema(start=_DOUBLE, end=_DOUBLE, text=_STR, other=_OTHER))
_FIXED_SEGMENTS = T.ArrayType(_schema(start=_DOUBLE, end=_DOUBLE, text=_STR))
_ENCLOSURES = T.ArrayType(_schema(_url=_STR, _type=_STR, _length=_LONG))
_ENTRIES = T.ArrayType(_schema(title=_STR, pubDate=_STR, link=_STR, enclosure=_ENCLOSURES))

FEED_CHANNEL = _schema(title=_STR, item=_ENTRIES)
FEED_ITEMS = _schema(
    feed_id=_STR, feed_title=_STR, feed_pos=_INT, title=_STR, links=LINKS, published_ts=_TIME
)
FETCH_LOG = _schema(audio_url=_STR, status=_INT, content_type=_STR, content_length=_LONG, head=_STR)
CATALOGUE = _schema(query_title=_STR, rank=_INT, title=_STR, show=_STR, url=_STR)
EPISODE = _schema(
    title=_STR, podcast=_STR, audio_url=_STR, spotify_url=_STR, published_date=_STR
)
RESPONSE = _schema(text=_STR, language=_STR, duration=_DOUBLE, segments=_FIXED_SEGMENTS)
PART_RESULTS = _schema(
    file=_STR, part_ix=_INT, text=_STR, duration=_DOUBLE, language=_STR, segments=_FIXED_SEGMENTS
)
ATTEMPTS = _schema(item=_STR, service=_STR, attempt=_INT, error=_STR)
CALLS = _schema(account=_STR, ts=_TIME, audio_seconds=_DOUBLE)
LISTING = _schema(path=_STR, modificationTime=_TIME, length=_LONG)
TRANSCRIPTS = _schema(
    collection=_STR, stem=_STR, audio_url=_STR, metadata=EPISODE, published_ts=_TIME, text=_STR,
    blank=_BOOL, error=_STR, batch_seq=_LONG,
)
COLLECTIONS = _schema(collection=_STR, model=_STR)
CHUNKS = _schema(
    collection=_STR, batch_seq=_LONG, id=_STR, document=_STR, embedding=T.ArrayType(_DOUBLE),
    model=_STR, metadata=EPISODE,
)
MERGED = _schema(bucket=_INT, after=_LONG, upto=_LONG, version=_LONG, rows=_LONG)
REPLAYS = _schema(batch_seq=_LONG, version=_LONG)
RUNS = _schema(batch_seq=_LONG, source=_STR)
FAILURES = _schema(collection=_STR, stem=_STR, failure=_STR, batch_seq=_LONG)
MARKS = _schema(collection=_STR, published_ts=_TIME)
STORED_MARKS = _schema(collection=_STR, published_ts=_TIME, batch_seq=_LONG)
QUERIES = _schema(qid=_LONG, text=_STR, model=_STR)

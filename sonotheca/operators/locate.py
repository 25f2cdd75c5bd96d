"""Rows by the place they are stored at: which file, and which row of it."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE, ROW = "_file", "_row"
#: More files than this are not named one by one.
MOST_FILES = 10_000


def located(scan: DataFrame) -> DataFrame:
    """A scan of Parquet files with ``_file`` and ``_row``, the place of every row.

    Both come from the reader and cost no column of the file.
    """
    return scan.withColumns({FILE: F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index")})


def is_located(rows: DataFrame) -> bool:
    return FILE in rows.columns and ROW in rows.columns


def fetch(hits: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame | None:
    """``hits`` with ``columns`` of the rows they name, read from the files that hold them only.

    ``hits`` is a small table with ``_file`` and ``_row``, ``table`` tells the types.  None if there
    are too many files, so that the caller joins the whole table instead.
    """
    files = [r[0] for r in hits.select(FILE).distinct().limit(MOST_FILES + 1).collect()]
    if len(files) > MOST_FILES:
        return None
    return hits.join(_rows_of(hits.sparkSession, files, table.select(*columns)), [FILE, ROW])


def _rows_of(spark: SparkSession, files: list[str], like: DataFrame) -> DataFrame:
    if not files:
        place = T.StructType().add(FILE, T.StringType()).add(ROW, T.LongType())
        return spark.createDataFrame([], T.StructType(like.schema.fields + place.fields))
    # file names come percent-encoded
    return located(spark.read.schema(like.schema).parquet(*(unquote(f) for f in files)))

"""First rows per key, written so that the limit applies before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Spark prunes ranks before the shuffle below this limit only.
PRUNED_BELOW = 1000
SALTS = 64


def first_per(
    df: DataFrame, keys: list[str], order: list[Column], n: int = 1,
    with_ties: bool = False, rank_as: str | None = None,
) -> DataFrame:
    """The first ``n`` rows of every key.

    Spark prunes each task's rows to ``n`` per key before they are shuffled
    (``WindowGroupLimit``), so a key that holds much of the table sends only
    ``n`` rows per task to the one task that finishes it.  From ``PRUNED_BELOW`` on it
    does not; then the rows of a key are first ranked in ``SALTS`` parts, and only the
    first ``n`` of each part meet.
    """
    name = rank_as or "_rank"
    ranked = F.rank() if with_ties else F.row_number()

    def cut(rows: DataFrame, within: list[str]) -> DataFrame:
        return rows.withColumn(name, ranked.over(Window.partitionBy(*within).orderBy(*order))).filter(F.col(name) <= n)

    if n >= PRUNED_BELOW:
        salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        df = cut(salted, [*keys, "_salt"]).drop("_salt", name)
    kept = cut(df, keys)
    return kept if rank_as else kept.drop(name)

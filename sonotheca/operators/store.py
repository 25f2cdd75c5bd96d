"""The keyed chunk store: append-only batches, a current view, and high-water marks.

Layout below one root folder, all Parquet:

- ``collections``: the model of each collection
- ``runs``: the number of every batch that was begun
- ``batches/batch_seq=<n>``: written chunks, partitioned by a bounded hash of the collection
- ``merged/version=<n>/bucket=<b>``: the batches of a range merged into one run of a bucket,
  with its pointer in ``merges``; ``replays`` says which batches were written again since
- ``marks/batch_seq=<n>``: the publication marks a batch moved
- ``selected/<n>``: the episodes a run took on
- ``transcripts/batch_seq=<n>``: every item a run handled, with its text or its error;
  ``failures/batch_seq=<n>``: those whose text could not be embedded

A batch is replaced as a whole when it is written again, also by an empty one; nothing
else is ever rewritten.  On a lakehouse table the same upsert is one ``MERGE INTO``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonotheca.fixed_values import EPISODE_FIELDS
from sonotheca.operators.locate import FILE, ROW, located
from sonotheca.operators.ranking import first_per
from sonotheca.schemas import (
    CHUNKS, COLLECTIONS, FAILURES, MERGED, REPLAYS, RUNS, STORED_MARKS, TRANSCRIPTS,
)
from sonotheca.session import written

_KEY = ["collection", "id"]

#: Partitions of a batch, however many collections there are.
BUCKETS = 64
#: A run is merged with the newer ones once they hold a share of its rows as large as one in so many.
TIER = 4
_BUCKETED = T.StructType(CHUNKS.fields + [T.StructField("bucket", T.IntegerType())])


def _read(spark: SparkSession, path: str, schema: T.StructType, places: bool = False) -> DataFrame:
    """A table of the store; one that was never written is empty.  ``places`` adds where each row is stored."""
    try:
        table = spark.read.schema(schema).parquet(path)
        return located(table) if places else table
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], schema)
        return empty.withColumns({FILE: F.lit(""), ROW: F.lit(0).cast("bigint")}) if places else empty


def _replace(df: DataFrame, path: str, *partitions: str) -> None:
    """Replace everything at ``path``, also by nothing."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partitions).parquet(path)


def _batch(path: str, batch_seq: int) -> str:
    return f"{path}/batch_seq={batch_seq}"


def _bucket(collection: Column) -> Column:
    return F.pmod(F.xxhash64(collection), F.lit(BUCKETS)).cast("int")


def _write_bucketed(chunks: DataFrame, path: str) -> None:
    """Chunks in partitions of ``bucket``, sorted by key.

    ``rebalance`` puts a bucket into one task, or into several if it is large, so the
    number of files follows the data and not the number of collections or tasks.
    """
    rows = chunks.withColumn("bucket", _bucket(F.col("collection"))).hint("rebalance", "bucket")
    _replace(rows.sortWithinPartitions("bucket", *_KEY), path, "bucket")


def open_collection(
    spark: SparkSession, root: str, collection: str, model: str | None = None, create: bool = True
) -> DataFrame:
    """The current chunks of a collection.

    A missing collection is registered under ``model`` when ``create`` is set and
    is an error otherwise.  An existing one must have been filled by ``model``.
    """
    known = _read(spark, f"{root}/collections", COLLECTIONS)
    found = known.filter(F.col("collection") == collection).first()
    if found is None and not create:
        raise LookupError(f"no collection named {collection!r}")
    if found is None or model is not None:
        wanted = spark.createDataFrame([(collection,)], "collection STRING")
        register_collections(spark, root, wanted, model)
    return current_chunks(spark, root, collection)


def register_collections(
    spark: SparkSession, root: str, collections: DataFrame, model: str | None
) -> None:
    """Enter the collections that are new under ``model``; the others must agree with it."""
    known = _read(spark, f"{root}/collections", COLLECTIONS)
    wanted = collections.select("collection").distinct()
    other = wanted.join(known, "collection").filter(~F.col("model").eqNullSafe(F.lit(model))).first()
    if other is not None:
        raise ValueError(f"collection {other['collection']!r} was filled by model {other['model']!r}")
    new = wanted.join(known, "collection", "left_anti").withColumn("model", F.lit(model).cast("string"))
    new.write.mode("append").parquet(f"{root}/collections")


def _of_collection(rows: DataFrame, collection: str | None) -> DataFrame:
    """The rows of one collection, from its bucket only; all rows without a name."""
    if collection is not None:
        name = F.lit(collection)
        rows = rows.filter((F.col("bucket") == _bucket(name)) & (F.col("collection") == name))
    return rows


def read_batches(spark: SparkSession, root: str, collection: str | None = None, places: bool = False) -> DataFrame:
    return _of_collection(_read(spark, f"{root}/batches", _BUCKETED, places), collection).drop("bucket")


def resolve_collisions(batch: DataFrame, newest: str = "published_ts", path: str = "file") -> DataFrame:
    """One row per ``collection, id``: the latest published wins, then the greater path."""
    order = [F.col(newest).desc_nulls_last(), F.col(path).desc()]
    return first_per(batch, _KEY, order)


def collision_losers(batch: DataFrame, winners: DataFrame, path: str = "file") -> DataFrame:
    """The rows that lost their id to another file.

    The join key includes the path, so many copies of one id spread over the tasks.
    """
    return batch.join(winners.select(*_KEY, path), [*_KEY, path], "left_anti")


def upsert(spark: SparkSession, root: str, batch: DataFrame, batch_seq: int) -> None:
    """Insert or replace chunks by id.  Nothing is deleted, and a replay changes nothing.

    ``batch`` must hold each ``collection, id`` once; see ``resolve_collisions``.
    """
    columns = [c for c in CHUNKS.fieldNames() if c != "batch_seq"]
    reach = _read(spark, f"{root}/merges", MERGED).agg(F.max("upto"), F.max("version")).first()
    if reach[0] is not None and reach[0] >= batch_seq:
        again = spark.createDataFrame([(batch_seq, reach[1])], REPLAYS)
        again.write.mode("append").parquet(f"{root}/replays")
    _write_bucketed(batch.select(*columns), _batch(f"{root}/batches", batch_seq))


def latest_by_id(rows: DataFrame) -> DataFrame:
    """The row of the latest batch for every id.

    Only keys and numbers are compared.  What they supersede is a narrow table, so
    documents and vectors are read in place unless very many were replaced.
    """
    keys = rows.select(*_KEY, "batch_seq")
    newest = keys.groupBy(*_KEY).agg(F.max("batch_seq").alias("_newest"), F.count("*").alias("_n"))
    old = keys.join(newest.filter("_n > 1"), _KEY).filter("batch_seq < _newest").select(*_KEY, "batch_seq")
    return rows.join(written(old, "superseded"), [*_KEY, "batch_seq"], "left_anti")


def _runs(spark: SparkSession, root: str) -> dict[int, list]:
    """The merged runs that are in use, by bucket, newest range first; a few rows a bucket.

    A run is not in use once a later one covers its range, or once a batch inside it was
    written again after it; what it had covered itself is then in use again.
    """
    replays = [(r["batch_seq"], r["version"]) for r in _read(spark, f"{root}/replays", REPLAYS).collect()]
    in_use: dict[int, list] = {}
    for run in sorted(_read(spark, f"{root}/merges", MERGED).collect(), key=lambda r: -r["version"]):
        later = in_use.setdefault(run["bucket"], [])
        outdated = any(run["after"] < seq <= run["upto"] and version >= run["version"] for seq, version in replays)
        if not outdated and not any(x["after"] <= run["after"] and run["upto"] <= x["upto"] for x in later):
            later.append(run)
    return {bucket: sorted(runs, key=lambda r: -r["upto"]) for bucket, runs in in_use.items() if runs}


def _not_merged(runs: dict[int, list]) -> Column:
    """Whether no run covers a batch of a bucket; both are partitions, so files are pruned by it."""
    if not runs:
        return F.lit(True)
    pairs = []
    for bucket, own in runs.items():
        pairs += [F.lit(bucket), F.array(*(F.struct(F.lit(r["after"]).alias("after"), F.lit(r["upto"]).alias("upto")) for r in own))]
    inside = lambda r: (F.col("batch_seq") > r["after"]) & (F.col("batch_seq") <= r["upto"])
    return ~F.coalesce(F.exists(F.element_at(F.create_map(*pairs), F.col("bucket")), inside), F.lit(False))


def _read_runs(spark: SparkSession, root: str, runs: list, places: bool = False) -> DataFrame:
    """The chunks of merged runs, with their bucket."""
    top = f"{root}/merged"
    paths = [f"{top}/version={r['version']}/bucket={r['bucket']}" for r in runs if r["rows"]]
    if not paths:
        return _read(spark, f"{top}/none", _BUCKETED, places)
    found = spark.read.schema(_BUCKETED).option("basePath", top).parquet(*paths)
    return (located(found) if places else found).select(*_BUCKETED.fieldNames(), *((FILE, ROW) if places else ()))


def current_chunks(spark: SparkSession, root: str, collection: str | None = None, places: bool = False) -> DataFrame:
    """The latest version of every chunk of a collection, or of all.

    The oldest run of a bucket holds each id once and is by far the largest.  It only loses the
    ids that were written since; just the newer runs and batches are compared among
    themselves.  ``places`` adds the file and row of every chunk, with which ``search`` reads the
    documents of its hits only.
    """
    runs = _runs(spark, root)
    if collection is not None:
        own = spark.range(1).select(_bucket(F.lit(collection))).first()[0]
        runs = {bucket: some for bucket, some in runs.items() if bucket == own}
    batches = _of_collection(_read(spark, f"{root}/batches", _BUCKETED, places), collection)
    newer = batches.filter(_not_merged(runs))
    later = [r for some in runs.values() for r in some[:-1]]
    if later:
        newer = newer.unionByName(_of_collection(_read_runs(spark, root, later, places), collection))
    newer = newer.drop("bucket")
    oldest = [some[-1] for some in runs.values()]
    if not oldest:
        return latest_by_id(newer)
    base = _of_collection(_read_runs(spark, root, oldest, places), collection).drop("bucket")
    kept = base.join(written(newer.select(*_KEY).distinct(), "since"), _KEY, "left_anti")
    return kept.unionByName(latest_by_id(newer))


def compact(spark: SparkSession, root: str) -> None:
    """Merge what was written since into runs, in the buckets that it touched; their pointers follow.

    In each such bucket the new batches are merged with the newest runs for as long as the next
    older run has no more than ``TIER`` times the rows gathered so far.  Runs therefore grow by
    that factor, a bucket has a few of them, and a chunk is rewritten as often as its bucket
    has sizes of runs, not at every merge.  Buckets without new batches stay as they are.
    """
    runs = _runs(spark, root)
    batches = _read(spark, f"{root}/batches", _BUCKETED).filter(_not_merged(runs))
    fresh = batches.groupBy("bucket").agg(F.count("*").alias("n"), F.min("batch_seq").alias("first"), F.max("batch_seq").alias("last")).collect()
    if not fresh:
        return
    version = (_read(spark, f"{root}/merges", MERGED).agg(F.max("version")).first()[0] or 0) + 1
    ranges, taken = {}, []
    for row in fresh:  # a row a bucket
        size, after, upto = row["n"], row["first"] - 1, row["last"]
        for run in runs.get(row["bucket"], []):
            # a batch that was written again may lie before runs that are in use
            if run["upto"] < row["first"] and run["rows"] > TIER * size:
                after = run["upto"]
                break
            size, after, upto = size + run["rows"], min(after, run["after"]), max(upto, run["upto"])
            taken.append(run)
        ranges[row["bucket"]] = after, upto
    gathered = batches.filter(F.col("bucket").isin(*ranges)).unionByName(_read_runs(spark, root, taken))
    path = f"{root}/merged/version={version}"
    _write_bucketed(latest_by_id(gathered.drop("bucket")), path)
    rows = {r["bucket"]: r["n"] for r in _read(spark, path, _BUCKETED).groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    pointers = [(bucket, after, upto, version, rows.get(bucket, 0)) for bucket, (after, upto) in ranges.items()]
    spark.createDataFrame(pointers, MERGED).coalesce(1).write.mode("append").parquet(f"{root}/merges")


def compact_when_due(spark: SparkSession, root: str, every: int | None) -> None:
    """Compact once ``every`` batches were begun since the last merge; never without a number."""
    if every:
        reached = _read(spark, f"{root}/merges", MERGED).agg(F.max("upto")).first()[0] or 0
        if next_batch_seq(spark, root) - 1 - reached >= every:
            compact(spark, root)


def read_marks(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The stored mark of every collection: the greatest one ever written.

    ``before`` ignores that batch and later ones, so that a batch replayed after a
    crash selects exactly what it selected the first time.
    """
    stored = _read(spark, f"{root}/marks", STORED_MARKS)
    if before is not None:
        stored = stored.filter(F.col("batch_seq") < before)
    return stored.groupBy("collection").agg(F.max("published_ts").alias("published_ts"))


def advance_mark(stored: DataFrame, marks: DataFrame) -> DataFrame:
    """Marks after a run: the greatest of the old mark and the dates stored in the run.

    ``stored`` holds ``collection, published_ts`` of what was stored; undated rows
    count for nothing, and a mark never goes back.
    """
    reached = stored.groupBy("collection").agg(F.max("published_ts").alias("_reached"))
    return (
        marks.join(reached, "collection", "full_outer")
        .withColumn("published_ts", F.greatest("published_ts", "_reached"))
        .filter(F.col("published_ts").isNotNull())
        .select("collection", "published_ts")
    )


def moved_marks(advanced: DataFrame, marks: DataFrame) -> DataFrame:
    """Those of ``advanced`` that differ from the marks before."""
    old = marks.select("collection", F.col("published_ts").alias("_old"))
    return advanced.join(old, "collection", "left").filter(
        ~F.col("published_ts").eqNullSafe(F.col("_old"))).drop("_old")


def write_marks(spark: SparkSession, root: str, marks: DataFrame, batch_seq: int) -> None:
    _replace(marks.select("collection", "published_ts"), _batch(f"{root}/marks", batch_seq))


def write_handled(handled: DataFrame, root: str, batch_seq: int) -> DataFrame:
    """Record what a run handled, before anything is derived from it; the rows as recorded."""
    columns = [c for c in TRANSCRIPTS.fieldNames() if c != "batch_seq"]
    path = _batch(f"{root}/transcripts", batch_seq)
    _replace(handled.select(*columns), path)
    stored = T.StructType([TRANSCRIPTS[c] for c in columns])
    return handled.sparkSession.read.schema(stored).parquet(path).withColumn(
        "batch_seq", F.lit(batch_seq).cast("bigint"))


def write_failures(failures: DataFrame, root: str, batch_seq: int) -> DataFrame:
    """``collection, stem, failure`` of the transcripts that a run could not embed."""
    path = _batch(f"{root}/failures", batch_seq)
    columns = [c for c in FAILURES.fieldNames() if c != "batch_seq"]
    _replace(failures.select(*columns), path)
    return failures.sparkSession.read.schema(T.StructType([FAILURES[c] for c in columns])).parquet(path)


def read_handled(spark: SparkSession, root: str, batch_seq: int | None = None) -> DataFrame:
    """What runs handled, or one run; ``error`` includes failures of the embedding."""
    handled = _read(spark, f"{root}/transcripts", TRANSCRIPTS)
    failures = _read(spark, f"{root}/failures", FAILURES)
    if batch_seq is not None:
        handled, failures = (df.filter(F.col("batch_seq") == batch_seq) for df in (handled, failures))
    joined = handled.join(failures, ["batch_seq", "collection", "stem"], "left")
    return joined.withColumn("error", F.coalesce("error", "failure")).select(*TRANSCRIPTS.fieldNames())


def write_selected(episodes: DataFrame, root: str, batch_seq: int) -> DataFrame:
    """The episodes of a run as a table of their own, so that plans know its real size."""
    path = f"{root}/selected/{batch_seq}"
    episodes.write.mode("overwrite").parquet(path)
    return episodes.sparkSession.read.schema(episodes.schema).parquet(path)


def next_batch_seq(spark: SparkSession, root: str) -> int:
    return (_read(spark, f"{root}/runs", RUNS).agg(F.max("batch_seq")).first()[0] or 0) + 1


def allot_batch(spark: SparkSession, root: str, source: str | None = None) -> int:
    """A new batch number; a ``source`` that has one already, after a crash, gets it again."""
    if source is not None:
        known = _read(spark, f"{root}/runs", RUNS).filter(F.col("source") == source).first()
        if known is not None:
            return known["batch_seq"]
    number = next_batch_seq(spark, root)
    spark.createDataFrame([(number, source)], RUNS).write.mode("append").parquet(f"{root}/runs")
    return number


def failed_items(spark: SparkSession, root: str) -> DataFrame:
    """Items whose latest handling failed: the work that is still open."""
    tried = read_handled(spark, root).select("collection", "stem", "error", "batch_seq")
    latest = first_per(tried, ["collection", "stem"], [F.col("batch_seq").desc()])
    return latest.filter(F.col("error").isNotNull())


def as_metadata(prefix: str = "") -> Column:
    """The episode record as the struct stored with each chunk."""
    return F.struct(*(F.col(f"{prefix}{n}").alias(n) for n in EPISODE_FIELDS))

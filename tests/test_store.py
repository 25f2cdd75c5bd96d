from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from sonotheca.operators import service_log
from sonotheca.operators import store as st
from sonotheca.schemas import ATTEMPTS, CALLS, CHUNKS, MARKS


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")


def chunks(spark, rows, collection="c"):
    full = [(collection, 0, i, doc, [1.0], "m", None) for i, doc in rows]
    return spark.createDataFrame(full, CHUNKS)


def content(df):
    return {r.id: r.document for r in df.collect()}


def test_open_collection(spark, root):
    with pytest.raises(LookupError):
        st.open_collection(spark, root, "c", create=False)
    empty = st.open_collection(spark, root, "c", "m")
    assert empty.count() == 0 and set(empty.columns) == set(CHUNKS.fieldNames())
    assert st.open_collection(spark, root, "c", create=False).count() == 0
    assert st.open_collection(spark, root, "c", "m").count() == 0
    with pytest.raises(ValueError):
        st.open_collection(spark, root, "c", "another model")
    assert spark.read.parquet(f"{root}/collections").count() == 1


@pytest.mark.parametrize("compacted", [False, True])
def test_upsert_replaces_by_id_and_keeps_the_rest(spark, root, compacted):
    st.open_collection(spark, root, "c", "m")
    first = chunks(spark, [("t_0", "old"), ("t_1", "old tail"), ("u_0", "u")])
    st.upsert(spark, root, first.union(chunks(spark, [("t_0", "elsewhere")], "d")), 1)
    if compacted:
        st.compact(spark, root)
        st.compact(spark, root)
    second = chunks(spark, [("t_0", "new"), ("v_0", "v")])
    want = {"t_0": "new", "t_1": "old tail", "u_0": "u", "v_0": "v"}
    for _ in range(2):  # the replay changes nothing
        st.upsert(spark, root, second, 2)
        assert content(st.current_chunks(spark, root, "c")) == want
    st.compact(spark, root)
    assert content(st.current_chunks(spark, root, "c")) == want
    assert content(st.current_chunks(spark, root, "d")) == {"t_0": "elsewhere"}
    st.upsert(spark, root, chunks(spark, [("t_1", "newer")]), 3)
    assert content(st.current_chunks(spark, root, "c")) == {**want, "t_1": "newer"}


def test_replayed_batch_that_shrank_is_replaced(spark, root):
    st.upsert(spark, root, chunks(spark, [("a", "1"), ("b", "1")]), 1)
    st.upsert(spark, root, chunks(spark, [("a", "2")]), 1)
    assert content(st.current_chunks(spark, root, "c")) == {"a": "2"}


def test_replayed_batch_without_rows_leaves_none(spark, root):
    st.upsert(spark, root, chunks(spark, [("a", "1")]).union(chunks(spark, [("b", "1")], "d")), 1)
    st.upsert(spark, root, chunks(spark, [("a", "2")]), 1)
    assert st.current_chunks(spark, root, "d").count() == 0
    st.upsert(spark, root, chunks(spark, []), 1)
    assert st.current_chunks(spark, root).count() == 0


def test_replay_of_a_compacted_batch_is_seen(spark, root):
    st.upsert(spark, root, chunks(spark, [("a", "1"), ("b", "1")]), 1)
    st.upsert(spark, root, chunks(spark, [("b", "2")]), 2)
    st.compact(spark, root)
    st.upsert(spark, root, chunks(spark, [("a", "again")]), 1)
    assert content(st.current_chunks(spark, root, "c")) == {"a": "again", "b": "2"}
    st.compact(spark, root)
    assert content(st.current_chunks(spark, root, "c")) == {"a": "again", "b": "2"}


def test_compacting_rewrites_the_touched_bucket_only(spark, root, tmp_path):
    names = [f"c{i}" for i in range(30)]
    first = chunks(spark, [("a", "1")], names[0])
    for name in names[1:]:
        first = first.union(chunks(spark, [("a", "1"), ("b", "1")], name))
    st.upsert(spark, root, first, 1)
    st.compact(spark, root)
    st.upsert(spark, root, chunks(spark, [("a", "2")], "c7"), 2)
    st.compact(spark, root)
    merged = tmp_path / "store" / "merged"
    bucket = spark.range(1).select(st._bucket(F.lit("c7"))).first()[0]
    assert [p.name for p in (merged / "version=2").glob("bucket=*")] == [f"bucket={bucket}"]
    assert content(st.current_chunks(spark, root, "c7")) == {"a": "2", "b": "1"}
    assert content(st.current_chunks(spark, root, "c8")) == {"a": "1", "b": "1"}
    assert st.current_chunks(spark, root).count() == 59
    st.compact(spark, root)  # nothing new
    assert not (merged / "version=3").exists()


def test_runs_grow_in_tiers(spark, root):
    st.upsert(spark, root, chunks(spark, [(f"x{i}", "1") for i in range(40)]), 1)
    st.compact(spark, root)
    want = {f"x{i}": "1" for i in range(40)}
    shapes = []
    for seq in range(2, 7):
        st.upsert(spark, root, chunks(spark, [("x0", str(seq)), (f"y{seq}", "y")]), seq)
        st.compact(spark, root)
        want |= {"x0": str(seq), f"y{seq}": "y"}
        (runs,) = st._runs(spark, root).values()
        shapes.append([r["rows"] for r in runs])
        assert content(st.current_chunks(spark, root, "c")) == want
    assert shapes[0] == [2, 40] and shapes[1] == [3, 40] and all(len(s) <= 2 for s in shapes)
    assert max(s[-1] for s in shapes) <= 45
    st.upsert(spark, root, chunks(spark, [(f"x{i}", "9") for i in range(20)]), 7)
    st.compact(spark, root)
    (runs,) = st._runs(spark, root).values()
    assert [r["rows"] for r in runs] == [45]
    assert content(st.current_chunks(spark, root, "c")) == want | {f"x{i}": "9" for i in range(20)}


def test_replay_inside_a_merged_range(spark, root):
    for seq in (1, 2, 3):
        st.upsert(spark, root, chunks(spark, [(f"a{i}", str(seq)) for i in range(seq, 4)]), seq)
        st.compact(spark, root)
    st.upsert(spark, root, chunks(spark, [("a2", "again"), ("new", "again")]), 2)
    want = {"a1": "1", "a2": "again", "a3": "3", "new": "again"}
    assert content(st.current_chunks(spark, root, "c")) == want
    st.upsert(spark, root, chunks(spark, [("b", "4")]), 4)
    st.compact(spark, root)
    assert content(st.current_chunks(spark, root, "c")) == want | {"b": "4"}


def test_files_do_not_grow_with_the_collections(spark, root, tmp_path):
    many = spark.range(1000).select(
        F.concat(F.lit("c"), "id").alias("collection"), F.concat(F.lit("x"), "id").alias("id"), F.lit("d").alias("document"),
        F.array(F.lit(1.0)).alias("embedding"), F.lit("m").alias("model"), F.lit(None).cast(CHUNKS["metadata"].dataType).alias("metadata"))
    st.upsert(spark, root, many.repartition(8), 1)
    files = list((tmp_path / "store" / "batches").rglob("*.parquet"))
    assert len(files) <= st.BUCKETS
    assert content(st.current_chunks(spark, root, "c77")) == {"x77": "d"}


def test_current_view_ranks_no_wide_rows(spark, root, plan_of):
    for seq in (1, 2):
        st.upsert(spark, root, chunks(spark, [("a", str(seq)), ("b", "x")]), seq)
    plan = plan_of(st.current_chunks(spark, root, "c"))
    assert "Window" not in plan and "bucket" in plan


def test_batch_numbers_are_allotted_once(spark, root):
    assert [st.allot_batch(spark, root), st.allot_batch(spark, root, "s#0"), st.allot_batch(spark, root, "s#1")] == [1, 2, 3]
    assert [st.allot_batch(spark, root, "s#0"), st.allot_batch(spark, root)] == [2, 4]


def test_collisions(spark):
    day = datetime(2024, 1, 1)
    rows = [("c", "x_0", "a.txt", day), ("c", "x_0", "b.txt", day), ("c", "x_0", "z.txt", None),
            ("c", "x_1", "a.txt", day), ("d", "x_0", "a.txt", None)]
    df = spark.createDataFrame(rows, "collection STRING, id STRING, file STRING, published_ts TIMESTAMP")
    winners = st.resolve_collisions(df)
    assert {(r.collection, r.id, r.file) for r in winners.collect()} == {
        ("c", "x_0", "b.txt"), ("c", "x_1", "a.txt"), ("d", "x_0", "a.txt"),
    }
    assert {r.file for r in st.collision_losers(df, winners).collect()} == {"a.txt", "z.txt"}


def test_hot_id_is_pruned_before_the_shuffle(spark, plan_of):
    df = spark.range(100).select(
        F.lit("c").alias("collection"), F.expr("if(id < 90, 'hot', 'x')").alias("id"),
        F.col("id").alias("file"), F.col("id").alias("published_ts"),
    )
    assert plan_of(st.resolve_collisions(df)).count("WindowGroupLimit") == 2


def test_marks_only_move_forward(spark, root):
    d = [datetime(2024, 1, n) for n in range(1, 6)]
    marks = spark.createDataFrame([("a", d[2]), ("b", d[2]), ("e", d[0])], MARKS)
    stored = spark.createDataFrame([("a", d[1]), ("b", d[4]), ("b", None), ("new", d[0]), ("none", None)], MARKS)
    moved = st.advance_mark(stored, marks)
    got = {r.collection: r.published_ts for r in moved.collect()}
    assert got == {"a": d[2], "b": d[4], "e": d[0], "new": d[0]}
    st.write_marks(spark, root, moved, 1)
    st.write_marks(spark, root, marks, 2)  # older values do not win
    assert {r.collection: r.published_ts for r in st.read_marks(spark, root).collect()} == got
    assert st.read_marks(spark, root, before=1).count() == 0


def test_retry_plan(spark):
    rows = [
        ("e1", "embedding", 0, "Model is LOADING"), ("e2", "embedding", 2, "503"), ("e3", "embedding", 0, "429"),
        ("e4", "embedding", 2, "Rate limit"), ("e5", "embedding", 1, "generate failed"),
        ("e6", "embedding", 1, "boom"), ("e7", "embedding", 2, "boom"), ("e8", "embedding", 0, "boom"),
        ("t1", "transcription", 1, "429"), ("t2", "transcription", 2, "rate"), ("t3", "transcription", 0, "boom"),
        ("t4", "transcription", 1, "503 loading"), ("t5", "transcription", 2, "boom"),
        ("t5", "transcription", 0, "429"), ("t5", "transcription", 1, "429"),
    ]
    got = {r.item: (r.error_class, r.wait_s, r.action) for r in
           service_log.retry_plan(spark.createDataFrame(rows, ATTEMPTS)).collect()}
    assert got == {
        "e1": ("loading", 20, "retry"), "e2": ("loading", 20, "give_up"), "e3": ("rate", 1, "retry"),
        "e4": ("rate", 4, "give_up"), "e5": ("rate", 2, "retry"), "e6": ("other", 2, "retry"),
        "e7": ("other", 0, "give_up"), "e8": ("other", 1, "retry"), "t1": ("rate", 120, "retry"),
        "t2": ("rate", 180, "give_up"), "t3": ("other", 5, "retry"), "t4": ("other", 10, "retry"),
        "t5": ("other", 0, "give_up"),
    }


def test_quota_usage_by_brute_force(spark):
    import random

    rng = random.Random(1)
    base = 1704067200
    calls = [("a", base + rng.randrange(3 * 86400), float(rng.randrange(90))) for _ in range(500)]
    calls += [("a", base + 86400 + rng.randrange(50), 1.0) for _ in range(30)]  # a burst at midnight
    calls += [("b", base + 10, 7000.0), ("b", base + 3609, 300.0), ("b", base + 3610, 0.5)]
    df = spark.createDataFrame(
        [(a, datetime.fromtimestamp(s, timezone.utc), x) for a, s, x in calls], CALLS
    )
    rows = service_log.quota_usage(df).collect()
    assert len(rows) == len({(a, s) for a, s, _ in calls})
    for r in rows:
        def within(width, value):
            return sum(value(x) for a, s, x in calls if a == r.account and r.second - width < s <= r.second)

        used = (within(60, lambda x: 1), within(86400, lambda x: 1), within(3600, float), within(86400, float))
        assert (r.requests_minute, r.requests_day, r.audio_s_hour, r.audio_s_day) == used
        assert r.over_quota == (used[0] > 20 or used[1] > 2000 or used[2] > 7200 or used[3] > 28800)
    assert {r.second - base for r in rows if r.account == "b" and r.over_quota} == {3609}

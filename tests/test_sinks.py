"""Sinks, watermarks and the streaming load on a temporary folder."""

from pyspark.sql import functions as F

from tidemark.sources import sinks
from tidemark.sources.tables import load_seed, with_history
from tidemark.sources.watermarks import EPOCH, Watermarks
from tidemark.streaming.incremental import load_new_files


def frame(spark, rows):
    return spark.createDataFrame(rows, "day string, k int, v string, ins string")


def as_set(df):
    return {tuple(r) for r in df.select("day", "k", "v", "ins").collect()}


def test_upsert_table_plain_and_partitioned(spark, tmp_path):
    first = frame(spark, [("d1", 1, "a", "t1"), ("d1", 2, "b", "t1"), ("d2", 3, "c", "t1")])
    load = frame(spark, [("d1", 2, "B", "t2"), ("d1", 4, "d", "t2")])
    want = {("d1", 1, "a", "t1"), ("d1", 2, "B", "t1"), ("d1", 4, "d", "t2"), ("d2", 3, "c", "t1")}
    for part in ((), ("day",)):
        path = str(tmp_path / f"t{len(part)}")
        for _ in range(1):
            sinks.upsert_table(spark, path, first, ["day", "k"], ["v"], partition_by=part)
        sinks.upsert_table(spark, path, load, ["day", "k"], ["v"], partition_by=part)
        assert as_set(spark.read.parquet(path)) == want
        # The same load again changes nothing.
        sinks.upsert_table(spark, path, load, ["day", "k"], ["v"], partition_by=part)
        assert as_set(spark.read.parquet(path)) == want


def test_partitioned_upsert_leaves_other_days_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(frame(spark, [("d1", 1, "a", "x"), ("d2", 1, "b", "x")]), path, ["day"])
    before = sorted(p.name for p in (tmp_path / "t" / "day=d2").iterdir())
    sinks.upsert_table(spark, path, frame(spark, [("d1", 1, "z", "y")]), ["day", "k"], ["v"], partition_by=["day"])
    assert sorted(p.name for p in (tmp_path / "t" / "day=d2").iterdir()) == before
    assert ("d1", 1, "z", "x") in as_set(spark.read.parquet(path))


def test_hash_guard(spark):
    t = spark.createDataFrame([(1, "h1", "old"), (2, "h2", "old")], "k int, h string, upd string")
    s = spark.createDataFrame([(1, "h1", "new"), (2, "H2", "new"), (3, "h3", "new")], "k int, h string, upd string")
    out = {tuple(r) for r in sinks.upsert(t, s, ["k"], ["h", "upd"], hash_col="h").collect()}
    assert out == {(1, "h1", "old"), (2, "H2", "new"), (3, "h3", "new")}


def test_watermarks(spark, tmp_path):
    w = Watermarks(spark, str(tmp_path / "wm"))
    one = w.begin("job", "2024-01-01 00:00:00")
    assert (one.lwm, one.hwm, one.batch_id) == (EPOCH, "2024-01-01 00:00:00", 1)
    # Not committed: the next attempt starts at the same low mark.
    two = w.begin("job", "2024-01-02 00:00:00")
    assert (two.lwm, two.batch_id) == (EPOCH, 2)
    w.commit(two, "2024-01-02 00:10:00")
    three = w.begin("job", "2024-01-03 00:00:00")
    assert three.lwm == "2024-01-02 00:00:00"
    assert w.begin("other", "2024-01-03 00:00:00").lwm == EPOCH


def test_load_seed(spark, tmp_path):
    p = tmp_path / "seed.csv"
    p.write_text('code,label,loaded\nA,"x, y",2022-11-01 10:15:00\nB,z,11/2/2022 9:05\n')
    df = load_seed(spark, str(p), "code string, label string, loaded string", ["loaded"])
    got = {r.code: (r.label, r.loaded.strftime("%Y-%m-%d %H:%M")) for r in df.collect()}
    assert got == {"A": ("x, y", "2022-11-01 10:15"), "B": ("z", "2022-11-02 09:05")}


def test_history_union_with_null_keys(spark):
    a = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string")
    assert sorted(r.v for r in with_history(a, [b], ["k"]).collect()) == ["a", "b", "n"]


def test_streaming_load_is_idempotent(spark, tmp_path):
    src, tgt, ck = (str(tmp_path / n) for n in ("src", "tgt", "ck"))
    schema = "k int, v string, loaded int"
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], schema).write.parquet(src)
    run = lambda: load_new_files(
        spark, src, schema, tgt, ["k"], [F.col("loaded").desc()], ck
    ).awaitTermination()
    run()
    assert {(r.k, r.v) for r in spark.read.parquet(tgt).collect()} == {(1, "b"), (2, "c")}
    spark.createDataFrame([(2, "d", 5), (3, "e", 5)], schema).write.mode("append").parquet(src)
    run()
    assert {(r.k, r.v) for r in spark.read.parquet(tgt).collect()} == {(1, "b"), (2, "d"), (3, "e")}


def test_interrupted_swap_is_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(frame(spark, [("d", 1, "new", "t")]), path + sinks.STAGED)  # old one already deleted
    sinks.upsert_table(spark, path, frame(spark, [("d", 2, "more", "t")]), ["day", "k"])
    assert {r[1] for r in as_set(spark.read.parquet(path))} == {1, 2}


def test_view_and_full_refresh(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in ("a", "b"):
        sinks.write_table(frame(spark, [("d", 1, v, "t")]), path)
    sinks.as_view(spark.read.parquet(path), "refreshed")
    assert [r.v for r in spark.sql("SELECT v FROM refreshed").collect()] == ["b"]


def test_retention_and_archive(spark, tmp_path):
    """Archiving a day twice keeps one copy of it; purging drops old rows only."""
    from tidemark.operators.snapshots import archive

    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    path = str(tmp_path / "arch")
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        sinks.overwrite_partitions(archive(df, {"K": F.col("k")}, day), path, ["snapshot_date"])
    assert spark.read.parquet(path).groupBy("snapshot_date").count().where("count = 2").count() == 2
    kept = sinks.purge(spark.read.parquet(path), "snapshot_date", F.lit("2024-01-03").cast("date"), 1)
    assert {str(r.snapshot_date) for r in kept.collect()} == {"2024-01-02"}

"""Type-2 history on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import row_hash
from tidemark.operators import history

SCHEMA = "k string, v string, upd string"


def load(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).select("k", "v", F.col("upd").cast("date").alias("upd"))
    return df.withColumn("h", row_hash(df, ["k", "upd"]))


def shown(df):
    return sorted(
        (r.k, r.v, str(r.valid_from), str(r.valid_to) if r.valid_to else None)
        for r in df.select("k", "v", "valid_from", "valid_to").collect()
    )


@pytest.fixture()
def first(spark):
    rows = [("A", "a1", "2024-01-01"), ("B", "b1", "2024-01-01"), ("C", "c1", "2024-01-01"), ("E", "e0", "2024-01-01")]
    return history.init(load(spark, rows), ["k"], F.col("upd"))


def run(spark, hist, rows, now="2024-01-06 04:00:00"):
    return history.apply(hist, load(spark, rows), ["k"], F.col("upd"), row_hash="h", hard_deletes_at=now)


def test_changes_inserts_and_deletes(spark, first):
    one = [("A", "a2", "2024-01-05"), ("B", "b1", "2024-01-01"), ("D", "d1", "2024-01-05"), ("E", "e1", "2024-01-05")]
    hist = run(spark, first, one)
    assert shown(hist) == [
        ("A", "a1", "2024-01-01", "2024-01-04 00:00:00"),
        ("A", "a2", "2024-01-05", None),
        ("B", "b1", "2024-01-01", None),
        ("C", "c1", "2024-01-01", "2024-01-06 04:00:00"),
        ("D", "d1", "2024-01-05", None),
        ("E", "e0", "2024-01-01", "2024-01-04 00:00:00"),
        ("E", "e1", "2024-01-05", None),
    ]
    # A second change on the same day overwrites the open version.
    again = run(spark, hist, [*one[:3], ("E", "e2", "2024-01-05")])
    assert ("E", "e2", "2024-01-05", None) in shown(again)
    assert len([r for r in shown(again) if r[0] == "E"]) == 2
    # The same load once more changes nothing.
    assert shown(run(spark, again, [*one[:3], ("E", "e2", "2024-01-05")])) == shown(again)


def test_key_closed_by_delete_stays_closed_on_same_date(spark, first):
    gone = run(spark, first, [("A", "a1", "2024-01-01"), ("B", "b1", "2024-01-01"), ("E", "e0", "2024-01-01")])
    back = run(spark, gone, [("A", "a1", "2024-01-01"), ("B", "b1", "2024-01-01"), ("C", "c1", "2024-01-01"), ("E", "e0", "2024-01-01")])
    assert [r for r in shown(back) if r[0] == "C"] == [("C", "c1", "2024-01-01", "2024-01-06 04:00:00")]
    later = run(spark, gone, [("C", "c9", "2024-02-01")])
    assert ("C", "c9", "2024-02-01", None) in shown(later)


def test_null_hash_never_overwrites(spark, first):
    src = load(spark, [("A", "changed", "2024-01-01")]).withColumn("h", F.lit(None).cast("string"))
    out = history.apply(first, src, ["k"], F.col("upd"), row_hash="h")
    assert ("A", "a1", "2024-01-01", None) in shown(out)


def test_versions_do_not_overlap(spark):
    hist = history.init(load(spark, [("A", "0", "2024-01-01")]), ["k"], F.col("upd"))
    for d in range(2, 9):
        hist = run(spark, hist, [("A", str(d), f"2024-01-0{d}")])
    rows = shown(hist)
    assert len(rows) == 8
    for (_, _, _, end), (_, _, start, _) in zip(rows, rows[1:], strict=False):
        assert dt.date.fromisoformat(end[:10]) + dt.timedelta(days=1) == dt.date.fromisoformat(start)


def test_source_gains_a_column(spark, first):
    src = load(spark, [("A", "a2", "2024-01-05")]).withColumn("extra", F.lit("x"))
    out = history.apply(first, src, ["k"], F.col("upd"), row_hash="h")
    got = {(r.k, r.v): r.extra for r in out.collect()}
    assert got[("A", "a2")] == "x" and got[("B", "b1")] is None


def test_merge_timelines_example(spark):
    mk = lambda rows, c: spark.createDataFrame(rows, f"k int, s string, e string, {c} int").select(
        "k", F.col("s").cast("date").alias("s"), F.col("e").cast("date").alias("e"), c
    )
    a = mk([(1, "2024-01-01", "2024-02-29", 10), (1, "2024-03-01", "2024-03-15", 11)], "pa")
    b = mk([(1, "2024-02-01", "9999-12-31", 20)], "pb")
    out = history.merge_timelines(a, b, "k", "s", "e", ["pa"], ["pb"]).orderBy("s").collect()
    assert [(str(r.s), str(r.e), r.pa, r.pb) for r in out] == [
        ("2024-01-01", "2024-01-31", 10, None),
        ("2024-02-01", "2024-02-29", 10, 20),
        ("2024-03-01", "9999-12-31", 11, 20),
    ]

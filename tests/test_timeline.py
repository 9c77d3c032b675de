"""Ranged ordered computations equal the plain windows, also with one dominating key."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import counter, joins, timeline
from tidemark.operators.timeline import Step


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to one key; values have nulls and repeats."""
    rnd = random.Random(5)
    rows = []
    for i in range(1800):
        key = 0 if i % 3 == 0 else rnd.randrange(1, 40)
        rows.append((key, i, rnd.choice(["a", "b", "c", None]), rnd.choice([None, *range(9)])))
    return spark.createDataFrame(rows, "k int, id int, v string, n int").cache()


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select("id", *cols).collect())


@pytest.mark.parametrize("kind", ["lag", "lead", "lag_known", "lead_known", "sum", "max", "min", "last"])
def test_scan_steps(skewed, kind):
    step = {"out": Step(kind, "n")}
    plain = timeline.scan(skewed, ["k"], ["id"], step)
    assert rows(timeline.scan(skewed, ["k"], ["id"], step, ranged=True, ranges=12), "out") == rows(plain, "out")


def test_change_event_and_islands(skewed):
    for fn in (timeline.change_event, timeline.islands):
        plain = fn(skewed, ["k"], ["id"], "v", "out")
        assert rows(fn(skewed, ["k"], ["id"], "v", "out", ranged=True, ranges=12), "out") == rows(plain, "out")


def test_change_event_example(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate("XXYYX")], "k int, id int, v string")
    out = rows(timeline.change_event(df, ["k"], ["id"], "v", "c"), "c")
    assert [c for _, c in out] == [0, 0, 1, 1, 2]
    isl = rows(timeline.islands(df, ["k"], ["id"], "v", "c"), "c")
    assert [c for _, c in isl] == [0, 0, 2, 2, 2]


def test_valid_to(spark):
    df = spark.sql("SELECT 1 k, explode(array(date'2024-01-01', date'2024-02-01', date'2024-03-01')) s")
    out = timeline.valid_to(df, ["k"], "s", "e", ranged=True, ranges=3).orderBy("s").collect()
    assert [str(r.e) for r in out] == ["2024-01-31", "2024-02-29", "9999-12-31"]


def fold(rows_):
    state, out = {}, {}
    for k, i, op in sorted(rows_):
        x = state.get(k, 0)
        x = 0 if op == "reset" else x + 1 if op == "up" else max(x - 1, 0)
        state[k] = out[i] = x
    return out


@pytest.mark.parametrize("seed", range(3))
def test_floored_counter(spark, seed):
    rnd = random.Random(seed)
    data = [
        (0 if i % 3 == 0 else rnd.randrange(1, 9), i, rnd.choices(["up", "down", "reset"], [5, 5, 1])[0])
        for i in range(900)
    ]
    df = spark.createDataFrame(data, "k int, id int, op string")
    step = F.when(F.col("op") == "up", 1).otherwise(-1)
    for ranges in (1, 25):
        out = counter.floored_counter(df, ["k"], ["id"], step, F.col("op") == "reset", "c", ranged=True, ranges=ranges)
        assert {r.id: r.c for r in out.collect()} == fold(data)


def test_open_count_equals_pairing(skewed):
    """The closed form equals pairing the nth opening with the nth closing."""
    is_open, is_close = F.coalesce(F.col("v") == "a", F.lit(False)), F.coalesce(F.col("v") == "b", F.lit(False))
    pairs = joins.pair_nth(skewed, ["k"], "id", is_open, is_close, ranged=True)
    want = rows(joins.inside_intervals(skewed, pairs, ["k"], "id", "n_open", ranged=True), "n_open")
    marked, steps, count = joins.open_count(skewed, ["k"], "id", is_open, is_close)
    got = rows(timeline.scan(marked, ["k"], ["id"], steps, ranged=True, ranges=12).withColumn("n_open", count), "n_open")
    assert got == want


def test_pair_nth_example(spark):
    data = [(1, i, t) for i, t in [(1, "o"), (2, "x"), (3, "c"), (4, "x"), (5, "o"), (6, "x")]]
    df = spark.createDataFrame(data, "k int, id int, t string")
    pairs = joins.pair_nth(df, ["k"], "id", F.col("t") == "o", F.col("t") == "c")
    assert sorted((r.open_id, r.close_id) for r in pairs.collect()) == [(1, 3), (5, None)]
    inside = joins.inside_intervals(df, pairs, ["k"], "id", "n")
    assert sorted(r.id for r in inside.where("n > 0").collect()) == [2, 6]


def test_copy_ordinal_with_a_hot_group_of_copies(spark):
    """A third of the rows are one row repeated; blocks are smaller than the group."""
    data = [(1, 5, "x")] * 700 + [(1, i % 9, "y") for i in range(700)] + [(2, i, "z") for i in range(700)]
    df = spark.createDataFrame(data, "k int, t int, v string")
    out = timeline.copy_ordinal(df, ["k"], ["t", "v"], "n", ranged=True, block=64, ranges=9)
    got = [tuple(r) for r in out.orderBy("k", "n").collect()]
    assert [r[:3] for r in got] == sorted(data)
    assert [r[3] for r in got] == [*range(1, 1401), *range(1, 701)]


def test_null_keys_and_cold_keys_match_plain_windows(skewed):
    df = skewed.withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    steps = {"p": Step("lag", "n"), "s": Step("sum", "n")}
    plain = rows(timeline.scan(df, ["k"], ["id"], steps), "p", "s")
    for ranges in (1, 4, 40):
        assert rows(timeline.scan(df, ["k"], ["id"], steps, ranged=True, ranges=ranges), "p", "s") == plain


def null_third(spark):
    """A third of the rows have no key."""
    return spark.sql("SELECT if(id % 3 = 0, null, id % 97) k, id, id % 7 n FROM range(6000)")


def test_a_null_key_with_a_third_of_the_rows_is_cut(spark):
    df = null_third(spark)
    cut, hot = timeline.cut_keys(df, ["k"], ["id"], 30)
    parts = {r[0]: r[1] for r in cut.where("k is null").groupBy(timeline.CHUNK).count().collect()}
    assert len(parts) >= 9 and max(parts.values()) < 600 and sum(parts.values()) == 2000
    assert cut.where("k is not null").select(timeline.CHUNK).distinct().collect()[0][0] is None
    assert {r.k for r in hot.select("k").distinct().collect()} == {None}
    steps = {"p": Step("lag", "n"), "q": Step("lead_known", "n"), "s": Step("sum", "n")}
    plain = rows(timeline.scan(df, ["k"], ["id"], steps), "p", "q", "s")
    assert rows(timeline.scan(df, ["k"], ["id"], steps, ranged=True, ranges=30), "p", "q", "s") == plain
    for fn in (timeline.change_event, timeline.islands):
        assert rows(fn(df, ["k"], ["id"], "n", "o", ranged=True, ranges=30), "o") == rows(fn(df, ["k"], ["id"], "n", "o"), "o")


def shuffles(df):
    plan = df._jdf.queryExecution().sparkPlan().toString()
    rows = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan") + plan.count("Range ("), rows.count("Exchange hashpartitioning")


def test_rows_are_shuffled_once_and_small_keys_cost_a_plain_window(spark):
    df = null_third(spark)
    step = {"s": Step("sum", "n"), "p": Step("lag", "n")}
    whole = timeline.scan(df.where("k is not null"), ["k"], ["id"], step, ranged=True, ranges=4)
    assert shuffles(whole) == (1, 1)
    cut = timeline.scan(df, ["k"], ["id"], step, ranged=True, ranges=30)
    read, shuffled = shuffles(cut)
    assert read == 2  # all rows, and those of the cut key for the carries
    assert shuffled <= 3  # the rows; the carries by (key, range) and by key
    assert "SortMergeJoin" not in cut._jdf.queryExecution().executedPlan().toString()


def test_many_bounds_are_searched_in_strides(spark):
    df = spark.range(0, 9000).selectExpr("id", "1 AS k", "id % 5 AS n")
    cut, _ = timeline.cut_keys(df, ["k"], ["id"], 300)
    found = [r[0] for r in cut.orderBy("id").select(timeline.CHUNK).collect()]
    assert found == sorted(found) and found[0] == 0 and found[-1] > 2 * timeline.STRIDE


@pytest.mark.parametrize("hot", [False, True])
def test_more_rows_are_dealt_to_more_tasks(spark, monkeypatch, hot):
    """A window's tasks follow the rows, not only the configured partitions; whole and cut keys give the same result."""
    monkeypatch.setattr(timeline, "ROWS_A_TASK", 500)
    df = spark.range(0, 20_000, 1, 4).selectExpr(f"if({str(hot).lower()} AND id % 3 = 0, -1, id % 700) k", "id v")
    size = timeline.key_bounds(df, ["k"], ["v"], 40)[1]
    assert 0.8 * 20_000 < size < 1.2 * 20_000
    rows, cut = timeline.deal(df, ["k"], ["v"])
    assert (cut is not None) == hot and rows.rdd.getNumPartitions() > 30
    per_task = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 4_000
    got = timeline.running(df, ["k"], ["v"], {"s": ("sum", "v")}, ranged=True)
    assert got.exceptAll(timeline.running(df, ["k"], ["v"], {"s": ("sum", "v")})).isEmpty() and got.count() == 20_000


def test_merged_time_lines_are_dealt_before_dates_are_grouped(spark, monkeypatch):
    from tidemark.operators import history

    side = lambda step, c: spark.range(0, 6_000, step, 4).selectExpr(
        "if(id % 2 = 0, 0, id % 50) k", "date_add(date'2000-01-01', cast(id AS int)) s", "date'9999-12-31' e", f"id {c}"
    )
    merged = lambda ranged: history.merge_timelines(side(1, "a"), side(3, "b"), "k", "s", "e", ["a"], ["b"], ranged=ranged)
    plain = merged(False)
    monkeypatch.setattr(timeline, "ROWS_A_TASK", 200)
    got = merged(True)
    assert got.rdd.getNumPartitions() > 20
    assert got.count() == plain.count() and got.exceptAll(plain).isEmpty()

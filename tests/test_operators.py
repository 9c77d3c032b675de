"""Joins, dedup, graph walk and quality checks on small hand-made inputs."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import graph, joins, money, quality, reshape, snapshots
from tidemark.operators.dedup import latest, latest_batch
from tidemark.operators.joins import Rule
from tidemark.plans import funnel, parts, projects


def test_cascade(spark):
    f = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (9, 9)], "a int, b int")
    ref = spark.createDataFrame([(1, 1, 10), (1, None, 20), (2, None, 30)], "x int, y int, v int")
    rules = [Rule({"a": "x", "b": "y"}), Rule({"a": "x"}, where=F.col("y").isNull())]
    out = joins.cascade_lookup(f, ref, rules, "v", "found", default=F.lit(0), rule_out="rule")
    got = {(r.a, r.b): (r.found, r.rule) for r in out.collect()}
    assert got == {(1, 1): (10, 1), (1, 2): (20, 2), (2, 1): (30, 2), (9, 9): (0, None)}


def test_cascade_never_multiplies_unless_asked(spark):
    f = spark.createDataFrame([(1,)], "a int")
    ref = spark.createDataFrame([(1, 5), (1, 3)], "x int, v int")
    args = (f, ref, [Rule({"a": "x"})], "v", "found")
    assert [r.found for r in joins.cascade_lookup(*args).collect()] == [3]
    assert sorted(r.found for r in joins.cascade_lookup(*args, strict=False).collect()) == [3, 5]


@pytest.mark.parametrize("unit", ["month", "quarter", "year"])
def test_effective_lookup_matches_brute_force(spark, unit):
    """Overlapping, touching and open-ended intervals, one hot key."""
    facts = spark.sql(
        "SELECT id, if(id % 3 = 0, 0, id % 7) k, date_add(date'2020-01-01', cast((id * 37) % 1500 AS int)) d FROM range(600)"
    )
    ref = spark.sql(
        """SELECT if(id % 3 = 0, 0, id % 7) k, date_add(date'2019-06-01', cast((id * 91) % 1600 AS int)) s,
           if(id % 10 = 0, date'9999-12-31', date_add(date'2019-06-01', cast((id * 91) % 1600 + (id * 13) % 400 AS int))) e,
           cast(id AS string) v FROM range(90)"""
    )
    got = joins.lookup_effective(facts, ref, {"k": "k"}, "d", "s", "e", "v", "found", unit=unit)
    facts.createOrReplaceTempView("f")
    ref.createOrReplaceTempView("r")
    want = spark.sql("SELECT f.id, min(v) found FROM f LEFT JOIN r ON f.k = r.k AND d BETWEEN s AND e GROUP BY f.id")
    assert sorted((r.id, r.found) for r in got.select("id", "found").collect()) == sorted(
        (r.id, r.found) for r in want.collect()
    )
    assert {r.found is None for r in want.collect()} == {True, False}


def test_asof_join_matches_brute_force(spark):
    left = spark.sql("SELECT id, if(id % 3 = 0, 0, id % 5) k, (id * 31) % 500 t FROM range(300)")
    right = spark.sql("SELECT id rid, if(id % 3 = 0, 0, id % 5) k, id * 7 t2 FROM range(80)")
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("rr")
    for eq, op in ((True, "<="), (False, "<")):
        out = joins.asof_join(
            left, right, ["k"], "t", "t2", ["rid"], allow_equal=eq, ranged=True
        )
        want = spark.sql(f"SELECT l.id, max_by(rid, t2) rid FROM l LEFT JOIN rr ON l.k = rr.k AND t2 {op} t GROUP BY l.id")
        assert sorted((r.id, r.rid or -1) for r in out.collect()) == sorted((r.id, r.rid or -1) for r in want.collect())


def test_latest_batch_keeps_ties_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 1, "b"), (1, 1, "c"), (1, 2, "d")], "k int, t int, v string")
    assert sorted(r.v for r in latest_batch(df, ["k"], "t").collect()) == ["a", "b", "d"]


def test_latest_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = latest(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_precedence_union_ignores_null_keys(spark):
    a = spark.createDataFrame([(None, "a"), (1, "a")], "k int, s string")
    b = spark.createDataFrame([(1, "b"), (2, "b")], "k int, s string")
    assert sorted((r.k or 0, r.s) for r in joins.precedence_union([a, b], ["k"]).collect()) == [(0, "a"), (1, "a"), (2, "b")]


def test_exists_or_absent(spark):
    f = spark.sql("SELECT explode(array('absent', 'ok', 'late', 'flag')) k, date'2024-05-01' d")
    m = spark.createDataFrame(
        [("ok", "2024-01-01", "2024-12-31", True), ("late", "2023-01-01", "2023-12-31", True), ("flag", "2024-01-01", "2024-12-31", False)],
        "k string, s string, e string, yes boolean",
    ).select("k", F.col("s").cast("date").alias("s"), F.col("e").cast("date").alias("e"), "yes")
    out = joins.exists_or_absent(f, m, "k", "d", "s", "e", F.col("yes"))
    assert sorted(r.k for r in out.collect()) == ["absent", "ok"]


def test_join_any_with_nulls(spark):
    l = spark.createDataFrame([(1, None), (2, 2), (None, 3)], "a int, b int")
    r = spark.createDataFrame([(1,), (2,), (3,)], "c int")
    out = joins.join_any(l, r, [F.col("a") == F.col("c"), F.col("b") == F.col("c")])
    assert sorted(x.c for x in out.collect()) == [1, 2, 3]


def walk(spark, edges, seeds, **kw):
    e = spark.createDataFrame(edges, "part string, from_site string, from_stage string, to_site string, to_stage string, kind string")
    s = spark.createDataFrame(seeds, "part string, site string, stage string")
    return {(r.site, r.stage, r.last_stage): r.step for r in graph.walk_paths(e, s, **kw).collect()}


def test_walk_chain_cycle_and_dead_end(spark):
    chain = [("p", "a", "1", "b", "2", "BOM"), ("p", "b", "2", "c", "3", "BOD")]
    assert walk(spark, chain, [("p", "a", "1")]) == {("a", "1", "1"): 1, ("b", "2", "2"): 2, ("c", "3", "2"): 3}
    cycle = [*chain, ("p", "c", "3", "a", "1", "BOM")]
    got = walk(spark, cycle, [("p", "a", "1")])
    assert got[("a", "1", "1")] == 1 and len(got) == 3
    assert walk(spark, chain, [("q", "a", "1")]) == {("a", "1", "1"): 1}


def test_routing_edges(spark):
    rows = [
        ("P1", "P1", "SG1", "ADC_X_1", "r", "b"),
        ("P1", "C1", "S1_WAF", "SDB", None, "b"),
        ("P1", None, "S1_WAF", "S2_ASM", "r", "b"),
        ("P1", "P1", "S1_WAF", "S2_ASM", "r", None),
    ]
    df = spark.createDataFrame(rows, "prod_item string, consum_item string, prod_fclty string, consum_fclty string, res_grp string, bom_name string")
    got = sorted((r.kind, r.to_site, r.to_stage or "", r.from_site, r.from_stage) for r in parts.routing_edges(df).collect())
    assert got == [("BOD", "S1", "WAF", "SDB", "WDC"), ("BOM", "SW", "", "ADC", "SGC")]


def test_master_part_list(spark):
    """A part that changes stage within a site gets an entry for the stage it is made at;
    the material move itself is not walked, a transport out of that stage is."""
    rows = [
        ("P1", "RAW", "S1_WAF", "S0_RAW", "r", "b"),
        ("P1", "P1", "S1_ASM", "S1_WAF", "r", "b"),
        ("P1", "P1", "S2_XFR", "S1_WAF", None, "b"),
    ]
    df = spark.createDataFrame(rows, "prod_item string, consum_item string, prod_fclty string, consum_fclty string, res_grp string, bom_name string")
    attrs = spark.createDataFrame([("P1",), ("Z9",)], "part_id string")
    got = {r.part_id: (r.default_stage, r.source_rank) for r in parts.master_part_list(df, attrs).collect()}
    assert got["P1"] == ("BOB", 1) and got["RAW"] == ("BOB", 2) and got["Z9"] == (None, 4)
    assert got["P1-WAF"] == ("XFR", 3) and "P1-ASM" not in got and "P1-XFR" not in got


def test_carry_forward(spark):
    delta = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    old = spark.createDataFrame([(1, "old", 5), (2, "old", 5), (7, "older", 4)], "k int, v string, d int")
    out = snapshots.carry_forward(delta, old, ["k"], "d", F.lit(6))
    assert sorted((r.k, r.v, r.d) for r in out.collect()) == [(1, "old", 6), (2, "new", 6), (3, "new", 6)]


def test_missing_and_inferred(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "fk string")
    dim = spark.createDataFrame([("a", "x")], "nk string, name string").withColumn("key", F.md5("nk"))
    missing = quality.missing_keys(fact, "fk", dim, "nk")
    assert sorted(r.missing_key for r in missing.collect()) == ["b", "c"]
    out = quality.insert_inferred(dim, missing, "nk", "key")
    assert quality.missing_keys(fact, "fk", out, "nk").isEmpty()
    assert quality.not_unique(out, "key").isEmpty() and quality.is_null(out, "key").isEmpty()


def test_truncate_and_convert(spark):
    r = spark.sql("SELECT cast(-1.239 AS decimal(10,3)) x, cast(10 AS decimal(18,2)) a").select(
        numbers.truncate(F.col("x"), 2).alias("t"),
        money.convert(F.col("a"), F.lit(0)).alias("zero"),
        money.convert(F.col("a"), F.lit(3)).alias("third"),
    ).first()
    assert (float(r.t), r.zero, float(r.third)) == (-1.23, None, 3.3333)


def test_pick_column_unknown_name(spark):
    df = spark.createDataFrame([("a", 1, 2), ("z", 1, 2)], "n string, x int, y int")
    out = df.select(reshape.pick_column(F.col("n"), {"a": F.col("x"), "b": F.col("y")}).alias("v"))
    assert [r.v for r in out.collect()] == [1, None]


def test_pos_flags(spark):
    from tidemark.plans import pos

    rows = [
        ("DIST", "C1", None, False, "FHS-1", "2018-06-24"),
        ("DIST", "C1", None, False, "FHS-1", "2018-06-25"),
        ("DIST", "C1", None, True, "AAA", "2018-01-01"),
        ("CIPO", "C1", None, False, "AAA", "2018-01-01"),
        ("CIPO", "C1", False, False, "AAA", "2018-01-01"),
        ("CIPO", "KSGC", True, False, "AAA", "2018-01-01"),
        ("OEM", "C1", None, False, None, "2018-01-01"),
    ]
    df = spark.createDataFrame(rows, "cls string, corp string, rep boolean, var boolean, div string, d string")
    true_pos = pos.is_true_pos(F.col("var"), F.col("div"), F.col("d").cast("date"))
    out = df.select(true_pos.alias("t"), pos.counts_as_pos(F.col("cls"), F.col("corp"), F.col("rep"), true_pos).alias("c"))
    assert [tuple(r) for r in out.collect()] == [
        (True, True), (False, False), (False, False), (True, True), (True, False), (True, False), (True, False)
    ]


def test_end_corporation_rules(spark):
    from tidemark.plans import pos

    rows = [(True, "E", "SE", "S", "D"), (True, "E", None, "S", "D"), (False, None, "SE", "S", "D"),
            (False, "E", "SE", "S", "D"), (False, None, None, None, "D")]
    df = spark.createDataFrame(rows, "same boolean, e string, se string, s string, d string")
    out = df.select(
        pos.end_corporation(*[F.col(c) for c in ("same", "e", "se", "s", "d")]).alias("c"),
        pos.end_corporation_rule(F.col("same"), F.col("e"), F.col("se")).alias("r"),
    )
    assert [tuple(r) for r in out.collect()] == [
        ("SE", "INDEndCorp-ShipEndMatch"), ("S", "INDCorp-NoINDEnd-ShipEndMatch"), ("SE", "INDEndCorp-NoPOSEnd"),
        ("E", "POSEndDefined"), ("D", "INDCorp-NoINDEnd"),
    ]


def test_unit_code(spark):
    df = spark.createDataFrame([("AB - Analog",), ("Analog (XY)",)], "n string")
    assert [r[0] for r in df.select(projects.unit_code(F.col("n"))).collect()] == ["AB", "XY"]


def test_hot_key_of_a_grouped_side_is_split(spark):
    """A third of the rows share one key; the join to its aggregate must run in many tasks."""
    from tidemark.operators.timeline import whole_key

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, -1, id) k", "id v", "sha2(cast(id AS string), 256) pad")
        out = whole_key(df, ["k"], {"m": F.max("v")})
        assert out.where("k = -1").agg(F.count("*"), F.min("m")).first()[:] == (20_000, 59_997)
        out.write.format("noop").mode("overwrite").save()
        rows = out.collect()
        assert len(rows) == 60_000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan[:3000]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_long_route_has_no_depth_cap(spark):
    schema = "part string, from_site string, from_stage string, to_site string, to_stage string, kind string"
    edges = spark.createDataFrame([("p", "s", str(i), "s", str(i + 1), "BOM") for i in range(1, 61)], schema)
    seeds = spark.createDataFrame([("p", "s", "1")], "part string, site string, stage string")
    got = graph.walk_paths(edges, seeds).collect()
    assert sorted(r.step for r in got) == list(range(1, 62))


def test_asof_tie_is_not_cut_and_null_keys_do_not_match(spark):
    left = spark.createDataFrame([("a", 5), (None, 5)], "k string, t int")
    right = spark.createDataFrame([("a", 3, "x" * 25 + "b"), ("a", 3, "x" * 25 + "a"), (None, 1, "n")], "k string, u int, v string")
    got = {r.k: r.v for r in joins.asof_join(left, right, ["k"], "t", "u", ["v"], tie="v").collect()}
    assert got == {"a": "x" * 25 + "b", None: None}
    numbers = spark.createDataFrame([("a", 3, 4.0), (None, 1, 9.0)], "k string, u int, w double")
    got = {r.k: r.m for r in joins.asof_max(left, numbers, ["k"], "t", "u", "w", "m").collect()}
    assert got == {"a": 4.0, None: None}


def test_two_current_weeks_double_the_rows(spark):
    rows = spark.createDataFrame([(1,), (2,)], "id int")
    weeks = spark.createDataFrame([(202401,), (202402,)], "week int")
    got = joins.stamp_period(rows, weeks, "week", "w").collect()
    assert sorted(map(tuple, got)) == [(i, w) for i in (1, 2) for w in (202401, 202402)]


def test_booking_flag_branches(spark):
    from tidemark.plans.backlog import booking

    rows = [
        ("OMD", 1, "2000-07-01", None, "N"), ("X", 0, "2000-07-01", None, "N"), ("X", 1, "2000-09-30", None, "Y"),
        ("X", 1, "2000-10-01", "2000-07-01", "N"), ("X", 1, None, "2000-07-01", "Y"), ("X", 1, None, "2001-07-01", "N"),
        ("X", 1, None, None, "N"), (None, None, "2000-07-01", None, "N"), (None, 2, "1999-01-01", None, "Y"),
    ]
    df = spark.createDataFrame(rows, "c string, q int, r string, s string, want string")
    day = lambda n: F.col(n).cast("date")
    flag = booking(F.col("c"), F.col("q"), day("r"), day("s"), F.lit("2000-06-30").cast("date"))
    assert df.where(flag != F.col("want")).count() == 0


def test_cost_of_equal_months_is_added_together(spark):
    from tidemark.plans.projects import cost_curve

    wide = spark.createDataFrame([("p", 30, 60)], "project string, a int, b int")
    got = cost_curve(wide, {"one": (F.lit("2000-01"), F.col("a")), "two": (F.lit("2000-01"), F.col("b"))}).collect()
    assert sorted({(str(r.process_date), float(r.running_cost)) for r in got}) == [
        ("2000-01-01", 30.0), ("2000-02-01", 60.0), ("2000-03-01", 90.0)
    ]


def test_more_than_a_thousand_parts_per_board(spark):
    from tidemark.plans.funnel import revenue

    row = spark.createDataFrame([(2_000_000_000.0, 1500, 1.25, 0.5)], "b double, n int, p double, s double")
    assert float(row.select(revenue(F.col("b"), F.col("n"), F.col("p"), F.col("s")).alias("r")).first().r) == 1_875_000_000_000.0


def test_checks_share_one_scan_of_the_fact(spark, tmp_path):
    """Six checks, a third of the rows under one key, null keys, an empty fact; the same keys as the single checks."""
    path = str(tmp_path / "fact")
    spark.sql(
        "SELECT id, if(id % 3 = 0, 0, id % 50) k, if(id % 11 = 0, NULL, id % 20) d, if(id % 13 = 0, NULL, 'x') c FROM range(600)"
    ).write.parquet(path)
    fact, dim = spark.read.parquet(path), spark.sql("SELECT id + 1 AS pk FROM range(12) UNION ALL SELECT NULL UNION ALL SELECT 1")
    checks = [
        quality.Check("id", "unique", "id"), quality.Check("k", "unique", "k"),
        quality.Check("some_k", "unique", "k", where=F.col("id") < 40), quality.Check("c", "not_null", "c"),
        quality.Check("d", "foreign", "d", dim, "pk"), quality.Check("k_dim", "foreign", "k", dim, "pk"),
    ]
    got = quality.failures(fact, checks)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("FileScan parquet") == 1
    rows = got.collect()
    keys = {c.name: {r.failed_key for r in rows if r.check_name == c.name} for c in checks}
    text = lambda df: {str(r[0]) for r in df.collect()}
    assert keys["id"] == set() and keys["k"] == text(quality.not_unique(fact, "k"))
    assert keys["some_k"] == text(quality.not_unique(fact, "k", F.col("id") < 40))
    assert keys["d"] == text(quality.missing_keys(fact, "d", dim, "pk"))
    assert keys["k_dim"] == text(quality.missing_keys(fact, "k", dim, "pk"))
    assert [(r.failed_key, r.n_records) for r in rows if r.check_name == "c"] == [(None, quality.is_null(fact, "c").count())]
    outcome = {r.check_name: r.status for r in quality.report(fact, checks).collect()}
    assert outcome == {c.name: "pass" if c.name == "id" else "fail" for c in checks}
    assert quality.failures(fact.limit(0), checks).count() == 0
    assert quality.failures(fact, []).count() == 0 and quality.report(fact, []).count() == 0
    with pytest.raises(ValueError):
        quality.Check("d", "foreign", "d")


def test_revenue_of_large_orders(spark):
    rows = [("10", "3", "1.234567", "0.5"), ("5", "2000000", "2", "1"), ("90000000000000", "40", "0.5", "0.25"), (None, "1", "1", "1")]
    df = spark.createDataFrame(rows, "boards string, per_board string, price string, share string")
    got = [r[0] for r in df.select(funnel.revenue(*[F.col(c).cast("decimal(38,8)") for c in df.columns])).collect()]
    want = [None if b is None else (Decimal(b) * Decimal(n) * Decimal(p) * Decimal(s)).quantize(Decimal("0.01"), ROUND_HALF_UP) for b, n, p, s in rows]
    assert got == want


def test_point_of_sale_rows_are_shuffled_once_for_each_key(spark, sf_dir):
    """Ship address, end address, direct customer, product: no exchange of whole rows for each rule or attribute."""
    from tidemark.queries.registry import QUERIES

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = QUERIES["pos_fact"](spark, sf_dir)
        plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    exchanges = [block for block in plan.split("\n\n") if block.lstrip().startswith("(") and ") Exchange" in block.split("\n")[0]]
    assert sum("resale" in block and "ship_day" in block for block in exchanges) <= 4


def test_governed_rows_without_a_date_are_refused_and_rows_without_a_key_kept(spark):
    f = spark.sql("SELECT * FROM VALUES ('m', null, 1), ('m', date'2024-05-01', 2), (null, null, 3), ('x', null, 4), ('m', date'2024-05-01', 5) AS t(k, d, id)")
    m = spark.sql("SELECT 'm' k, date'2024-01-01' s, date'2024-12-31' e, true yes UNION ALL SELECT null, date'2024-01-01', date'2024-12-31', false")
    out = joins.exists_or_absent(f, m, "k", "d", "s", "e", F.col("yes"))
    assert sorted(r.id for r in out.collect()) == [2, 3, 4, 5] and out.columns == f.columns


@pytest.mark.parametrize("few", [1, 12, 1000])
def test_parts_walked_in_a_row_and_by_rounds_agree(spark, few):
    """All parts by rounds, some, none: missing stages, kinds and parts, repeated edges, cycles, against a plain search."""
    rng = __import__("random").Random(5)
    pick = lambda *values: rng.choice(values)
    edges = [
        (f"p{p}", pick("a", "b", None), pick("1", "2", "3", None), pick("a", "b", None), pick("1", "2", "3", None), pick("BOM", "BOD", None))
        for p in range(20) for _ in range(p)
    ]
    edges += edges[::7] + [(None, "a", "1", "b", "2", "BOM")]
    seeds = [(f"p{p}", pick("a", "b", None), pick("1", "2", None)) for p in range(25) for _ in range(2)] + [(None, "a", "1")] * 2
    want = {}
    for part, site, stage in seeds:
        want[(part, site, stage, stage)] = 1
    frontier, step = set(want), 1
    while frontier:
        step, reached = step + 1, set()
        for part, site, stage, last in frontier:
            for p, fs, ft, ts, tt, kind in edges:
                if None not in (part, site, stage) and (p, fs, ft) == (part, site, stage):
                    reached.add((part, ts, tt, tt if kind == "BOM" else last))
        frontier = reached - set(want)
        want.update({s: step for s in frontier})
    e = spark.createDataFrame(edges, "part string, from_site string, from_stage string, to_site string, to_stage string, kind string")
    s = spark.createDataFrame(seeds, "part string, site string, stage string")
    got = graph.walk_paths(e, s, few=few)
    assert got.columns == ["part", "site", "stage", "last_stage", "step"]
    rows = got.collect()
    assert len(rows) == len(want) and {tuple(r[:4]): r.step for r in rows} == want


def test_small_parts_are_walked_without_rounds(spark, monkeypatch):
    """No job or checkpoint for a round: a route of 100 steps is one plan."""
    schema = "part string, from_site string, from_stage string, to_site string, to_stage string, kind string"
    edges = spark.createDataFrame([("p", "s", str(i), "s", str(i + 1), "BOM") for i in range(1, 101)], schema)
    seeds = spark.createDataFrame([("p", "s", "1")], "part string, site string, stage string")
    monkeypatch.setattr(graph, "cut_lineage", lambda df: pytest.fail("a round was checkpointed"))
    assert sorted(r.step for r in graph.walk_paths(edges, seeds).collect()) == list(range(1, 102))


def test_spread_is_narrow_and_follows_the_key(spark):
    """A few bits of the hash of the key, equal for equal keys, so that it costs next to nothing in a shuffled row."""
    from tidemark.operators.skew import spread

    rows = spark.range(1000).select(spread(["id"]).alias("a"), spread([F.col("id")]).alias("b"))
    assert dict(rows.dtypes) == {"a": "tinyint", "b": "tinyint"}
    assert rows.where("a <> b").isEmpty() and 1 < rows.select("a").distinct().count() <= 8

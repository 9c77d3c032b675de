"""Cells of dates and intervals, and rules matched by masks, against brute force."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import matching
from tidemark.operators.joins import date_span
from tidemark.operators.matching import Choice, Rule


@pytest.mark.parametrize("bits", [1, 2, 6])
def test_cells_cover_an_interval_exactly(spark, bits):
    """Every day of the span shares one cell with the interval if it lies inside, none if not."""
    last = 300
    pairs = spark.range(0, last + 1, 7).select(F.col("id").alias("a")).join(
        spark.range(0, last + 1, 11).select(F.col("id").alias("b")), F.col("a") <= F.col("b")
    )
    sizes = matching.levels(F.lit(last), bits)
    cover = pairs.select("a", "b", matching.cells_of_interval(F.col("a"), F.col("b"), sizes, bits).alias("cells"))
    days = spark.range(last + 1).select(F.col("id").alias("d"), matching.cells_of_day(F.col("id"), sizes, bits).alias("at"))
    at = {r.d: set(r.at) for r in days.collect()}
    levels = len(at[0])
    assert 2 ** (bits * levels) > last >= 2 ** (bits * (levels - 1))
    for r in cover.collect():
        cells = set(r.cells)
        assert len(cells) == len(r.cells) <= 2 * (2**bits - 1) * levels
        assert all(len(cells & at[d]) == (r.a <= d <= r.b) for d in at), (r.a, r.b)


def _facts(spark):
    return spark.sql(
        """SELECT id, if(id % 3 = 0, 0, id % 5) a, if(id % 4 = 0, null, id % 3) b,
           if(id % 50 = 7, null, date_add(date'1900-01-01', cast((id * 977) % 90000 AS int))) d, 'x' value, id % 2 rule
           FROM range(400) UNION ALL SELECT 5, 0, 1, date'2000-02-29', 'x', 1 FROM range(20)"""
    )


def _rules(spark):
    """One day to centuries, open ends, null key parts, ends before starts, equal starts, repeated rows."""
    return spark.sql(
        """SELECT if(id % 7 = 0, null, id % 5) a, if(id % 3 = 0, null, id % 3) b,
           date_add(date'1850-01-01', cast((id div 2 * 1711) % 100000 AS int)) s,
           CASE WHEN id % 10 = 0 THEN date'9999-12-31' WHEN id % 11 = 0 THEN null
             ELSE date_add(date'1850-01-01', cast((id div 2 * 1711) % 100000 + (id * id * 37) % 60000 - 40 * (id % 2) AS int)) END e,
           if(id % 13 = 0, null, cast(id AS string)) v FROM range(120)
           UNION ALL SELECT 0, 1, date'2000-02-29', date'2000-02-29', 'day' FROM range(3)"""
    )


@pytest.mark.parametrize("latest", [False, True])
@pytest.mark.parametrize("bits", [1, 4, 6])
def test_rules_match_like_brute_force(spark, latest, bits):
    facts, ref = _facts(spark), _rules(spark)
    rules = [Rule({"a": "a", "b": "b"}), Rule({"a": "a"}, F.col("b").isNull()), Rule({"b": "b"}, F.col("a").isNull())]
    choices = [
        Choice("found", ref, "v", "s", "e", rules, latest=latest, rule_out="found_rule"),
        Choice("turned", ref, "v", "s", "e", rules[::-1], latest=latest),
    ]
    got = matching.match_rules(facts, choices, "d", bits=bits)
    assert got.columns == [*facts.columns, "found", "found_rule", "turned"]

    rows = [r for r in ref.collect() if r.s and r.e and r.v is not None]
    same = [
        lambda f, r: r.a is not None and r.b is not None and (r.a, r.b) == (f.a, f.b),
        lambda f, r: r.b is None and r.a is not None and r.a == f.a,
        lambda f, r: r.a is None and r.b is not None and r.b == f.b,
    ]

    def first(f, order):
        for n, i in enumerate(order, 1):
            hits = [r for r in rows if f.d and r.s <= f.d <= r.e and same[i](f, r)]
            if hits:
                day = max(r.s for r in hits) if latest else None
                return min(r.v for r in hits if day is None or r.s == day), n
        return None, None

    out = got.collect()
    assert len(out) == facts.count()
    for f in out:
        assert (f.found, f.found_rule) == first(f, [0, 1, 2]), f
        assert f.turned == first(f, [2, 1, 0])[0], f
    assert {f.found_rule for f in out} == {None, 1, 2, 3}


def test_rules_on_empty_sides(spark):
    facts, ref = _facts(spark), _rules(spark)
    choice = lambda r: [Choice("found", r, "v", "s", "e", [Rule({"a": "a"})])]
    none = matching.match_rules(facts, choice(ref.limit(0)), "d")
    assert none.count() == facts.count() and none.where("found IS NOT NULL").isEmpty()
    assert matching.match_rules(facts.limit(0), choice(ref), "d").isEmpty()
    with pytest.raises(TypeError):
        matching.match_rules(facts.withColumn("a", F.col("a").cast("string")), choice(ref), "d")


def test_hot_key_is_asked_once_a_day_and_rows_go_back_once(spark):
    """A key with most rows: the join on cells sees distinct (key, day) only."""
    facts = spark.sql("SELECT id, 1L a, 2L b, date_add(date'2020-01-01', cast(id % 5 AS int)) d FROM range(50000)")
    ref = spark.sql("SELECT 1L a, date'2019-01-01' s, date_add(date'2020-01-01', cast(id AS int)) e, cast(id AS string) v FROM range(4)")
    span = date_span(facts, "d")
    got = matching.match_rules(facts, [Choice("found", ref, "v", "s", "e", [Rule({"a": "a"})], latest=True)], "d", span=span)
    assert {(r.d.day, r.found, r["count"]) for r in got.groupBy("d", "found").count().collect()} == {
        (1, "0", 10000), (2, "1", 10000), (3, "2", 10000), (4, "3", 10000), (5, None, 10000)
    }


def test_bridge_overrides_by_rule(spark):
    """Adjusted and reference corporation: exact, product-wide, own corporation of an indirect customer
    without an end corporation, out of time, and none."""
    from tidemark.plans.attribution import customer_bridge

    def table(sql, names):
        return spark.sql(f"SELECT * FROM VALUES {sql} AS t({names})")

    facts = table(
        """(1, 'p1', 'd', 'i', date'2020-05-01'), (2, 'p2', 'd', 'i', date'2020-05-01'), (3, 'p3', 'd', 'n', date'2020-05-01'),
        (4, 'p1', 'd', 'i', date'2019-01-01'), (5, 'p4', 'd', null, date'2020-05-01'), (6, 'p1', 'e', 'i', null)""",
        "txn_id, product, direct, indirect, process_date",
    )
    customers = table(
        "('d', 'DC', 'DE', 'OEM'), ('i', 'IC', 'IE', 'DIST'), ('n', 'NC', null, 'DIST'), ('e', 'EC', null, 'EMSI')",
        "customer, corp, end_corp, class",
    )
    interest = table(
        "('p1', 'e', null, 'COI', date'2000-01-01', date'9999-12-31')", "product, customer, corp, interest, from_date, to_date"
    ).withColumn("corp", F.col("corp").cast("string"))
    year = "date'2020-01-01', date'2020-12-31'"
    over = table(
        f"""('p1', 'd', 'i', 'IE', 'exact', {year}), ('p1', null, null, null, 'wide', {year}), ('p2', 'd', 'i', 'IC', 'no', {year}),
        ('p2', null, null, null, 'wide', {year}), ('p3', 'd', 'n', 'NC', 'lone', {year}), ('p4', 'x', 'y', 'Z', 'no', {year})""",
        "product, direct, indirect, end_corp, adjusted, from_date, to_date",
    )
    reference = over.where("adjusted <> 'exact'").withColumnRenamed("adjusted", "reference")
    corps, custom = spark.createDataFrame([], "corp string"), spark.createDataFrame([], "product string")
    out = customer_bridge(facts, customers, interest, over, corps, custom, reference).collect()
    got = {r.txn_id: (r.end_corp, r.adjusted_end_corp, r.reference_corp, r.end_corp_definition) for r in out}
    assert got == {
        1: ("IE", "exact", "wide", "SUBCorp"),
        2: ("IE", "wide", "wide", "SUBCorp"),
        3: ("NC", "lone", "lone", "SUBCorp"),
        4: ("IE", "IE", "IE", "SUBCorp"),
        5: (None, None, None, "SUBCorp"),
        6: ("EC", "EC", "EC", "NoCOI-Using DIRCoproration"),
    }


def test_whole_facts_are_shuffled_once(spark):
    """However many rules and looked-up columns there are, one exchange carries the facts' other columns."""
    facts, ref = _facts(spark).withColumn("payload", F.col("id") * 2), _rules(spark)
    rules = [Rule({"a": "a", "b": "b"}), Rule({"a": "a"}, F.col("b").isNull()), Rule({"b": "b"}, F.col("a").isNull())]
    choices = [Choice(f"found{i}", ref, "v", "s", "e", rules, latest=i == 1) for i in range(3)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = matching.match_rules(facts, choices, "d", span=date_span(facts, "d"))
        plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    exchanges = [block for block in plan.split("\n\n") if block.lstrip().startswith("(") and ") Exchange" in block.split("\n")[0]]
    assert len(exchanges) >= 4
    assert sum("payload" in block for block in exchanges) == 1


@pytest.mark.parametrize("few", [1, 20, 1000])
def test_rules_with_a_shared_key_match_like_brute_force(spark, few):
    """All shared keys crowded, some of them, none; null keys, a column fetched with the rules."""
    facts, ref = _facts(spark), _rules(spark).where("a IS NULL OR a < 3 OR s < date'1950-01-01'")
    rules = [Rule({"a": "a", "b": "b"}), Rule({"a": "a"}, F.col("b").isNull())]
    choices = [
        Choice("found", ref, "v", "s", "e", rules, rule_out="found_rule"),
        Choice("last", ref, "v", "s", "e", rules[::-1], latest=True),
    ]
    known = spark.sql("SELECT id a, 'k' || id known FROM range(1, 9)")
    got = matching.match_rules(facts, choices, "d", also=known, few=few)
    assert got.columns == [*facts.columns, "known", "found", "found_rule", "last"]
    rows = [r for r in ref.collect() if r.a is not None and r.s and r.e and r.v is not None]

    def first(f, order, latest):
        for n, exact in enumerate(order, 1):
            hits = [r for r in rows if f.d and r.s <= f.d <= r.e and r.a == f.a and (r.b == f.b if exact else r.b is None)]
            hits = [r for r in hits if not exact or r.b is not None]
            if hits:
                day = max(r.s for r in hits) if latest else None
                return min(r.v for r in hits if day is None or r.s == day), n
        return None, None

    out = got.collect()
    assert len(out) == facts.count() and {f.found_rule for f in out} == {None, 1, 2}
    for f in out:
        assert (f.found, f.found_rule) == first(f, [True, False], False), f
        assert f.last == first(f, [False, True], True)[0], f
        assert f.known == (f"k{f.a}" if 1 <= f.a < 9 else None)


def test_facts_with_a_shared_key_are_shuffled_once_and_not_repeated(spark, monkeypatch):
    """With short lists of rules no row of a fact is repeated for masks or cells, and nothing goes through a second exchange."""
    monkeypatch.setattr("tidemark.session.BROADCAST_ROW_LIMIT", 0)
    facts, ref = _facts(spark).where("a IS NOT NULL").withColumn("payload", F.col("id") * 2), _rules(spark)
    rules = [Rule({"a": "a", "b": "b"}), Rule({"a": "a"}, F.col("b").isNull())]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = matching.match_rules(facts, [Choice("found", ref, "v", "s", "e", rules)], "d", few=1000)
        plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    exchanges = [block for block in plan.split("\n\n") if block.lstrip().startswith("(") and ") Exchange" in block.split("\n")[0]]
    assert sum("payload" in block for block in exchanges) == 1 and len(exchanges) == 3

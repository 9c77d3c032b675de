"""Part master: supply paths and source precedence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import prefer_first
from tidemark.operators.graph import walk_paths
from tidemark.operators.joins import precedence_union


def site_of(facility):
    """Site part of a facility name ``SITE_STAGE``; SG1 counts as SW."""
    at = F.locate("_", facility)
    return F.when(facility == "SG1", "SW").when(at > 0, F.substring_index(facility, "_", 1)).otherwise(facility)


def stage_of(facility):
    """Stage part of a facility name.

    SDB is stage WDC; ADC_x_y and four bare names are stage SGC; a name without a
    stage has none.
    """
    at = F.locate("_", facility)
    adc = facility.rlike("^ADC_.*_")
    return (
        F.when(facility == "SDB", "WDC")
        .when((at > 0) & ~adc, F.regexp_extract(facility, "^[^_]*_(.*)$", 1))
        .when(adc | facility.isin("ADC", "IRC", "SRC", "GDC"), "SGC")
    )


def routing_edges(routing: DataFrame) -> DataFrame:
    """Bill-of-material rows as site/stage moves.

    ``routing``: ``prod_item, consum_item, prod_fclty, consum_fclty, res_grp, bom_name``.
    Rows without a BOM name or consuming site are dropped, as are material rows
    without a component. A resource group marks a material row (BOM); other rows
    move between sites (BOD).
    """
    kind = F.when(F.col("res_grp").isNotNull(), "BOM").otherwise("BOD")
    out = routing.select(
        "prod_item",
        "consum_item",
        kind.alias("kind"),
        site_of(F.col("prod_fclty")).alias("to_site"),
        stage_of(F.col("prod_fclty")).alias("to_stage"),
        site_of(F.col("consum_fclty")).alias("from_site"),
        stage_of(F.col("consum_fclty")).alias("from_stage"),
        "bom_name",
    )
    return out.where(
        F.col("bom_name").isNotNull()
        & F.col("from_site").isNotNull()
        & ~((F.col("kind") == "BOM") & F.col("consum_item").isNull())
    ).drop("bom_name")


def multistage_moves(edges: DataFrame) -> DataFrame:
    """Moves of parts that change stage within one site (they carry more than one stage)."""
    same = (
        edges.where(
            (F.col("kind") == "BOM")
            & (F.col("prod_item") == F.col("consum_item"))
            & (F.col("to_site") == F.col("from_site"))
            & (F.col("to_stage") != F.col("from_stage"))
        )
        .select(F.col("consum_item").alias("_part"), F.col("from_stage").alias("_stage"))
        .distinct()
    )
    made = same.select(F.col("_part").alias("prod_item"), F.col("_stage").alias("to_stage"), F.lit(True).alias("_made"))
    used = same.select(F.col("_part").alias("consum_item"), F.col("_stage").alias("from_stage"), F.lit(True).alias("_used"))
    return (
        edges.join(made, ["prod_item", "to_stage"], "left")
        .join(used, ["consum_item", "from_stage"], "left")
        .where(F.col("_made") | (F.col("_used") & (F.col("kind") == "BOD")))
        .select(*edges.columns)
    )


def supply_states(routing: DataFrame) -> DataFrame:
    """Site/stage states each multistage part passes, with its last material stage."""
    moves = multistage_moves(routing_edges(routing))
    seeds = (
        moves.where((F.col("kind") == "BOM") & (F.col("prod_item") != F.col("consum_item")))
        .groupBy(F.col("prod_item").alias("part"), F.col("to_stage").alias("stage"))
        .agg(F.max("to_site").alias("site"))
    )
    steps = moves.where(F.col("prod_item") == F.col("consum_item")).withColumnRenamed("prod_item", "part")
    return walk_paths(steps, seeds)


def master_part_list(routing: DataFrame, attributes: DataFrame) -> DataFrame:
    """All parts of the planning system; an earlier source wins.

    Produced parts, consumed parts, part-stage combinations of multistage parts,
    then parts known by attributes only.
    """
    def listed(item: str) -> DataFrame:
        rows = routing.where(~F.col(item).like("COE%"))
        tail = F.regexp_replace(F.col(item), "^[^_]*_", "")
        return rows.groupBy(F.col(item).alias("part_id")).agg(
            F.max(tail).alias("base_part_id"), F.lit("BOB").alias("default_stage")
        )

    walked = (
        supply_states(routing)
        .groupBy(F.concat("part", F.lit("-"), "last_stage").alias("part_id"))
        .agg(F.max("part").alias("base_part_id"), F.max("stage").alias("default_stage"))
    )
    known = attributes.select("part_id", F.col("part_id").alias("base_part_id")).distinct()
    return prefer_first([listed("prod_item"), listed("consum_item"), walked, known], ["part_id"], [F.col("base_part_id").asc()])


def stage_summary(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Per part and last material stage: the default stage and the number of states."""
    states = walk_paths(edges, seeds)
    return states.groupBy("part", "last_stage").agg(
        F.max("stage").alias("default_stage"), F.count("*").alias("states")
    )


def part_precedence(engineering: DataFrame, legacy: DataFrame, planning: DataFrame, key: str) -> DataFrame:
    """Part master: engineering, then legacy, then planning parts not seen before."""
    return precedence_union([engineering, legacy, planning], [key])

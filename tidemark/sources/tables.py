"""Scans, seeds, literal tables and incremental reads."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import instant, parse_any
from tidemark.operators.skew import attach
from tidemark.session import broadcast_bounded


def scan(
    spark: SparkSession, folder: str, name: str, columns: Mapping[str, str] | None = None
) -> DataFrame:
    """Read one parquet table; ``columns`` maps output name to source column."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    if columns is None:
        return df
    return df.select(*[F.col(src).alias(out) for out, src in columns.items()])


def load_seed(
    spark: SparkSession,
    path: str,
    schema: str,
    timestamps: Sequence[str] = (),
    formats: Sequence[str] = ("yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm"),
) -> DataFrame:
    """Small reference CSV with a header row and a typed schema.

    Columns in ``timestamps`` are declared as strings in ``schema`` and parsed
    here, because hand-kept files mix layouts within one column.
    """
    df = spark.read.schema(schema).option("header", True).option("quote", '"').csv(path)
    for name in timestamps:
        df = df.withColumn(name, parse_any(F.col(name), formats))
    return df


def constant_table(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """A literal table. Its size is fixed by the code, so it may be broadcast."""
    structs = [
        F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row, strict=True)]) for row in rows
    ]
    return broadcast_bounded(spark.range(1).select(F.inline(F.array(*structs))), len(rows))


def seed_from_text(
    spark: SparkSession, text: str, schema: str, timestamps: Sequence[str] = (), formats: Sequence[str] = ()
) -> DataFrame:
    """A seed shipped with the code: CSV text with a header line.

    The text travels in the plan, so executors need no access to the driver's disk.
    """
    lines = [line for line in text.strip().splitlines()[1:] if line]
    rows = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in lines])).alias("line"))
    df = rows.select(F.from_csv("line", F.lit(schema)).alias("r")).select("r.*")
    for name in timestamps:
        df = df.withColumn(name, parse_any(F.col(name), formats))
    return broadcast_bounded(df, len(lines))


def generate_rows(spark: SparkSession, n: int, name: str = "n") -> DataFrame:
    """Rows 0 .. n-1."""
    return spark.range(n).withColumnRenamed("id", name)


def read_since(
    df: DataFrame, ts: str, lwm, hwm, *, inclusive_high: bool = False
) -> DataFrame:
    """Rows loaded in ``[lwm, hwm)``.

    The column is compared bare, so the predicate reaches the parquet reader
    and prunes date partitions.
    """
    c = F.col(ts)
    high = c <= instant(hwm) if inclusive_high else c < instant(hwm)
    return df.where((c >= instant(lwm)) & high)


@dataclass(frozen=True)
class LoadWindow:
    low: str
    high: str

    @classmethod
    def choose(
        cls,
        low: str,
        high: str,
        *,
        backfill: bool = False,
        start: str | None = None,
        end: str | None = None,
    ) -> LoadWindow:
        """The stored watermarks, or the explicit bounds of a backfill."""
        return cls(start or low, end or high) if backfill else cls(low, high)

    def read(self, df: DataFrame, ts: str) -> DataFrame:
        return read_since(df, ts, self.low, self.high)


def expand_changed_keys(df: DataFrame, keys: Sequence[str], changed: DataFrame) -> DataFrame:
    """All rows of every key that occurs in ``changed``."""
    return attach(df, changed.select(*keys).distinct(), keys, "left_semi")


def impacted(
    df: DataFrame,
    direct: Column,
    refs: Iterable[tuple[Sequence[str], DataFrame]],
    *,
    backfill: bool = False,
) -> DataFrame:
    """Rows changed themselves or touched by a changed reference row.

    Each reference contributes the distinct key tuples that changed. They are
    joined as markers, so the fact is read once however many references there
    are, and a tuple with a null part matches nothing.
    """
    if backfill:
        return df
    keep = F.coalesce(direct, F.lit(False))
    out, marks = df, []
    for i, (keys, changed) in enumerate(refs):
        mark = f"_hit{i}"
        keyset = changed.select(*keys).distinct().withColumn(mark, F.lit(True))
        out = attach(out, keyset, keys)
        keep = keep | F.coalesce(F.col(mark), F.lit(False))
        marks.append(mark)
    return out.where(keep).select(*df.columns)


def with_history(current: DataFrame, legacy: Iterable[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Add one-time history rows whose key is in neither the table nor an earlier history."""
    out = current
    seen = current.select(*keys)
    for old in legacy:
        fresh = attach(old, seen.distinct(), keys, "left_anti")
        out = out.unionByName(fresh, allowMissingColumns=True)
        seen = seen.unionByName(old.select(*keys))
    return out


def backfill(
    job: Callable[[DataFrame], DataFrame],
    df: DataFrame,
    ts: str,
    start: str,
    end: str,
    step_days: int | None = None,
) -> DataFrame:
    """Run ``job`` over a date range.

    One distributed job by default. With ``step_days`` the rows are tagged with
    their slice instead of looping on the driver, so a job that works row by row
    gives the same result and a sliced write only needs ``partitionBy("slice")``.
    """
    part = read_since(df, ts, start, end)
    if step_days is None:
        return job(part)
    days = F.datediff(F.col(ts).cast("date"), F.lit(start).cast("date"))
    lo = F.date_add(F.lit(start).cast("date"), (F.floor(days / step_days) * step_days).cast("int"))
    return job(part.withColumn("slice", lo))

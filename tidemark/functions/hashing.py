"""Surrogate keys and row hashes.

A hash is only as stable as the text it is taken from, so every value first
gets a canonical text: decimals and floating values with a fixed scale,
timestamps to the second, dates as ISO. The object form leaves out null
members, so adding an always-null column does not change a hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN_MEMBER = "-1"


def canonical_text(c: Column, dtype: T.DataType, float_scale: int | None = 6) -> Column:
    """Text of a value that does not depend on how an engine prints it.

    ``float_scale=None`` keeps the engine's own shortest text of a floating
    value, which loses nothing but is not comparable across engines.
    """
    if isinstance(dtype, (T.DoubleType, T.FloatType)) and float_scale is not None:
        return c.cast(T.DecimalType(38, float_scale)).cast("string")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return c.cast("string")


def object_text(members: Mapping[str, Column]) -> Column:
    """``{"k":v,...}`` of string columns in the given order; null members are left out."""
    parts = [
        F.when(value.isNotNull(), F.concat(F.lit(f'"{name}":'), value))
        for name, value in members.items()
    ]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def surrogate_key(*parts: Column) -> Column:
    """MD5 of one natural key, or of several joined with ``--``; null in, null out."""
    texts = [p.cast("string") for p in parts]
    if len(texts) == 1:
        return F.md5(texts[0])
    joined = texts[0]
    for text in texts[1:]:
        joined = F.concat(joined, F.lit("--"), text)
    return F.md5(joined)


def object_key(members: Mapping[str, Column]) -> Column:
    """MD5 of the object text of the key parts; a null part is simply absent."""
    return F.md5(object_text({k: v.cast("string") for k, v in members.items()}))


def member_key(c: Column) -> Column:
    """Key of a dimension member, with the unknown member for null."""
    return F.md5(F.coalesce(c.cast("string"), F.lit(UNKNOWN_MEMBER)))


def version_id(*parts: Column) -> Column:
    """Id of one version of a row: MD5 of the parts joined with ``|``, null as empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def row_hash(
    df: DataFrame, exclude: Iterable[str] = (), float_scale: int | None = 6
) -> Column:
    """MD5 over all columns of ``df`` except keys and housekeeping, in schema order."""
    skip = set(exclude)
    members = {}
    for field in df.schema.fields:
        if field.name in skip:
            continue
        members[f"col{len(members) + 1}"] = canonical_text(
            F.col(field.name), field.dataType, float_scale
        )
    return F.md5(object_text(members))

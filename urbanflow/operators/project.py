"""Projections over inputs whose columns and types drift between deliveries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import TIME_PARTS


class MissingColumns(ValueError):
    """An input lacks columns a plan cannot do without."""


def missing(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """The columns of ``cols`` the input lacks, ignoring case."""
    have = {c.lower() for c in df.columns}
    return [c for c in cols if c.lower() not in have]


def require(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """The input itself, or ``MissingColumns``."""
    lacking = missing(df, cols)
    if lacking:
        raise MissingColumns(f"missing columns: {lacking}")
    return df


def conform(df: DataFrame, schema: T.StructType, optional: Iterable[str] = ()) -> DataFrame:
    """Select the schema's columns, by name without case, at the schema's types.

    A value that does not convert becomes NULL.  A column already at its type is
    passed through uncast, which keeps filters on it pushable to the scan.
    Lacking ``optional`` columns become NULL; any other lacking column raises.
    """
    optional = {c.lower() for c in optional}
    require(df, [f.name for f in schema if f.name.lower() not in optional])
    have = {f.name.lower(): f for f in df.schema}
    out = []
    for field in schema:
        stored = have.get(field.name.lower())
        if stored is None:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif stored.dataType == field.dataType:
            out.append(F.col(f"`{stored.name}`").alias(field.name))
        else:
            out.append(F.col(f"`{stored.name}`").try_cast(field.dataType).alias(field.name))
    return df.select(*out)


def presentation_view(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed projection for publishing; columns the input lacks are NULL."""
    return conform(df, schema, optional=[f.name for f in schema])


def keep_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Those of ``cols`` the input has, in the order given."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have])


def select_except(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """All columns but these; names the input lacks are ignored."""
    return df.drop(*cols)


def rename_first(df: DataFrame, candidates: Iterable[str], to: str) -> DataFrame:
    """Rename the first candidate the input has; nothing if ``to`` exists."""
    if to in df.columns:
        return df
    found = next((c for c in candidates if c in df.columns), None)
    return df.withColumnRenamed(found, to) if found else df


def prefix_cols(df: DataFrame, prefix: str, cols: Iterable[str] = TIME_PARTS) -> DataFrame:
    """Prefix these columns so that they do not clash in a join."""
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in cols if c in df.columns})


def apply_if_present(df: DataFrame, col: str, fn) -> DataFrame:
    """Replace ``col`` by ``fn(col)`` where the input has it."""
    return df.withColumn(col, fn(col)) if col in df.columns else df


def fill_zero(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NULL to 0 in all numeric columns, or in those of ``cols`` present."""
    if cols is None:
        return df.na.fill(0)
    present = [c for c in cols if c in df.columns]
    return df.na.fill(0, subset=present) if present else df

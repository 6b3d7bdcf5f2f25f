"""Declared data tests as Spark jobs (Q1-Q10) and snapshot comparison.

Each check returns the violating rows; ``failures`` wraps any of them into a
one-row ``(check, column, failures)`` summary so many checks union into one
small report without collecting anything on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffled
from .snapshots import diff_rows

# ---------------------------------------------------------------- fixed values
WALLS_ENV_EFF_VALUES = ["Very Good", "Good", "Average", "Poor", "Very Poor", "N/A"]
GLAZED_AREA_VALUES = [
    "Much More Than Typical",
    "More Than Typical",
    "Normal",
    "Less Than Typical",
    "Much Less Than Typical",
    "NO DATA!",
]
POSTCODE_OR_NA_REGEX = r"^([A-Z]{1,2}[0-9R][0-9A-Z]? [0-9][A-Z]{2})|(N\/A)$"
# ---------------------------------------------------------------- /fixed values


def accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows outside ``[lo, hi]``; NULL passes."""
    return df.filter(~F.col(col).between(lo, hi))


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def relationship(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key is missing from the parent (anti join)."""
    keys = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return child.filter(F.col(child_key).isNotNull()).join(shuffled(keys), F.col(child_key) == F.col("__pk"), "left_anti")


def regex_match(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Rows whose value does not match ``pattern`` (search semantics); NULL passes."""
    return df.filter(~F.col(col).rlike(pattern))


def expression_true(df: DataFrame, expr: Column) -> DataFrame:
    return df.filter(~expr)


def unique(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def failures(check: str, col: str, violating: DataFrame) -> DataFrame:
    return violating.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(check).alias("check"), F.lit(col).alias("column"), "failures"
    )


def all_null(check: str, df: DataFrame, col: str) -> DataFrame:
    """One row; ``failures`` = number of non-NULL values (0 passes)."""
    return df.agg(F.count(F.col(col)).alias("failures")).select(F.lit(check).alias("check"), F.lit(col).alias("column"), "failures")


def column_type(check: str, df: DataFrame, col: str, allowed: Sequence[type]) -> DataFrame:
    """Schema check on the driver (metadata only) as a one-row frame."""
    dt = df.schema[col].dataType
    bad = 0 if isinstance(dt, tuple(allowed)) else 1
    return df.sparkSession.range(1).select(
        F.lit(check).alias("check"), F.lit(col).alias("column"), F.lit(bad).cast("long").alias("failures")
    )


def report(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- snapshot comparison ------------------------------------------------------


def schema_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns present on one side only: ``(column, side)``."""
    sa, sb = set(a.columns), set(b.columns)
    rows = [(c, "left_only") for c in sorted(sa - sb)] + [(c, "right_only") for c in sorted(sb - sa)]
    return a.sparkSession.createDataFrame(rows, "column string, side string")


def table_diff(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Keyed row diff in long form: ``(key, column, old, new, change)`` with change in added / removed / changed, as
    ``snapshots.diff_rows`` has it: repeated keys are paired row by row, rows without a key never."""
    return diff_rows(a, b, [key], cols).drop("occurrence")


def frames_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: ``equal`` plus the rows only in each side (multiset)."""
    same_schema = [f.name for f in a.schema.fields] == [f.name for f in b.schema.fields]
    tagged = a.exceptAll(b).select(F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        b.exceptAll(a).select(F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counts = tagged.agg(
        F.coalesce(F.sum("l"), F.lit(0)).cast("long").alias("only_left"),
        F.coalesce(F.sum("r"), F.lit(0)).cast("long").alias("only_right"),
    )
    return counts.select(
        ((F.col("only_left") == 0) & (F.col("only_right") == 0) & F.lit(same_schema)).alias("equal"), "only_left", "only_right"
    )

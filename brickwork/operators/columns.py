"""Column-wide projection operators: typed staging from a spec, strip and
placeholder nulling of every text column, blank columns, renames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import null_placeholder, trim_ws
from ..session import unsorted_writes

# Cast rules for one staged column.
TEXT, NULLIF, STRICT, NO_DATA = "text", "nullif", "strict", "no_data"
NO_DATA_TEXT = "NO DATA!"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def staged_column(raw: str | None, dtype: str, rule: str, lenient: bool = False) -> Column:
    """One staged value from a raw text column.

    * ``text``: cast to text.
    * ``nullif``: ``''`` -> NULL, then cast.
    * ``strict``: plain cast; under ANSI ``''`` raises.  ``lenient`` turns it
      into ``try_cast`` (invalid -> NULL).
    * ``no_data``: ``''``/NULL -> ``NO DATA!``.
    ``raw=None`` yields a typed NULL (padding for a narrower feed).
    """
    if raw is None:
        return F.lit(NO_DATA_TEXT) if rule == NO_DATA else F.lit(None).cast(dtype)
    c = _q(raw)
    if rule == TEXT:
        return c.cast(dtype)
    if rule == NULLIF:
        return F.nullif(c, F.lit("")).cast(dtype)
    if rule == STRICT:
        return c.try_cast(dtype) if lenient else c.cast(dtype)
    if rule == NO_DATA:
        return F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit(NO_DATA_TEXT))
    raise ValueError(rule)


def stage(df: DataFrame, spec: Sequence[tuple], lenient: bool = False, tags: dict | None = None) -> DataFrame:
    """Rename + cast a raw feed in one projection.

    ``spec`` rows are ``(raw_name_or_None, out_name, dtype, rule)``;
    ``tags`` adds literal columns (e.g. the feed name).
    """
    cols = [staged_column(raw, dtype, rule, lenient).alias(out) for raw, out, dtype, rule in spec]
    cols += [F.lit(v).alias(k) for k, v in (tags or {}).items()]
    return df.select(*cols)


ERRORS = "_errors"
_ERROR = "array<struct<column: string, value: string, type: string, rule: string>>"


def checked(df: DataFrame, spec: Sequence[tuple], tags: dict | None = None) -> DataFrame:
    """``stage`` with an error channel: values that their strict cast would refuse become NULL and are listed in
    ``_errors`` (column, raw value, type, rule), so one bad value neither stops the run nor goes unseen."""
    found = []
    for raw, out, dtype, rule in spec:
        if raw is None or dtype == "string":
            continue
        text = _q(raw).cast("string")
        given = F.nullif(text, F.lit("")) if rule == NULLIF else text
        bad = given.isNotNull() & given.try_cast(dtype).isNull()
        found.append(F.when(bad, F.struct(F.lit(out).alias("column"), text.alias("value"), F.lit(dtype).alias("type"), F.lit(rule).alias("rule"))))
    errors = F.filter(F.array(*found), lambda e: e.isNotNull()) if found else F.array().cast(_ERROR)
    cols = []
    for raw, out, dtype, rule in spec:
        if raw is None or dtype == "string":
            value = staged_column(raw, dtype, rule)
        else:
            text = F.nullif(_q(raw).cast("string"), F.lit("")) if rule == NULLIF else _q(raw).cast("string")
            value = text.try_cast(dtype)
        cols.append(value.alias(out))
    cols += [F.lit(v).alias(k) for k, v in (tags or {}).items()]
    return df.select(*cols, errors.cast(_ERROR).alias(ERRORS))


def accepted(staged: DataFrame) -> DataFrame:
    """The rows without an error."""
    return staged.filter(F.size(ERRORS) == 0).drop(ERRORS)


def quarantine(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One line an error: the row's ``keys``, column, raw value, type and rule."""
    return staged.select(*keys, F.explode(ERRORS).alias("e")).select(*keys, "e.*")


def write_checked(staged: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Writes the staged rows once, good and bad apart by directory, and returns (accepted, refused) readers:
    the feed is read and cast one time only, and a reader of the good rows never opens the others."""
    with unsorted_writes(staged.sparkSession, 2):
        staged.withColumn("_bad", F.size(ERRORS) > 0).write.mode("overwrite").partitionBy("_bad").parquet(path)
    schema = T.StructType([*staged.schema.fields, T.StructField("_bad", T.BooleanType())])
    table = staged.sparkSession.read.schema(schema).parquet(path)
    return table.filter(~F.col("_bad")).drop("_bad", ERRORS), table.filter("_bad").drop("_bad")


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def strip_all(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Strip surrounding whitespace of every text column, one projection."""
    todo = set(cols) if cols is not None else set(text_columns(df))
    return df.select(*[trim_ws(_q(c)).alias(c) if c in todo else _q(c) for c in df.columns])


def null_placeholders_all(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NULL every placeholder value (unknown, no data!, n/a, ...) in every
    text column, one projection."""
    todo = set(cols) if cols is not None else set(text_columns(df))
    return df.select(*[null_placeholder(_q(c)).alias(c) if c in todo else _q(c) for c in df.columns])


def strip_and_null_all(df: DataFrame) -> DataFrame:
    """Strip then placeholder-null every text column in a single projection."""
    todo = set(text_columns(df))
    return df.select(*[null_placeholder(trim_ws(_q(c))).alias(c) if c in todo else _q(c) for c in df.columns])


def add_blank_columns(df: DataFrame, names: Sequence[str], dtype: str = "double") -> DataFrame:
    return df.withColumns({n: F.lit(None).cast(dtype) for n in names})


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename present columns; unknown keys are ignored (as pandas does)."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def header_title_no_underscore(names: Sequence[str]) -> list[str]:
    """Bulk header normalisation: Python title-case, then drop ``_``
    (metadata only, computed on the driver)."""
    return [n.title().replace("_", "") for n in names]


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*header_title_no_underscore(df.columns))

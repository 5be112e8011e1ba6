"""Cleaning operators (obfuscation filters, null profile, overrides, safe casts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hirelens.functions.text import all_obfuscated, any_obfuscated, is_obfuscated, safe_date, safe_double
from hirelens.operators.enrich import drop_obfuscated_rows, require_columns

__all__ = ["drop_obfuscated_rows", "drop_rows_with_any_obfuscated", "null_profile", "apply_overrides",
           "safe_casts", "require_columns", "drop_obfuscated_counted", "is_obfuscated"]


def _string_cols(df: DataFrame) -> set[str]:
    return {c for c, t in df.dtypes if t == "string"}


def drop_rows_with_any_obfuscated(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """P5: drop a row if any of ``cols`` (default all) is obfuscated."""
    cols = cols or df.columns
    return df.where(~any_obfuscated(cols, _string_cols(df)))


def drop_obfuscated_counted(df: DataFrame, cols: list[str]) -> tuple[DataFrame, Observation]:
    """P4 + P6: the rows that stay, and an observation of ``rows`` (read) and ``dropped``.

    The counts are collected by the first action on the returned frame, without a
    job of their own; read ``observation.get`` after it.
    """
    seen = Observation()
    gone = all_obfuscated(cols, _string_cols(df))
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(gone).alias("dropped"))
    return counted.where(~gone), seen


def null_profile(df: DataFrame) -> DataFrame:
    """One aggregation pass → (column_name, dtype, nulls, total)."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(F.count(F.lit(1)).alias("total"), *aggs)
    stack = ", ".join(f"'{c}', '{t}', n{i}" for i, (c, t) in enumerate(df.dtypes))
    return wide.selectExpr("total", f"stack({len(df.columns)}, {stack}) AS (column_name, dtype, nulls)") \
        .select("column_name", "dtype", "nulls", "total")


def apply_overrides(base: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """Hand patches keyed by ``key``; a non-null override value wins.

    Two patches of one key fail the query: they would multiply the row, or
    one of them would win by chance.
    """
    cols = [c for c in overrides.columns if c != key]
    single = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(F.lit("several overrides for "), F.any_value(key).cast("string"))).cast("boolean"))
    o = overrides.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.any_value(c).alias(f"_o_{c}") for c in cols], single.alias("_single")).where(F.col("_single").isNull())
    j = base.join(o, key, "left")
    return j.select(*[F.coalesce(F.col(f"_o_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
                      for c in base.columns])


def safe_casts(df: DataFrame, value_col: str, date_col: str) -> DataFrame:
    """Text → double / date without failing (ANSI-safe), 'Unknown' date label,
    a disclosed flag and its label."""
    v = safe_double(value_col)
    dt = safe_date(date_col)
    band = F.when(v.isNull(), F.lit("Not disclosed")).otherwise(F.lit("Disclosed"))
    return df.withColumns({
        "value_num": v,
        "event_date": dt,
        "event_date_filled": F.coalesce(F.date_format(dt, "yyyy-MM-dd"), F.lit("Unknown")),
        "value_disclosed": v.isNotNull(),
        "value_group": band,
    })




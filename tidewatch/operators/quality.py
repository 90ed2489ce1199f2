"""Data-quality checks over any table: missing fields, duplicate URLs, text lengths,
language values, date range; and the combined report.

Every scalar check of the report is computed in ONE aggregate pass over the table
(one scan, one single-row result), instead of one query per field.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.sources.bindings import ts_lit


def total_records(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("total"))


def _stack(one_row: DataFrame, items: list[tuple[str, str, str]]) -> DataFrame:
    """[(check, field, column-in-one_row)] -> long rows (check, field, value double)."""
    arr = F.array(*[F.struct(F.lit(c).alias("check"), F.lit(f).alias("field"),
                             F.col(col).cast("double").alias("value")) for c, f, col in items])
    return one_row.select(F.inline(arr))


def missing_fields(df: DataFrame, null_conditions: dict[str, str]) -> DataFrame:
    """Per field: rows matching its SQL condition, total rows, percent to one decimal."""
    aggs = [F.count(F.lit(1)).alias("_total")] + [
        F.count_if(F.expr(cond)).alias(f"_m{i}") for i, cond in enumerate(null_conditions.values())]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(field).alias("field"), F.col(f"_m{i}").alias("missing"))
                     for i, field in enumerate(null_conditions)])
    return (one.select("_total", F.inline(rows))
            .filter(F.col("_total") > 0)
            .select("field", F.col("missing").cast("bigint").alias("missing"),
                    F.col("_total").cast("bigint").alias("total"),
                    F.round(F.col("missing") * 100.0 / F.col("_total"), 1).alias("pct")))


def duplicate_urls(df: DataFrame, url_column: str = "url", limit: int = 10) -> DataFrame:
    """Values occurring more than once, by count DESC then value (NULLs last), top ``limit``.

    Partial aggregation runs before the shuffle, so a hot value costs one row per task.
    """
    g = (df.groupBy(F.col(url_column).alias("url_value"))
         .agg(F.count(F.lit(1)).cast("bigint").alias("cnt")).filter(F.col("cnt") > 1))
    if limit <= 0:
        return g.limit(0)
    return g.orderBy(F.desc("cnt"), F.asc_nulls_last("url_value")).limit(limit)


def text_lengths(df: DataFrame, text_columns: list[str]) -> DataFrame:
    """AVG / MIN / MAX of character length per column (NULLs ignored), one pass."""
    if not text_columns:
        return df.sparkSession.createDataFrame([], "column string, avg_len double, min_len bigint, max_len bigint")
    aggs = []
    for i, c in enumerate(text_columns):
        ln = F.length(F.col(c))
        aggs += [F.avg(ln).alias(f"_a{i}"), F.min(ln).alias(f"_n{i}"), F.max(ln).alias(f"_x{i}")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_a{i}").alias("avg_len"),
                              F.col(f"_n{i}").cast("bigint").alias("min_len"),
                              F.col(f"_x{i}").cast("bigint").alias("max_len"))
                     for i, c in enumerate(text_columns)])
    return one.select(F.inline(rows))


def language_distribution(df: DataFrame, language_column: str = "language",
                          allowed: set[str] | None = None) -> DataFrame:
    """COUNT per value (count DESC, value); ``invalid`` flags non-NULL values outside ``allowed``."""
    v = F.col("language_value")
    invalid = F.lit(False) if allowed is None else F.coalesce(
        v.isNotNull() & ~v.isin(*sorted(allowed)), F.lit(False))
    return (df.groupBy(F.col(language_column).alias("language_value"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("cnt"))
            .withColumn("invalid", invalid)
            .orderBy(F.desc("cnt"), F.asc_nulls_last("language_value")))


def allowed_language(df: DataFrame, language_column: str, allowed: set[str]) -> DataFrame:
    """Rows whose language is non-NULL and outside the allowed set."""
    col = F.col(language_column)
    return df.filter(col.isNotNull() & ~col.isin(*sorted(allowed)))


def date_range_check(df: DataFrame, date_column: str, as_of: dt.datetime) -> DataFrame:
    """MIN, MAX and the number of values after ``as_of``, one pass."""
    c = F.col(date_column)
    return df.agg(F.min(c).alias("oldest"), F.max(c).alias("newest"),
                  F.count_if(c > ts_lit(as_of)).cast("bigint").alias("future"))


def quality_report(df: DataFrame, *, null_conditions: dict[str, str], text_columns: list[str],
                   language_column: str, allowed_languages: set[str] | None, url_column: str,
                   date_column: str, as_of: dt.datetime, dup_limit: int = 10) -> DataFrame:
    """All checks as long rows (check, field, value).

    Scalar checks (total, missing, lengths, dates) share one aggregate pass; the language
    distribution and duplicate URLs are two grouped aggregates over the same scan.
    """
    c = F.col(date_column)
    aggs = [F.count(F.lit(1)).alias("_total")]
    items = [("total_records", "*", "_total")]
    for i, (field, cond) in enumerate(null_conditions.items()):
        aggs.append(F.count_if(F.expr(cond)).alias(f"_m{i}"))
        items.append(("missing", field, f"_m{i}"))
    for i, col in enumerate(text_columns):
        ln = F.length(F.col(col))
        aggs += [F.avg(ln).alias(f"_a{i}"), F.min(ln).alias(f"_n{i}"), F.max(ln).alias(f"_x{i}")]
        items += [("avg_len", col, f"_a{i}"), ("min_len", col, f"_n{i}"), ("max_len", col, f"_x{i}")]
    aggs += [(F.unix_micros(F.min(c).cast("timestamp")) / 1e6).alias("_d0"),
             (F.unix_micros(F.max(c).cast("timestamp")) / 1e6).alias("_d1"),
             F.count_if(c > ts_lit(as_of)).alias("_d2")]
    items += [("oldest", date_column, "_d0"), ("newest", date_column, "_d1"),
              ("future", date_column, "_d2")]
    scalars = _stack(df.agg(*aggs), items)
    langs = language_distribution(df, language_column, allowed_languages).select(
        F.lit("language").alias("check"),
        F.coalesce(F.col("language_value"), F.lit("NULL")).alias("field"),
        F.col("cnt").cast("double").alias("value"))
    dups = duplicate_urls(df, url_column, dup_limit).select(
        F.lit("duplicate_url").alias("check"),
        F.coalesce(F.col("url_value").cast("string"), F.lit("NULL")).alias("field"),
        F.col("cnt").cast("double").alias("value"))
    return scalars.unionByName(langs).unionByName(dups)

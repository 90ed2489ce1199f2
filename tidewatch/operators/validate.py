"""Row validation: field checks in a fixed order, and the valid / invalid split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import strip_py, valid_url

# --- fixed values: validation messages (in check order) -----------------------------------
MSG_TITLE_MISSING = "title is missing or not a string"
MSG_TITLE_EMPTY = "title is empty"
MSG_LINK_MISSING = "link is missing or not a string"
MSG_LINK_INVALID = "link has invalid URL format: "
MSG_SUMMARY_MISSING = "summary is missing or not a string"
MSG_SUMMARY_EMPTY = "summary is empty"
MSG_SOURCE_MISSING = "source is missing or not a string"
MSG_CATEGORY_MISSING = "category is missing or not a string"
# -------------------------------------------------------------------------------------------


def _missing(c: Column) -> Column:
    """Python falsiness of a string field: NULL or ''."""
    return c.isNull() | (c == "")


def validation_errors(title: Column, link: Column, summary: Column, source: Column,
                      category: Column) -> Column:
    checks = [
        F.when(_missing(title), F.lit(MSG_TITLE_MISSING))
         .when(strip_py(title) == "", F.lit(MSG_TITLE_EMPTY)),
        F.when(_missing(link), F.lit(MSG_LINK_MISSING))
         .when(~valid_url(link), F.concat(F.lit(MSG_LINK_INVALID), link)),
        F.when(_missing(summary), F.lit(MSG_SUMMARY_MISSING))
         .when(strip_py(summary) == "", F.lit(MSG_SUMMARY_EMPTY)),
        F.when(_missing(source), F.lit(MSG_SOURCE_MISSING)),
        F.when(_missing(category), F.lit(MSG_CATEGORY_MISSING)),
    ]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def validate_articles(articles: DataFrame) -> DataFrame:
    """Adds ``errors: array<string>`` and ``is_valid``."""
    errs = validation_errors(F.col("title"), F.col("link"), F.col("summary"), F.col("source"),
                             F.col("category"))
    return (articles.withColumn("errors", errs)
            .withColumn("is_valid", F.size(F.col("errors")) == 0))


def split_valid_invalid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, error strings ``"{link}: e1, e2"``) from one validated frame."""
    valid = validated.filter(F.col("is_valid")).drop("errors", "is_valid")
    invalid = validated.filter(~F.col("is_valid")).select(
        F.concat(F.coalesce(F.col("link"), F.lit("None")), F.lit(": "),
                 F.array_join("errors", ", ")).alias("error"))
    return valid, invalid


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the NULLs in each column (one aggregate pass)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in columns])


def assert_not_null(df: DataFrame, columns: list[str]) -> None:
    """Raise before writing when any NOT NULL column holds a NULL."""
    bad = {c: n for c, n in null_counts(df, columns).first().asDict().items() if n}
    if bad:
        raise ValueError(f"NOT NULL constraint violated: {bad}")

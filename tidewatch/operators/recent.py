"""Time-window filters and recency top-k reads over the article table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.sources.bindings import effective_time, ts_lit


def cutoff(as_of: dt.datetime, days: int):
    return ts_lit(as_of - dt.timedelta(days=days))


def with_effective_time(articles: DataFrame) -> DataFrame:
    """Materialise ``coalesce(published, collected_at)``; stored physically it is pushable."""
    if "effective_time" in articles.columns:
        return articles
    return articles.withColumn("effective_time",
                               effective_time(F.col("published"), F.col("collected_at")))


def freshness_gate(df: DataFrame, as_of: dt.datetime, max_age_days: int | None,
                   col: str = "published") -> DataFrame:
    """Keep rows whose ``col`` is NULL or within ``max_age_days``; ``None`` disables the gate."""
    if max_age_days is None:
        return df
    return df.filter(F.col(col).isNull() | (F.col(col) >= cutoff(as_of, max_age_days)))


def collected_since(df: DataFrame, as_of: dt.datetime, days: int,
                    col: str = "collected_at") -> DataFrame:
    """``col >= as_of - days`` (inclusive)."""
    return df.filter(F.col(col) >= cutoff(as_of, days))


def recent_articles(articles: DataFrame, category: str, as_of: dt.datetime, days: int = 7,
                    limit: int = 200) -> DataFrame:
    """Category rows with effective time inside the window, newest first (ties by link).

    A row exactly at the cutoff is returned (``>=``).  NULL summaries read back as ''.
    """
    a = with_effective_time(articles)
    out = (a.filter((F.col("category") == category) & (F.col("effective_time") >= cutoff(as_of, days)))
           .withColumn("summary", F.coalesce(F.col("summary"), F.lit(""))))
    if limit <= 0:
        return out.limit(0)
    return out.orderBy(F.desc("effective_time"), F.asc("link")).limit(limit)


def recent_updates(articles: DataFrame, as_of: dt.datetime, days: int = 7,
                   limit: int = 20) -> DataFrame:
    """title, source, link, collected_at of rows collected inside the window, newest first."""
    out = collected_since(articles, as_of, days).select("title", "source", "link", "collected_at")
    if limit <= 0:
        return out.limit(0)
    return out.orderBy(F.desc("collected_at"), F.asc("link")).limit(limit)

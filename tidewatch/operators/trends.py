"""Entity trend aggregates: top trends and per-entity hit counts (rates and the heatmap
live in ``rollups``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import explode_rows
from tidewatch.sources.bindings import ts_lit


def since(col: str, as_of: dt.datetime, days: int) -> Column:
    """``col >= as_of - days`` (recency is inclusive)."""
    return F.col(col) >= ts_lit(as_of - dt.timedelta(days=days))


def entity_totals_from_map(df: DataFrame, col: str = "matched_entities") -> DataFrame:
    """Per entity: sum of the keyword-list lengths (NULL lists ignored, empty lists count 0)."""
    return (df.select(explode_rows(F.col(col)).alias("entity", "keywords"))
            .filter(F.col("entity").isNotNull() & F.col("keywords").isNotNull())
            .groupBy("entity").agg(F.sum(F.size("keywords")).cast("bigint").alias("hits")))


def entity_totals_from_hits(hits: DataFrame) -> DataFrame:
    """Long-form hits -> per entity hit count (partial aggregation before the shuffle)."""
    return hits.groupBy("entity").agg(F.count(F.lit(1)).cast("bigint").alias("hits"))


def top_k(totals: DataFrame, limit: int) -> DataFrame:
    """Hits DESC, ties by entity name; ``limit <= 0`` -> empty."""
    if limit <= 0:
        return totals.limit(0)
    return totals.orderBy(F.desc("hits"), F.asc("entity")).limit(limit)


def top_trends(articles: DataFrame, as_of: dt.datetime, days: int = 7, limit: int = 10,
               time_col: str = "collected_at", col: str = "matched_entities") -> DataFrame:
    """Top entities by keyword hits over rows with ``time_col >= as_of - days``."""
    recent = articles.filter(since(time_col, as_of, days))
    return top_k(entity_totals_from_map(recent, col), limit)

"""First-wins deduplication by link and the raw-log anti-join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_links(df: DataFrame, key: str = "link",
                order: tuple[str, ...] = ("source_ord", "item_ord")) -> DataFrame:
    """Keep the first row per ``key`` in (source_ord, item_ord) order.

    Expressed as ``min_by(row, order)`` per key with map-side partial aggregation, so a hot
    key collapses before the shuffle (a window would ship every duplicate).  The buffer holds
    rows of variable size, so Spark plans sort aggregates: each task sorts its rows by key.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    # remaining orderable columns break ties deterministically; maps cannot be ordered
    orderable = [f.name for f in df.schema.fields if f.name in rest and _orderable(f.dataType)]
    rank = F.struct(*[F.col(c) for c in (*order, *orderable)])
    packed = F.struct(*[F.col(c) for c in (*order, *rest)])
    return (df.groupBy(key).agg(F.min_by(packed, rank).alias("_first"))
            .select(key, *[F.col("_first")[c].alias(c) for c in (*order, *rest)]))


def _orderable(t) -> bool:
    from pyspark.sql import types as T
    if isinstance(t, T.MapType):
        return False
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return not isinstance(t, T.VariantType)


def raw_log_dedup(batch: DataFrame, logged: DataFrame, key: str = "link",
                  order: tuple[str, ...] = ("source_ord", "item_ord")) -> DataFrame:
    """Rows whose link is not yet logged, one per link (first in batch order)."""
    fresh = batch.join(logged.select(key), key, "left_anti")
    return dedup_links(fresh, key, order)

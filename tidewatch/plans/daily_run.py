"""One collection run for a category, as a sequence of Spark jobs.

landed payloads -> dispatch by source type -> first row per link (source order) ->
freshness gate -> raw log (before tagging) -> entity tagging -> validation -> merge into
the article table -> retention -> search documents + postings update -> recent window ->
run statistics -> storage policy.

The collected batch is checkpointed once (shared ``spark.checkpoint.dir``): the raw log,
tagging and statistics read it without recomputing ingest, and lineage stays short.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import dedup, entities, index_upkeep, recent, rollups, validate
from tidewatch.session import checkpoint_dir
from tidewatch.sinks import raw_log, store
from tidewatch.sources import ingest
from tidewatch.sources.config import Category, sources_frame


@dataclass(frozen=True)
class RunSettings:
    root: str                      # versioned article table
    raw_dir: str                   # raw JSON log
    index_dir: str                 # search index: segments of documents and postings
    snapshot_root: str
    recent_days: int = 7
    keep_days: int = 90
    keep_raw_days: int = 180
    max_age_days: int | None = None
    per_source_limit: int | None = None
    snapshot: bool = False


def run_category(spark: SparkSession, category: Category, payloads: DataFrame,
                 settings: RunSettings, as_of: dt.datetime) -> dict:
    """Run one collection for ``category`` from landed ``payloads``; returns what happened:
    run statistics (numbers), an ``errors`` DataFrame, retention count, the recent window
    DataFrame and the storage-policy result."""
    checkpoint_dir(spark)
    srcs = sources_frame(spark, category.sources)
    arts, source_errors = ingest.dispatch_by_type(
        srcs, payloads.withColumn("category", F.lit(category.category_name)), settings.per_source_limit)
    arts = dedup.dedup_links(arts)
    arts = recent.freshness_gate(arts, as_of, settings.max_age_days)
    arts = arts.checkpoint(eager=True)

    raw_log.write_raw_log(spark, arts, settings.raw_dir, as_of)
    tagged = entities.entity_match(arts, category.entities)
    checked = validate.validate_articles(tagged).checkpoint(eager=True)
    valid, invalid = validate.split_valid_invalid(checked)

    batch = valid.withColumn("batch_ord", F.col("source_ord") * F.lit(1 << 32) + F.col("item_ord"))
    store.upsert_articles(spark, settings.root, batch, as_of)
    removed = store.retain_articles(spark, settings.root, as_of, settings.keep_days)
    index_upkeep.update_index(spark, settings.index_dir, valid.select("link", "title", F.coalesce("summary", F.lit("")).alias("body")))

    stored = store.read_articles(spark, settings.root)
    window = recent.recent_articles(stored, category.category_name, as_of, settings.recent_days)
    stats = rollups.run_stats(checked, checked, settings.recent_days).first().asDict()
    stats["sources"] = len(category.sources)
    # error rows stay distributed (there may be as many as collected rows)
    errors = source_errors.select(F.col("message").alias("error")).unionByName(invalid)
    policy = store.storage_policy(spark, root=settings.root, raw_dir=settings.raw_dir,
                                  snapshot_root=settings.snapshot_root,
                                  keep_raw_days=settings.keep_raw_days, today=as_of.date(),
                                  snapshot=settings.snapshot)
    return {"stats": stats, "errors": errors, "removed": removed, "recent": window, "policy": policy}

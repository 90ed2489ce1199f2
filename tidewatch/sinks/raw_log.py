"""Raw JSON-lines log of collected rows, partitioned by log date and source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.entities_json import EMPTY_MAP
from tidewatch.operators.dedup import dedup_links

NO_RUN = "none"

RAW_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("published", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("matched_entities", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("logged_at", T.StringType()),
])


def safe_source(col):
    """'/' and '\\' in source names become '_' (they are path separators)."""
    return F.regexp_replace(col, r"[/\\]", "_")


def raw_records(batch: DataFrame, logged_at: dt.datetime, extra=()) -> DataFrame:
    """Batch rows -> log records (published as ISO text or NULL; entities default {})."""
    ents = (F.col("matched_entities") if "matched_entities" in batch.columns
            else F.create_map().cast(EMPTY_MAP))
    return batch.select(
        "title", "link", "summary",
        F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss").alias("published"),
        "source", "category",
        F.coalesce(ents, F.create_map().cast(EMPTY_MAP)).alias("matched_entities"),
        F.lit(logged_at.isoformat()).alias("logged_at"),
        F.lit(logged_at.date().isoformat()).alias("log_date"),
        safe_source(F.col("source")).alias("source_safe"), *extra)


def write_raw_log(spark: SparkSession, batch: DataFrame, raw_dir: str, logged_at: dt.datetime,
                  run_id: str | None = None, order=("source_ord", "item_ord")) -> DataFrame:
    """Append ``batch`` under ``raw_dir/log_date=.../source_safe=.../run_id=...``
    (``run_id=none`` when no run id is given).

    With ``run_id``, a link that the run has already logged for the same date and source (or
    that repeats inside the batch for its source) is skipped; the same link from another
    source, date or run is a record of its own.  Returns the records that were written.
    """
    keep = [c for c in order if c in batch.columns] if run_id is not None else []
    recs = raw_records(batch, logged_at, keep).withColumn("run_id", F.lit(run_id or NO_RUN))
    if run_id is not None:
        logged = read_raw_log(spark, raw_dir)
        if logged is not None and "run_id" in logged.columns:
            done = logged.filter((F.col("run_id") == run_id) & (F.col("log_date").cast("string") == logged_at.date().isoformat()))
            recs = recs.join(done.select("link", F.col("source_safe").cast("string")), ["link", "source_safe"], "left_anti")
        recs = recs.withColumn("_record", F.struct("link", "source_safe"))
        recs = dedup_links(recs, "_record", tuple(keep)) if keep else recs.dropDuplicates(["_record"])
        recs = recs.drop("_record", *keep)
    parts = ["log_date", "source_safe", "run_id"]
    # few files per folder; adaptive execution splits the partition of a hot source
    (recs.hint("rebalance", *[F.col(c) for c in parts]).write.mode("append").option("ignoreNullFields", "false")
     .partitionBy(*parts).json(raw_dir))
    return recs


def read_raw_log(spark: SparkSession, raw_dir: str) -> DataFrame | None:
    """Read the log; malformed lines land in ``_corrupt_record`` instead of stopping the read."""
    from tidewatch.sinks.store import exists
    if not exists(spark, raw_dir):
        return None
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(raw_dir))

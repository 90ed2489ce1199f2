"""Structured Streaming delivery of the batch operators.

The stateless operators (ingest, validation, entity matching) run unchanged on a
``readStream`` frame.  Stateful pieces use Spark's own state: link dedup holds each link's
best row in keyed state and gives it out by an event-time timer (``dedup_links_stream``: the
batch operator's survivor whatever the order of arrival; ``dedup_stream`` is the cheaper first
arrival), day counts are event-time windows with a watermark, and upserts run per micro-batch
through ``foreachBatch`` (idempotent: a replayed batch writes the same rows again).

Give ``checkpoint`` a stable path and a restarted stream goes on where it stopped; without
one, a fresh path under the session's shared ``spark.checkpoint.dir`` is taken and all files
are read.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators.recent import freshness_gate
from tidewatch.operators.rollups import UNDATED, day_of
from tidewatch.session import checkpoint_dir
from tidewatch.sinks import store


def stream_table(spark: SparkSession, directory: str, pattern: str = "*.parquet",
                 max_files: int | None = None) -> DataFrame:
    """Parquet files of a directory (matching ``pattern``) read as a stream; the schema is
    taken from the files already there.  ``pattern`` may name a folder in it, a table stored as
    many files: these are then the stream."""
    if store.is_dir(spark, f"{directory.rstrip('/')}/{pattern}"):
        directory, pattern = f"{directory.rstrip('/')}/{pattern}", "*"
    schema = spark.read.option("pathGlobFilter", pattern).parquet(directory).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(directory)


def windowed_counts(stream: DataFrame, time_col: str, keys: list[str], window: str = "1 day",
                    watermark: str = "1 day") -> DataFrame:
    """Event-time window counts per key, late rows bounded by the watermark."""
    t = stream.withColumn(time_col, F.col(time_col).cast("timestamp"))  # watermark needs TIMESTAMP
    return (t.withWatermark(time_col, watermark)
            .groupBy(F.window(time_col, window).alias("w"), *keys)
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
            .select(F.col("w.start").alias("window_start"), *keys, "n"))


def dedup_stream(stream: DataFrame, key: str, time_col: str, watermark: str) -> DataFrame:
    """First arrival per key within the watermark delay."""
    t = stream.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return t.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark([key])


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LinkSurvivor(StatefulProcessor):
    """Per link: the row that comes first in the given order, until the link's timer.

    ``order`` are positions in the row; the timer stands ``horizon_ms`` after the newest event
    time of the link's rows and moves with them.
    """

    def __init__(self, columns: list[str], order: list[int], time_at: int, horizon_ms: int, schema: T.StructType):
        self.columns, self.order, self.time_at, self.horizon_ms, self.schema = columns, order, time_at, horizon_ms, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", self.schema)
        self.due = handle.getValueState("due", "due long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.best.get() if self.best.exists() else None
        due = self.due.get()[0] if self.due.exists() else None
        newest = -1
        for batch in rows:
            for row in batch[self.columns].itertuples(index=False, name=None):
                row = tuple(None if v is pd.NaT or (not isinstance(v, (list, dict)) and pd.isna(v)) else v for v in row)
                newest = max(newest, pd.Timestamp(row[self.time_at]).value // 1_000_000)  # sessions are in UTC
                if held is None or self.rank(row) < self.rank(held):
                    held = row
        self.best.update(tuple(held))
        wanted = newest + self.horizon_ms
        if due is None or wanted > due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(wanted)
            self.due.update((wanted,))
        yield pd.DataFrame()

    def rank(self, row: tuple) -> tuple:
        """Nulls first, as in the batch operator's ascending order."""
        return tuple((row[i] is not None, row[i] if row[i] is not None else 0) for i in self.order)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        row = tuple(self.best.get())
        self.best.clear()
        self.due.clear()
        yield pd.DataFrame([row], columns=self.columns)

    def close(self) -> None:
        pass


def dedup_links_stream(stream: DataFrame, key: str = "link", time_col: str = "fetched_at",
                       order: tuple[str, ...] = ("source_ord", "item_ord"), horizon: str = "1 day") -> DataFrame:
    """One row per link, the first by ``order``, as the batch operator gives.

    A link's row is given out, and its state dropped, when the watermark (``horizon`` behind the
    newest event) has passed the link's newest event time by ``horizon``.  Rows of a link
    that are farther apart than that are links of their own.  Rows later than the watermark
    are dropped by Spark.  Rows without a time or a link are left out: nothing could time them.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = (stream.withColumn(time_col, F.col(time_col).cast("timestamp"))
            .filter(F.col(time_col).isNotNull() & F.col(key).isNotNull()).withWatermark(time_col, horizon))
    columns = rows.columns
    milliseconds = int(pd.Timedelta(horizon).total_seconds() * 1000)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    processor = LinkSurvivor(columns, [columns.index(c) for c in order], columns.index(time_col), milliseconds, schema)
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")


def _ckpt(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"


def run_available(stream: DataFrame, out_path: str, mode: str = "append",
                  name: str = "stream", checkpoint: str | None = None) -> str:
    """Process everything available now and stop; the result lands as parquet at ``out_path``.

    ``complete`` mode rewrites the whole result per micro-batch (small aggregates only);
    ``append`` mode appends finalized rows.
    """
    spark = stream.sparkSession
    ck = checkpoint or _ckpt(spark, name)
    if mode == "complete":
        def write(batch: DataFrame, _epoch: int) -> None:
            batch.write.mode("overwrite").parquet(out_path)
        q = (stream.writeStream.outputMode("complete").foreachBatch(write)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
    else:
        q = (stream.writeStream.outputMode("append").format("parquet")
             .option("path", out_path).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


def upsert_stream(stream_articles: DataFrame, root: str, collected_at: dt.datetime,
                  order: str = "batch_ord", name: str = "upsert", checkpoint: str | None = None) -> str:
    """Merge each micro-batch into the versioned article table."""
    spark = stream_articles.sparkSession

    def merge(batch: DataFrame, _epoch: int) -> None:
        store.upsert_articles(batch.sparkSession, root, batch, collected_at, order)

    q = (stream_articles.writeStream.foreachBatch(merge)
         .option("checkpointLocation", checkpoint or _ckpt(spark, name)).trigger(availableNow=True).start())
    q.awaitTermination()
    return root


def split_by_date(stream: DataFrame, out: str, time_col: str = "published", as_of: dt.datetime | None = None,
                  max_age_days: int | None = None, name: str = "by-day", checkpoint: str | None = None) -> str:
    """Two sinks under one checkpoint: counts per day of the dated rows, and the undated rows.

    With ``as_of`` and ``max_age_days`` rows pass the freshness gate first (undated rows always
    pass it).  Each micro-batch writes a folder of its own in both sinks, named by its id: a
    batch that is run again after a stop, even between the sinks, replaces what it wrote.
    """
    spark = stream.sparkSession
    gated = freshness_gate(stream, as_of, max_age_days, time_col) if as_of else stream

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write_dated(batch.filter(F.col(time_col).isNotNull()), batch_id)
            write_undated(batch.filter(F.col(time_col).isNull()), batch_id)
        finally:
            batch.unpersist()

    def write_dated(rows: DataFrame, batch_id: int) -> None:
        (rows.groupBy(day_of(F.col(time_col)).alias("day")).agg(F.count(F.lit(1)).cast("bigint").alias("articles"))
         .write.mode("overwrite").parquet(f"{out}/dated/batch={batch_id}"))

    def write_undated(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/undated/batch={batch_id}")

    q = (gated.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint or _ckpt(spark, name))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def read_by_day(spark: SparkSession, out: str) -> DataFrame:
    """``(day, articles)`` over all batches of ``split_by_date``, as the batch operator gives it."""
    dated = spark.read.schema("day string, articles bigint").parquet(f"{out}/dated").groupBy("day").agg(
        F.sum("articles").cast("bigint").alias("articles"))
    undated = spark.read.parquet(f"{out}/undated").agg(F.count(F.lit(1)).cast("bigint").alias("articles"))
    return dated.unionByName(undated.filter("articles > 0").select(F.lit(UNDATED).alias("day"), "articles"))

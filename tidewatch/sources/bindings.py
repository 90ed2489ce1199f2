"""Read the driver's parquet tables and bind them to the article model.

Bindings are pure projections of the scanned tables (no shuffle), so Catalyst prunes
the columns that a downstream operator does not read and pushes its filters to the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.text import collapse_spaces, first_line, host_of

# --- fixed values: binding parameters --------------------------------------------------
AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)          # fixed "now" for every oracle check
EPOCH = dt.datetime(2024, 1, 1, 0, 0, 0)           # base of synthetic collected times
PUBLISHED_EPOCH = dt.datetime(2023, 12, 2, 0, 0, 0)  # published = this + (doc_id * 89 mod 86400) min,
PUBLISHED_STRIDE, PUBLISHED_MINUTES_MOD = 89, 86400  # that is over the 60 days up to AS_OF
UNDATED_MOD = 10                                   # published NULL when doc_id mod 10 = 0
COLLECTED_DAYS_MOD = 30                            # collected_at = EPOCH + (doc_id mod 30) days
# what is no text of a page: scripts, styles, comments, tags
NOT_PAGE_TEXT = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>"
# ---------------------------------------------------------------------------------------

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_rows else df


# largest number of splits of a scan that is worth a shuffle for more tasks
SMALL_SCAN_SPLITS = 32


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows over all cores when a small scan yields fewer splits than cores.

    Text operators are CPU-bound per row; a table stored as one large row group would run
    on one core.  A scan of more than ``SMALL_SCAN_SPLITS`` splits is left as it is, however
    many cores there are: moving its rows would cost more than the idle cores.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # no RDD API (e.g. a remote session): leave the plan as it is
        return df
    if current < target and current <= SMALL_SCAN_SPLITS:
        return df.repartition(target)
    return df


def ts_lit(value: dt.datetime) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def effective_time(published: Column, collected_at: Column) -> Column:
    return F.coalesce(published, collected_at)


def articles_from_documents(docs: DataFrame) -> DataFrame:
    """documents -> canonical articles (see FIXTURES binding ``articles_from_documents``)."""
    epoch, first_published = ts_lit(EPOCH), ts_lit(PUBLISHED_EPOCH)
    doc_id = F.col("doc_id")
    published = F.when(doc_id % UNDATED_MOD == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        F.timestamp_add("MINUTE", doc_id * PUBLISHED_STRIDE % PUBLISHED_MINUTES_MOD, first_published))
    collected = F.timestamp_add("DAY", doc_id % COLLECTED_DAYS_MOD, epoch)
    return docs.select(
        doc_id.alias("doc_id"),
        first_line(F.col("text")).alias("title"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.col("lang"),
                 F.lit("/"), doc_id.cast("string")).alias("link"),
        F.col("text").alias("summary"),
        published.alias("published"),
        F.col("source").alias("source"),
        F.col("lang").alias("category"),
        collected.alias("collected_at"),
        doc_id.alias("item_ord"),
    )


def articles_from_pages(pages: DataFrame) -> DataFrame:
    """pages -> articles: title = text of <title>, summary = text of the page, link = url,
    source = host, category 'web'."""
    title = F.regexp_extract(F.col("html"), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return pages.select(
        F.col("page_id").alias("page_id"),
        title.alias("title"),
        F.col("url").alias("link"),
        collapse_spaces(F.regexp_replace("html", NOT_PAGE_TEXT, " ")).alias("summary"),
        F.lit(None).cast("timestamp_ntz").alias("published"),
        host_of(F.col("url"), F.lit("")).alias("source"),
        F.lit("web").alias("category"),
        F.col("page_id").alias("item_ord"),
    )


def document_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_from_documents(read_table(spark, sf_dir, "documents", spread_rows=True))


def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_from_pages(read_table(spark, sf_dir, "pages", spread_rows=True))

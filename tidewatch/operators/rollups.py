"""Report aggregates: daily summaries and what dashboards read from them, article
distributions, source health and error rollups.

All groupings here have small outputs (days x categories, sources, entities); partial
aggregation runs before every shuffle so a hot source or day costs one row per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.text import explode_rows
from tidewatch.session import checkpoint_dir
from tidewatch.sinks import store
from tidewatch.sources.bindings import ts_lit

# --- fixed values: report labels and freshness edges (days) ---------------------------------
UNDATED = "Undated"
FRESHNESS_EDGES = [(1, "0-1"), (3, "2-3"), (7, "4-7"), (30, "8-30")]
FRESHNESS_OLDEST = "31+"
TOP_TAGS = 3
MIN_TREND_POINTS = 3
# -------------------------------------------------------------------------------------------


def day_of(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def articles_by_day(articles: DataFrame, col: str = "published") -> DataFrame:
    """Article count per publication day, NULL dates under 'Undated'."""
    day = F.coalesce(day_of(F.col(col)), F.lit(UNDATED))
    return articles.groupBy(day.alias("day")).agg(F.count(F.lit(1)).cast("bigint").alias("articles"))


def source_counts(articles: DataFrame) -> DataFrame:
    return articles.groupBy("source").agg(F.count(F.lit(1)).cast("bigint").alias("articles"))


def freshness_buckets(articles: DataFrame, as_of: dt.datetime, col: str = "published") -> DataFrame:
    """Age distribution in days: 0-1, 2-3, 4-7, 8-30, 31+, Undated."""
    age = F.datediff(ts_lit(as_of).cast("date"), F.col(col).cast("date"))
    bucket = F.when(F.col(col).isNull(), F.lit(UNDATED))
    for edge, label in FRESHNESS_EDGES:
        bucket = bucket.when(age <= edge, F.lit(label))
    bucket = bucket.otherwise(F.lit(FRESHNESS_OLDEST))
    return articles.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).cast("bigint").alias("articles"))


def _article_and_entity_rows(me: Column) -> Column:
    """One 'article' row (entity NULL, matched flag) plus one row per matched entity."""
    article = F.struct(F.lit(None).cast("string").alias("entity"), F.lit(0).alias("kws"),
                       F.coalesce(F.size(me) > 0, F.lit(False)).alias("matched"))
    ents = F.transform(F.map_entries(F.coalesce(me, F.create_map().cast("map<string,array<string>>"))),
                       lambda e: F.struct(e["key"].alias("entity"), F.size(e["value"]).alias("kws"),
                                          F.lit(False).alias("matched")))
    return F.concat(F.array(article), ents)


def daily_summary(articles: DataFrame, day_col: str = "collected_at",
                  col: str = "matched_entities") -> DataFrame:
    """Per (date, category): article_count, source_count, matched_count, top_entities
    (array<struct<name, count>> by count DESC, name; count = keyword hits) and sources
    (map source -> articles).

    One pass over the articles (``summary_partials``), then ``finish_summary`` on its small
    result.  ``update_partials`` stores the partials by day and renews touched days only.
    """
    return finish_summary(summary_partials(articles, day_col, col))


def summary_partials(articles: DataFrame, day_col: str = "collected_at", col: str = "matched_entities") -> DataFrame:
    """``(date, category, source, entity, n, hits, m)``: each article explodes into one article
    row (entity NULL) plus one row per entity, aggregated once."""
    rows = (articles.select(day_of(F.col(day_col)).alias("date"), "category", "source",
                            explode_rows(_article_and_entity_rows(F.col(col))).alias("r"))
            .select("date", "category", "source", "r.*"))
    return rows.groupBy("date", "category", "source", "entity").agg(
        F.count(F.lit(1)).alias("n"), F.sum("kws").alias("hits"), F.count_if("matched").alias("m"))


def finish_summary(g: DataFrame) -> DataFrame:
    """Reports from partials: the counts per source and, added up per entity first, the
    entities; a report row holds one element per source and one per entity, no more."""
    is_art = F.col("entity").isNull()
    # per entity first; the row of entity NULL holds the articles.  One chain of groupings and no
    # join with itself, so the partials are made once
    per = g.groupBy("date", "category", "entity").agg(
        F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum("hits").alias("hits"), F.count(F.lit(1)).alias("rows"),
        F.collect_list(F.when(is_art, F.struct("source", F.col("n").cast("bigint").alias("n")))).alias("sources"))
    out = per.groupBy("date", "category").agg(
        F.sum(F.when(is_art, F.col("n"))).cast("bigint").alias("article_count"),
        F.coalesce(F.sum(F.when(is_art, F.col("rows"))), F.lit(0)).cast("bigint").alias("source_count"),
        F.sum(F.when(is_art, F.col("m"))).cast("bigint").alias("matched_count"),
        F.first(F.when(is_art, F.col("sources")), ignorenulls=True).alias("sources"),
        F.array_sort(F.collect_list(F.when(~is_art, F.struct(
            (-F.col("hits")).cast("bigint").alias("neg"), F.col("entity").alias("name"))))).alias("totals"))
    top = F.transform("totals", lambda t: F.struct(t["name"].alias("name"), (-t["neg"]).alias("count")))
    return out.withColumn("sources", F.map_from_entries(F.array_sort("sources"))).withColumn("top_entities", top).drop("totals")


PARTIALS_SCHEMA = "category string, source string, entity string, n bigint, hits bigint, m bigint, date string"


def update_partials(articles: DataFrame, root: str, days: list[str] | None = None, day_col: str = "collected_at",
                    col: str = "matched_entities") -> None:
    """Renew the stored partials of the given days (all, without) from ``articles``.

    One folder per day under ``root``.  Only rows of the given days are aggregated and only
    their folders are replaced; a day without rows loses its folder.  A row that moved to
    another day touches both.
    """
    spark = articles.sparkSession
    rows = articles if days is None else articles.filter(day_of(F.col(day_col)).isin(*days))
    (summary_partials(rows, day_col, col).repartition("date").sortWithinPartitions("date", "category")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(root))
    if days is not None:  # days whose rows are all gone are in no written folder
        left = {r[0] for r in rows.select(day_of(F.col(day_col))).distinct().collect()}  # at most the given days
        for day in set(days) - left:
            store.delete(spark, f"{root}/date={day}")


def read_partials(spark: SparkSession, root: str, days: list[str] | None = None) -> DataFrame:
    """The stored partials, of the given days if any; ``finish_summary`` makes the reports."""
    g = spark.read.schema(PARTIALS_SCHEMA).parquet(root)
    return g if days is None else g.filter(F.col("date").isin(*days))


def flatten_summary(summary: DataFrame) -> DataFrame:
    """Flat text form of the nested columns (for comparison and export)."""
    return summary.select(
        "date", "category", "article_count", "source_count", "matched_count",
        F.array_join(F.transform("top_entities", lambda e: F.concat(e["name"], F.lit(":"), e["count"].cast("string"))), "|").alias("top_entities"),
        F.array_join(F.transform(F.array_sort(F.map_entries("sources")), lambda e: F.concat(
            e["key"], F.lit(":"), e["value"].cast("string"))), "|").alias("sources"))


def portfolio_stats(summaries: DataFrame, decimals: int = 1) -> DataFrame:
    """Reports, total articles, latest match rate (last by date, category) and the
    unweighted mean match rate with empty reports counted as 0 (percent, 1 decimal)."""
    rate = F.coalesce(F.col("matched_count") / F.nullif(F.col("article_count"), F.lit(0)), F.lit(0.0))
    return summaries.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_reports"),
        F.sum("article_count").cast("bigint").alias("total_articles"),
        F.round(F.max_by(rate, F.struct("date", "category")) * 100, decimals).alias("latest_match_rate"),
        F.round(F.avg(rate) * 100, decimals).alias("avg_match_rate"))


def summary_trend(summaries: DataFrame, category: str) -> DataFrame:
    """Article count per date (ascending) with that date's top entity; < 3 points -> empty."""
    s = summaries.filter(F.col("category") == category).select(
        "date", "article_count", F.try_element_at("top_entities", F.lit(1))["name"].alias("top_entity"))
    checkpoint_dir(s.sparkSession)
    s = s.checkpoint(eager=True)  # a row per day, made once for the count and the rows
    n = s.select(F.count(F.lit(1))).scalar()
    return s.filter(n >= MIN_TREND_POINTS).orderBy("date")


def summary_top_tags(summaries: DataFrame, k: int = TOP_TAGS) -> DataFrame:
    return summaries.select("date", "category", F.slice("top_entities", 1, k).alias("top_tags"))


def summary_search(summaries: DataFrame, text: str) -> DataFrame:
    """Case-insensitive substring match over category, date and entity names."""
    hay = F.lower(F.concat_ws(" ", F.col("category"), F.col("date"),
                              F.array_join(F.transform("top_entities", lambda e: e["name"]), " ")))
    return summaries.filter(F.instr(hay, text.lower()) > 0)


def summary_stamp(stem: Column) -> Column:
    """Date of a dated report name: trailing YYYYMMDD, else the whole name when it is an ISO date."""
    tail = F.when(stem.rlike(r"[0-9]{8}$"), F.try_to_date(F.substring(stem, -8, 8), "yyyyMMdd"))
    iso = F.when(F.length(stem) == 10, F.try_to_date(stem, "yyyy-MM-dd"))
    return F.when(stem.rlike(r"[0-9]{8}$"), tail).otherwise(iso)


def retain_summaries(reports: DataFrame, keep_days: int, today: dt.date, stem_col: str = "stem") -> DataFrame:
    """Reports kept by the dated-report policy ('index' and undated names always kept)."""
    if keep_days < 0:
        return reports
    cutoff = F.lit(today - dt.timedelta(days=keep_days))
    stamp = summary_stamp(F.col(stem_col))
    return reports.filter((F.col(stem_col) == "index") | stamp.isNull() | (stamp >= cutoff))


def source_health(attempts: DataFrame, disable_after: int = 3) -> DataFrame:
    """Per source from (source, at, ok, delay): attempts, successes, success rate, last delay,
    trailing consecutive failures and whether the source is disabled.

    Two partial-aggregated passes (no per-source sort): the last success time per source is
    one row per source, joined back by key (Spark broadcasts it when its measured size is
    small; no unconditional hint, the number of sources is data).
    """
    last_ok = attempts.groupBy("source").agg(
        F.max(F.when(F.col("ok"), F.col("at"))).alias("last_ok"))
    a = attempts.join(last_ok, "source")
    trailing = F.count_if(~F.col("ok") & (F.col("last_ok").isNull() | (F.col("at") > F.col("last_ok"))))
    out = a.groupBy("source").agg(
        F.count(F.lit(1)).cast("bigint").alias("attempts"),
        F.count_if("ok").cast("bigint").alias("successes"),
        F.max_by("delay", F.struct("at", "delay")).alias("last_delay"),
        trailing.cast("bigint").alias("failure_streak"))
    return (out.withColumn("success_rate", F.round(F.col("successes") / F.col("attempts"), 6))
            .withColumn("disabled", F.col("failure_streak") >= disable_after))


def error_rollup(errors: DataFrame) -> DataFrame:
    """(source, kind, message) rows -> count per (kind, source)."""
    return errors.groupBy("kind", "source").agg(F.count(F.lit(1)).cast("bigint").alias("errors"))


def run_stats(articles: DataFrame, validated: DataFrame, window_days: int) -> DataFrame:
    """sources, collected, matched (over collected rows), validated, window_days; one pass."""
    m = F.coalesce(F.size("matched_entities") > 0, F.lit(False))
    return validated.agg(
        F.count_distinct("source").cast("bigint").alias("sources"),
        F.count(F.lit(1)).cast("bigint").alias("collected"),
        F.count_if(m).cast("bigint").alias("matched"),
        F.count_if("is_valid").cast("bigint").alias("validated"),
        F.lit(window_days).alias("window_days"))


def entity_heatmap(articles: DataFrame, col: str = "published", me: str = "matched_entities") -> DataFrame:
    """Entity x publication day keyword hits, long form (undated rows under 'Undated')."""
    day = F.coalesce(day_of(F.col(col)), F.lit(UNDATED))
    return (articles.select(day.alias("day"), explode_rows(me).alias("entity", "kws"))
            .filter(F.col("entity").isNotNull())
            .groupBy("entity", "day").agg(F.sum(F.size("kws")).cast("bigint").alias("hits")))


def entity_rate(articles: DataFrame, me: str = "matched_entities") -> DataFrame:
    """Share of articles having each entity (articles with the entity / all articles)."""
    total = articles.select(F.count(F.lit(1))).scalar()
    per = (articles.select(explode_rows(me).alias("entity", "kws")).filter(F.col("entity").isNotNull())
           .groupBy("entity").agg(F.count(F.lit(1)).cast("bigint").alias("articles")))
    return per.select("entity", "articles", F.round(F.col("articles") / total, 6).alias("rate"))


def read_summaries(spark, path: str, multiline: bool = True) -> DataFrame:
    """Daily summary JSON: one (pretty-printed) object per file, or JSON lines."""
    schema = ("date string, category string, article_count bigint, source_count bigint, "
              "matched_count bigint, top_entities array<struct<name:string,count:bigint>>, "
              "sources map<string,bigint>, generated_at string")
    return (spark.read.schema(schema).option("multiLine", multiline).json(path)
            .withColumn("file", F.input_file_name()))

"""Skew handling must not change results: salted per-source limit and hot-link dedup."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.operators.dedup import dedup_links
from tidewatch.sources.ingest import first_per_source


def test_salted_limit_equals_plain_window_on_hot_source(spark):
    # one source holds ~90% of the rows
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("cold"), (F.col("id") % 7).cast("string")))
        .otherwise(F.lit("hot")).alias("source_name"),
        ((F.col("id") * 7919) % 20011).alias("item_ord"), F.col("id").alias("payload"))
    for limit in (1, 30, 500):
        got = {tuple(r) for r in first_per_source(df, limit).collect()}
        w = Window.partitionBy("source_name").orderBy("item_ord")
        want = {tuple(r) for r in df.withColumn("rn", F.row_number().over(w))
                .filter(F.col("rn") <= limit).drop("rn").collect()}
        assert got == want


def test_dedup_hot_link_survivor(spark):
    rows = [("hot", s, i, f"v{s}-{i}") for s in range(5, 0, -1) for i in range(200)] + [("cold", 1, 1, "c")]
    df = spark.createDataFrame(rows, "link string, source_ord int, item_ord int, value string")
    got = {r["link"]: (r["source_ord"], r["item_ord"], r["value"]) for r in dedup_links(df).collect()}
    assert got == {"hot": (1, 0, "v1-0"), "cold": (1, 1, "c")}

"""Streaming delivery gives the batch answers."""

import os

from pyspark.sql import functions as F

from tidewatch.streaming import delivery as S
from conftest import SF_SMALL


def test_windowed_counts_equal_batch(spark, scratch):
    s = S.stream_table(spark, SF_SMALL, "events.parquet")
    out = S.run_available(S.windowed_counts(s, "ts", ["event_type"], "1 day", "1 day"),
                          os.path.join(scratch, "counts"), "complete", "t_counts")
    got = {(r["window_start"].date(), r["event_type"], r["n"]) for r in spark.read.parquet(out).collect()}
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    want = {(r["d"], r["event_type"], r["n"]) for r in
            ev.groupBy(F.to_date("ts").alias("d"), "event_type").agg(F.count("*").alias("n")).collect()}
    assert got == want


def test_dedup_stream_keeps_one_per_key(spark, scratch):
    s = S.stream_table(spark, SF_SMALL, "lineitem.parquet").select(
        F.col("l_orderkey").alias("link"), F.col("l_shipdate").alias("fetched_at"))
    out = S.run_available(S.dedup_stream(s, "link", "fetched_at", "3650 days"),
                          os.path.join(scratch, "dedup"), "append", "t_dedup")
    got = spark.read.parquet(out)
    assert got.count() == got.select("link").distinct().count() == \
        spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey").distinct().count()


def test_a_restart_reads_only_new_files(spark, scratch):
    from tidewatch.streaming import delivery

    def add(name, lo):
        spark.range(lo, lo + 3).coalesce(1).write.mode("append").parquet(f"{scratch}/in")

    for lo, total in ((0, 3), (10, 6)):
        add("x", lo)
        delivery.run_available(delivery.stream_table(spark, f"{scratch}/in"), f"{scratch}/out", checkpoint=f"{scratch}/ck")
        assert spark.read.parquet(f"{scratch}/out").count() == total


def test_survivors_equal_the_batch_operator_in_any_order_of_arrival(spark, scratch):
    """Copies of links in shuffled files; finished links leave the state."""
    import datetime as dt
    import random
    from tidewatch.operators.dedup import dedup_links
    schema = "link string, fetched_at timestamp, source_ord int, item_ord long, title string"
    start, rng = dt.datetime(2024, 1, 1), random.Random(5)
    rows = [(f"l{i % 12}", start + dt.timedelta(hours=rng.randrange(40)), rng.randrange(3), i, rng.choice([None, f"t{i}"])) for i in range(60)]
    rows += [("l3", None, 0, -1, "no time"), (None, start, 0, -1, "no link")]
    end = [("end", start + dt.timedelta(days=60), 0, 0, "end")]
    timed = spark.createDataFrame([r for r in rows if r[0] and r[1]], schema)
    want = sorted(map(str, dedup_links(timed.withColumn("fetched_at", F.col("fetched_at"))).select("link", "item_ord", "title").collect()))
    for k in range(2):
        rng.shuffle(rows)
        for part in (rows[:20], rows[20:45], rows[45:], end):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{scratch}/in{k}")
        s = S.stream_table(spark, f"{scratch}/in{k}", max_files=1)
        out = f"{scratch}/out{k}"
        query = (S.dedup_links_stream(s, horizon="3 days").writeStream.outputMode("append").format("parquet")
                 .option("path", out).option("checkpointLocation", f"{scratch}/ck{k}").trigger(availableNow=True).start())
        query.awaitTermination()
        got = sorted(map(str, spark.read.parquet(out).select("link", "item_ord", "title").collect()))
        assert got == want
        held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        assert max(held) > 12 and held[-1] < max(held) / 4, held  # only the last row's link is left


def test_dated_and_undated_rows_survive_a_stop_between_the_sinks(spark, scratch, monkeypatch):
    """The stream stops after the dated sink of the second batch, is started again, and gives the batch answer."""
    import datetime as dt
    import pytest
    from pyspark.sql import DataFrameWriter
    from tidewatch.operators.recent import freshness_gate
    from tidewatch.operators.rollups import articles_by_day
    start = dt.datetime(2024, 1, 10)
    rows = [(f"l{i}", None if i % 4 == 0 else start - dt.timedelta(days=i % 9)) for i in range(90)]
    for lo in (0, 30, 60):
        spark.createDataFrame(rows[lo:lo + 30], "link string, published timestamp_ntz").coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    plain = DataFrameWriter.parquet

    def stopping(self, path, *a, **k):
        if path.endswith("undated/batch=1"):
            raise OSError("stopped here")
        return plain(self, path, *a, **k)

    def run():
        s = S.stream_table(spark, f"{scratch}/in", max_files=1)
        return S.split_by_date(s, f"{scratch}/out", as_of=start, max_age_days=5, checkpoint=f"{scratch}/ck")

    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", stopping)
        with pytest.raises(Exception, match="stopped here"):
            run()
    assert os.path.isdir(f"{scratch}/out/dated/batch=1") and not os.path.isdir(f"{scratch}/out/undated/batch=1")
    got = {tuple(r) for r in S.read_by_day(spark, run()).collect()}
    batch = spark.read.parquet(f"{scratch}/in")
    want = {tuple(r) for r in articles_by_day(freshness_gate(batch, start, 5)).collect()}
    assert got == want and any(day == "Undated" for day, _ in want)
    assert sorted(os.listdir(f"{scratch}/out/dated")) == ["batch=0", "batch=1", "batch=2"]


def test_a_table_of_many_files_is_streamed_as_one_file_is(spark, scratch):
    """Documents and conversations as folders of files, no conversation 0; the batch answers."""
    from tidewatch.plans import catalog
    docs = [(i, f"line {i}\nthe text", f"s{i % 3}", ("en", "fr")[i % 2], 9) for i in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, n_chars int").repartition(3) \
        .write.parquet(f"{scratch}/documents.parquet")
    turns = [(c, t, "user", f"{c} {t}") for c in range(3, 9) for t in range(4)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").repartition(3) \
        .write.parquet(f"{scratch}/conversations.parquet")
    by_day = {tuple(r) for r in catalog.QUERIES["stream_articles_by_day"](spark, scratch).collect()}
    assert by_day == {tuple(r) for r in catalog.QUERIES["articles_by_day"](spark, scratch).collect()}
    assert {tuple(r) for r in catalog.QUERIES["stream_upsert"](spark, scratch).collect()} == {("en", 20, 20), ("fr", 20, 20)}
    first = {c: min((t for t in range(4)), key=lambda t: t * 7 % catalog.TURN_SOURCES) for c in range(3, 9)}
    got = {tuple(r) for r in catalog.QUERIES["stream_dedup_survivors"](spark, scratch).collect()}
    assert got == {(c, t, f"{c} {t}") for c, t in first.items()}

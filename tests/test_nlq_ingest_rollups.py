"""Query parsing, payload ingest, report rollups, streaming delivery, entry contract."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import nlq
from tidewatch.operators import rollups as R
from tidewatch.sources import ingest as ING
from conftest import SF_SMALL

QUERIES = ["harbour tides last 4 days top 6", "blast 3 days last 5 weeks reefs", "top 12 lagoon", "지난 2 주 등대 7개",
           "최근11일 항구", "등대 3 개월 최근 2개월", "LAST 1 Month TOP 9", "top12 last 3 dayss", "9개입", "\u00a0 sea  wall ",
           "top 3 top 4 last 2 days last 9 days", "x" * 5000 + " last 2 days", ""]


@pytest.mark.parametrize("q,days,limit,text", [
    ("harbour tides last 4 days top 6", 4, 6, "harbour tides"), ("지난 2 주 등대 7개", 14, 7, "등대"),
    ("blast 3 days last 5 weeks reefs", 35, None, "blast 3 days reefs"), ("9개입", None, None, "9개입"),
    ("top 3 top 4 last 2 days last 9 days", 2, 3, "top 4 last 9 days"), ("LAST 1 Month TOP 9", 30, 9, "")])
def test_parse_query_cases(q, days, limit, text):
    p = nlq.parse_query(q)
    assert (p.days, p.limit, p.search_text, p.category) == (days, limit, text, None)


def test_column_parser_equals_driver_parser(spark):
    df = spark.createDataFrame([(q,) for q in QUERIES], "q string")
    parsed = df.select(nlq.nl_parse(F.col("q")).alias("p")).select("p.search_text", "p.days", "p.limit")
    want = [(p.search_text, p.days, p.limit) for p in map(nlq.parse_query, QUERIES)]
    assert [tuple(r) for r in parsed.collect()] == want
    assert len(parsed._jdf.queryExecution().optimizedPlan().toString()) < 100_000


def landed(spark, rows):
    return spark.createDataFrame(rows, "source_name string, category string, source_ord int, item_ord bigint, payload string")


def payloads(spark, name, *texts):
    return landed(spark, [(name, "coast", 0, i, t) for i, t in enumerate(texts)])


def test_met_objects_skips_and_errors(spark):
    boat = {"objectID": 31, "title": " Model boat ", "artistDisplayName": "Workshop of Ana Prado", "objectDate": "1911",
            "medium": "Cedar", "objectURL": "https://objects.example/31", "metadataDate": "2021-05-06T07:08:09Z"}
    given = payloads(spark, "Boats", json.dumps(boat), "[]", json.dumps({"objectID": 8}), "{broken", None)
    arts, skipped = ING.ingest_met(given)
    rows = {r["item_ord"]: r for r in arts.collect()}
    assert set(rows) == {0, 2}
    assert (rows[0]["title"], rows[0]["summary"]) == ("Model boat", "Workshop of Ana Prado. 1911. Cedar")
    assert rows[0]["published"] == dt.datetime(2021, 5, 6, 7, 8, 9)
    assert (rows[2]["title"], rows[2]["summary"], rows[2]["link"]) == (ING.UNTITLED, ING.UNKNOWN_ARTIST, ING.MET_LINK + "8")
    assert skipped.first()["skipped"] == 1
    assert [r["source"] for r in ING.parse_errors(ING.parse_met(given)).collect()] == ["Boats"] * 2


def test_aic_lists_limits_and_errors(spark):
    data = {"data": [{"id": 61, "title": "Quay at dusk", "artist_display": "L. Moreau", "date_display": "1902",
                      "medium_display": "Etching"}, {"id": 62, "title": ""}, {"id": 63, "title": "Third"}]}
    given = payloads(spark, "Prints", json.dumps(data), '{"data": []}', "{")
    assert [r["link"] for r in ING.ingest_aic(given, 1).collect()] == [ING.AIC_LINK + "61"]
    arts = ING.ingest_aic(given).collect()
    assert [r["title"] for r in arts] == ["Quay at dusk", ING.UNTITLED, "Third"] and arts[0]["summary"] == "L. Moreau. 1902. Etching"
    outcomes = sorted(r["outcome"] for r in ING.parse_aic(given).collect())
    assert outcomes == ["article"] * 3 + ["error", "skipped"]


def test_smithsonian_rows(spark):
    row = {"id": "s-9", "title": "Buoy", "timestamp": "1700000000", "content": {
        "descriptiveNonRepeating": {"record_link": "https://records.example/9", "data_source": "Harbour Museum"},
        "freetext": {"notes": [{"label": "Size", "content": "2 m"}, {"label": "Description", "content": "Painted red."}]}}}
    given = payloads(spark, "Coast", json.dumps({"response": {"rows": [row, {"id": "s-10"}]}}), "no json")
    first, second = ING.ingest_smithsonian(given).orderBy("item_ord").collect()
    assert (first["source"], first["summary"], first["link"]) == ("Harbour Museum", "Painted red.", "https://records.example/9")
    assert first["published"] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert (second["source"], second["link"], second["summary"]) == ("Coast", ING.SI_LINK + "s-10", ING.NO_DESCRIPTION)
    assert ING.parse_errors(ING.parse_smithsonian(given)).count() == 1


FEED = [
    "<item><title>Tides &amp;amp; reefs</title><link> https://sea.example/1 </link><description>low &amp;lt; high</description>"
    "<pubDate>Mon, 06 May 2024 10:00:00 +0200</pubDate></item>",
    '<entry><title type="html">Lamps</title><link rel="self" href="https://sea.example/self"/>'
    '<link rel="alternate" href="https://sea.example/2"/><summary>short</summary><updated>2024-05-06T08:00:00Z</updated></entry>',
    "<item><title>Long</title><link>https://sea.example/3</link><content:encoded>&lt;p&gt;whole&lt;/p&gt;</content:encoded>"
    "<dc:date>2024-05-06T08:00:00Z</dc:date></item>",
    "<item><title> </title><link>https://sea.example/4</link></item>",
    "<item><title>cut",
    None,
]


def test_feeds_rss_atom_and_errors(spark):
    given = payloads(spark, "Feed", *FEED)
    rows = ING.ingest_rss(given).orderBy("item_ord").collect()
    assert [(r["title"], r["link"], r["summary"]) for r in rows] == [
        ("Tides & reefs", "https://sea.example/1", "low < high"), ("Lamps", "https://sea.example/2", "short"),
        ("Long", "https://sea.example/3", "<p>whole</p>")]
    assert {r["published"] for r in rows} == {dt.datetime(2024, 5, 6, 8, 0, 0)}
    assert [r["message"] for r in ING.parse_errors(ING.parse_rss(given)).collect()] == ["Feed: malformed feed item"] * 2
    assert ING.parse_rss(given).count() == len(FEED)
    assert [r["title"] for r in ING.ingest_rss(given, 1).collect()] == ["Tides & reefs"]


def test_dispatch_loses_no_payload(spark):
    src = spark.createDataFrame([("Old page", "html", "u", 0), ("Feed", "RSS", "u", 1), ("Shot", "browser", "u", 2)],
                                "name string, type string, url string, source_ord int")
    pay = landed(spark, [("Feed", "c", 9, 0, FEED[1]), ("Feed", "c", 9, 1, "<item"), ("Shot", "c", 9, 0, "x"),
                         ("Nowhere", "c", 9, 0, "x"), ("Old page", "c", 9, 0, "x")])
    arts, errs = ING.dispatch_by_type(src, pay)
    assert [(r["link"], r["source_ord"]) for r in arts.collect()] == [("https://sea.example/2", 1)]
    assert sorted((r["source"], r["kind"]) for r in errs.collect()) == [
        ("Feed", "parse"), ("Nowhere", "route"), ("Old page", "route"), ("Old page", "source"), ("Shot", "route")]


def test_articles_by_day_undated(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 3, 10, 1),), (None,)], "published timestamp_ntz")
    assert {tuple(r) for r in R.articles_by_day(df).collect()} == {("2026-03-10", 1), ("Undated", 1)}


REPORTS = os.environ.get("TIDEWATCH_SUMMARIES_DIR", "")


@pytest.mark.skipif(not REPORTS or not os.path.isdir(REPORTS), reason="set TIDEWATCH_SUMMARIES_DIR")
def test_portfolio_stats_reproduce_published_dashboard(spark):
    """Published daily summaries dated up to 2026-03-31 -> 32 reports, 2,723 articles,
    85.0 % latest and 56.4 % mean match rate (the dashboard's numbers)."""
    s = R.read_summaries(spark, REPORTS + "/*_summary.json").filter(F.col("date") <= "2026-03-31")
    r = R.portfolio_stats(s).first()
    assert (r["total_reports"], r["total_articles"], r["latest_match_rate"], r["avg_match_rate"]) == (32, 2723, 85.0, 56.4)


def test_daily_summary_roundtrip_json(spark, scratch):
    from tidewatch.operators import entities as ent
    from tidewatch.plans.catalog import DEMO_ENTITIES
    from tidewatch.sources import bindings as B
    s = R.daily_summary(ent.entity_match(B.document_articles(spark, SF_SMALL), DEMO_ENTITIES))
    s.withColumn("generated_at", F.lit("2024-01-31T00:00:00+00:00")).coalesce(1).write.json(scratch + "/s")
    back = R.read_summaries(spark, scratch + "/s/*.json", multiline=False)
    assert back.count() == s.count()
    row = back.orderBy("date", "category").first()
    assert sum(row["sources"].values()) == row["article_count"] and len(row["sources"]) == row["source_count"]
    counts = [e["count"] for e in row["top_entities"]]
    assert counts == sorted(counts, reverse=True)


def test_entry_contract(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() >= 0 and "entity" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stored_partials_renew_touched_days_only(spark, scratch):
    import datetime as dt
    import os
    from tidewatch.operators import rollups
    day = dt.datetime(2024, 3, 1, 8)
    rows = [(f"c{i % 2}", f"s{i % 3}", day + dt.timedelta(days=i % 4), {"e": ["k"] * (i % 3)} if i % 3 else None) for i in range(40)]
    schema = "category string, source string, collected_at timestamp_ntz, matched_entities map<string,array<string>>"
    root = f"{scratch}/partials"
    rollups.update_partials(spark.createDataFrame(rows, schema), root)
    def files():
        return {os.path.join(d, f): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(root) for f in fs
                if f.endswith(".parquet")}
    before = files()
    # rows of the first day move to a new one, one row of the second day changes
    rows = [(c, s, day + dt.timedelta(days=9) if t == day else t, e) for c, s, t, e in rows]
    rows[1] = (rows[1][0], "other", rows[1][2], {"x": ["k"]})
    moved = spark.createDataFrame(rows, schema)
    rollups.update_partials(moved, root, ["2024-03-01", "2024-03-02", "2024-03-10"])
    after = files()
    same = {p for p in before if "2024-03-03" in p or "2024-03-04" in p}
    assert same and all(after[p] == before[p] for p in same)
    assert sorted(d for d in os.listdir(root) if d.startswith("date=")) == [f"date=2024-03-{d}" for d in ("02", "03", "04", "10")]
    def shown(summary):
        return sorted(map(str, map(tuple, rollups.flatten_summary(summary).collect())))
    full = rollups.daily_summary(moved)
    assert shown(rollups.finish_summary(rollups.read_partials(spark, root))) == shown(full)
    assert shown(rollups.finish_summary(rollups.read_partials(spark, root, ["2024-03-10"]))) == shown(full.filter("date = '2024-03-10'"))


def test_summary_reads_its_articles_once(spark):
    """Reports and trend by hand; the partials are not made again for the entities or the count."""
    import datetime as dt
    from tidewatch.operators import rollups
    rows = [(f"l{d}{i}", "en" if i < 4 else None, f"s{i % 2}", dt.datetime(2024, 1, d), {"A": ["x"], "B": ["y", "z"]} if i % 2 else {})
            for d in (1, 2, 3) for i in range(5)]
    arts = spark.createDataFrame(rows, "link string, category string, source string, collected_at timestamp_ntz, "
                                       "matched_entities map<string,array<string>>")
    s = rollups.daily_summary(arts)
    got = {(r.date, r.category): (r.article_count, r.source_count, r.matched_count, r.sources, [tuple(t) for t in r.top_entities])
           for r in s.collect()}
    assert got == {(f"2024-01-0{d}", c): v for d in (1, 2, 3) for c, v in (
        ("en", (4, 2, 2, {"s0": 2, "s1": 2}, [("B", 4), ("A", 2)])), (None, (1, 1, 0, {"s0": 1}, [])))}
    assert s._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    trend = rollups.summary_trend(s, "en")
    assert [tuple(r) for r in trend.collect()] == [(f"2024-01-0{d}", 4, "B") for d in (1, 2, 3)]
    assert rollups.summary_trend(rollups.daily_summary(arts.filter("day(collected_at) < 3")), "en").count() == 0

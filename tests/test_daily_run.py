"""End-to-end category run: payloads in -> table, raw log, search index, report inputs out."""

import datetime as dt
import os

from tidewatch.operators import index_upkeep, search
from tidewatch.plans.daily_run import RunSettings, run_category
from tidewatch.sinks import store
from tidewatch.sources.config import Category

NOW = dt.datetime(2024, 5, 8, 6, 0, 0)

ITEMS = [
    ("Harbour feed", 0, "<item><title>New lamp for the lighthouse</title><link>https://harbour.example/lamp</link>"
                        "<description>The keeper tested lamp and foghorn.</description>"
                        "<pubDate>Mon, 06 May 2024 10:00:00 GMT</pubDate></item>"),
    ("Harbour feed", 1, "<item><title> </title><link>https://harbour.example/blank</link></item>"),
    ("Harbour feed", 2, "<item><title>Lamp again</title><link>https://harbour.example/lamp</link></item>"),
    ("Harbour feed", 3, "<item><title>cut off"),
    ("Boat museum", 0, '{"objectID": 31, "title": "Model boat", "artistDisplayName": "Ana Prado"}'),
]


def test_run_category_end_to_end(spark, scratch):
    cat = Category.of({"category_name": "coast", "sources": [
        {"name": "Harbour feed", "type": "rss", "url": "https://harbour.example/feed"},
        {"name": "Boat museum", "type": "met_museum", "url": "https://boats.example/objects"},
        {"name": "Old board", "type": "html", "url": "https://board.example"}],
        "entities": [{"name": "signal", "keywords": ["lamp", "foghorn", "lighthouse"]}]}, "coast")
    payloads = spark.createDataFrame([(s, "x", i, p) for s, i, p in ITEMS],
                                     "source_name string, category string, item_ord bigint, payload string")
    st = RunSettings(root=os.path.join(scratch, "articles"), raw_dir=os.path.join(scratch, "raw"),
                     index_dir=os.path.join(scratch, "index"), snapshot_root=os.path.join(scratch, "snap"),
                     snapshot=True)
    out = run_category(spark, cat, payloads, st, NOW)
    assert out["stats"] == {"sources": 3, "collected": 2, "matched": 1, "validated": 2, "window_days": 7}
    assert sorted(r["error"] for r in out["errors"].collect()) == [
        "Harbour feed: malformed feed item", "Old board: Unsupported source type 'html'"]
    rows = {r["link"]: r for r in store.read_articles(spark, st.root).collect()}
    lamp = rows["https://harbour.example/lamp"]
    assert lamp["title"] == "New lamp for the lighthouse"   # the first row of a link wins
    assert dict(lamp["matched_entities"]) == {"signal": ["lamp", "foghorn", "lighthouse"]}
    # undated rows fall back to the collection time, so both stored rows are recent
    assert {r["link"] for r in out["recent"].collect()} == set(rows)
    assert len(rows) == 2
    assert os.path.isdir(os.path.join(st.raw_dir, f"log_date={NOW:%Y-%m-%d}"))
    assert out["policy"]["snapshot_path"].endswith(f"snapshot_date={NOW:%Y-%m-%d}")
    hits, _, _ = index_upkeep.read_segments(spark, index_upkeep.read_manifest(spark, st.index_dir))
    assert set(search.query_terms("boat")) <= {r["term"] for r in hits.select("term").collect()}
    # a second run re-indexes only the touched documents
    out2 = run_category(spark, cat, payloads, st, NOW + dt.timedelta(days=1))
    assert out2["stats"]["collected"] == 2
    index = index_upkeep.read_manifest(spark, st.index_dir)
    assert len(index.segments) == 2 and index.n_docs == 2

"""Versioned store: upsert by link, atomic rejection, retention, snapshots, raw log, date policies."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import recent
from tidewatch.operators.rollups import retain_summaries
from tidewatch.sinks import raw_log, store

NOW = dt.datetime(2026, 3, 13, 12, 0, 0)
SCHEMA = ("title string, link string, summary string, published timestamp_ntz, source string, "
          "category string, matched_entities map<string,array<string>>, batch_ord int")


def batch(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA)


def art(title, link, summary="s", published=None, source="Example RSS", category="tech", ents=None):
    return (title, link, summary, published, source, category, ents or {})


def test_upsert_overwrites_by_link(spark, scratch):
    root = os.path.join(scratch, "articles")
    store.upsert_articles(spark, root, batch(spark, [art("First", "https://e.com/1", "one", source="A", category="c1")]), NOW)
    store.upsert_articles(spark, root, batch(spark, [art("Second", "https://e.com/1", "two", source="B", category="c2")]),
                          NOW + dt.timedelta(hours=1))
    rows = store.read_articles(spark, root).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["title"], r["summary"], r["source"], r["category"]) == ("Second", "two", "A", "c1")
    assert r["collected_at"] == NOW + dt.timedelta(hours=1)


def test_within_batch_first_and_last_win(spark, scratch):
    root = os.path.join(scratch, "articles")
    store.upsert_articles(spark, root, batch(spark, [
        art("v1", "https://e.com/1", source="S1", published=NOW), art("v2", "https://e.com/1", source="S2")]), NOW)
    r = store.read_articles(spark, root).first()
    assert (r["title"], r["source"], r["published"]) == ("v2", "S1", None)


def test_bad_row_rejects_whole_batch(spark, scratch):
    root = os.path.join(scratch, "articles")
    store.upsert_articles(spark, root, batch(spark, [art("ok", "https://e.com/0")]), NOW)
    with pytest.raises(ValueError):
        store.upsert_articles(spark, root, batch(spark, [art("ok", "https://e.com/1"), art("bad", None)]), NOW)
    assert [r["link"] for r in store.read_articles(spark, root).collect()] == ["https://e.com/0"]


def test_batch_of_100_and_empty(spark, scratch):
    root = os.path.join(scratch, "articles")
    store.upsert_articles(spark, root, batch(spark, [art(f"t{i}", f"https://e.com/{i}") for i in range(100)]), NOW)
    assert store.read_articles(spark, root).count() == 100
    assert store.upsert_articles(spark, root, batch(spark, []), NOW) is None
    assert len(store.versions(spark, root)) == 1


def test_a_batch_is_computed_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    def look(title):
        seen.add(1)
        return title

    rows = batch(spark, [art(f"t{i}", f"https://e.com/{i}") for i in range(20)])
    store.upsert_articles(spark, os.path.join(scratch, "articles"), rows.withColumn("title", F.udf(look, "string")("title")), NOW)
    assert seen.value == 20


def test_recent_and_retention(spark, scratch):
    root = os.path.join(scratch, "articles")
    rows = [art("new", "https://e.com/new", published=NOW - dt.timedelta(days=1), category="tech"),
            art("old", "https://e.com/old", published=NOW - dt.timedelta(days=20), category="tech"),
            art("other", "https://e.com/other", published=NOW - dt.timedelta(days=1), category="art"),
            art("edge", "https://e.com/edge", published=NOW - dt.timedelta(days=7), category="tech")]
    store.upsert_articles(spark, root, batch(spark, rows), NOW)
    a = store.read_articles(spark, root)
    got = [r["link"] for r in recent.recent_articles(a, "tech", NOW, 7).collect()]
    assert got == ["https://e.com/new", "https://e.com/edge"]          # cutoff row kept (>=)
    assert store.retain_articles(spark, root, NOW, 7) == 1             # strict <: 'edge' kept
    assert store.retain_articles(spark, root, NOW, 7) == 0
    assert {r["link"] for r in store.read_articles(spark, root).collect()} == {
        "https://e.com/new", "https://e.com/other", "https://e.com/edge"}


def test_recent_pushes_filter_to_scan(spark, scratch):
    root = os.path.join(scratch, "articles")
    store.upsert_articles(spark, root, batch(spark, [art("x", "https://e.com/x", published=NOW)]), NOW)
    plan = recent.recent_articles(store.read_articles(spark, root), "tech", NOW, 7) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "effective_time" in plan and "PushedFilters" in plan and "PartitionFilters" in plan


def test_snapshot(spark, scratch):
    root = os.path.join(scratch, "articles")
    snaps = os.path.join(scratch, "snapshots")
    assert store.snapshot_articles(spark, root, snaps, dt.date(2026, 3, 13)) is None
    store.upsert_articles(spark, root, batch(spark, [art("x", "https://e.com/x")]), NOW)
    before = files_under(root)
    path = store.snapshot_articles(spark, root, snaps, dt.date(2026, 3, 13))
    assert path.endswith("snapshot_date=2026-03-13") and os.path.isdir(path)
    assert data_files(files_under(root)) == data_files(before) and data_files(files_under(snaps)) == {}
    store.upsert_articles(spark, root, batch(spark, [art("y", "https://e.com/x")]), NOW)
    store.upsert_articles(spark, root, batch(spark, [art("z", "https://e.com/x")]), NOW)
    assert store.prune_versions(spark, root, keep=1) == 2
    assert [r["title"] for r in store.read_snapshot(spark, path).collect()] == ["x"]
    assert [r["title"] for r in store.read_articles(spark, root).collect()] == ["z"]
    assert len(data_files(files_under(root))) == 2  # the newest version's and the snapshot's
    store.snapshot_articles(spark, root, snaps, dt.date(2026, 3, 13))  # the same day again replaces it
    assert [r["title"] for r in store.read_snapshot(spark, path).collect()] == ["z"]
    store.prune_versions(spark, root, keep=1)
    assert len(data_files(files_under(root))) == 1


def files_under(root):
    return {os.path.join(d, f): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(root) for f in fs}


def data_files(files):
    return {p: c for p, c in files.items() if p.endswith(".parquet")}


def many(spark, n=200, **more):
    return batch(spark, [art(f"t{i}", f"https://e.com/{i}", published=NOW - dt.timedelta(days=i % 5), category=f"c {i % 2}/é", **more)
                         for i in range(n)])


def test_one_row_leaves_all_other_files_as_they_are(spark, scratch):
    root = os.path.join(scratch, "articles")
    store.upsert_articles(spark, root, many(spark), NOW, buckets=8)
    before = data_files(files_under(root))
    version = store.read_version(spark, root)
    store.upsert_articles(spark, root, batch(spark, [art("new", "https://e.com/7", source="other")]), NOW)
    after = data_files(files_under(root))
    assert all(after[p] == c for p, c in before.items())  # old files stay for the old version
    now = store.read_version(spark, root)
    assert len(set(version.files) - set(now.files)) == 1  # one file was replaced
    assert now.rows == store.read_articles(spark, root).count() == 200
    row = store.read_articles(spark, root).filter("link = 'https://e.com/7'").first()
    assert (row["title"], row["source"], row["category"]) == ("new", "Example RSS", "c 1/é")


def test_of_two_writers_one_wins_and_the_other_merges_again(spark, scratch, monkeypatch):
    root = os.path.join(scratch, "articles")
    store.upsert_articles(spark, root, many(spark, 20), NOW)
    base = store.read_version(spark, root)
    first = store.commit(spark, base._replace(number=2))
    with pytest.raises(store.VersionConflict):
        store.commit(spark, base._replace(number=2, files=()))
    assert store.read_version(spark, root) == first
    # a writer that read version 1 finds 2 taken, and works on 2
    real, stale = store.read_version, [base]
    monkeypatch.setattr(store, "read_version", lambda *a: stale.pop() if stale else real(*a))
    done = store.upsert_articles(spark, root, batch(spark, [art("late", "https://e.com/3")]), NOW)
    assert done.number == 3 and store.read_articles(spark, root).count() == 20
    assert not [p for p in files_under(root) if "/_manifests/." in p and not p.endswith(".crc")]


def test_retention_reads_the_boundary_day_only(spark, scratch):
    root = os.path.join(scratch, "articles")
    store.upsert_articles(spark, root, many(spark), NOW)
    version = store.read_version(spark, root)
    for f in version.files:  # a file that is read now would fail
        if f.day != (NOW - dt.timedelta(days=2)).date().isoformat():
            with open(os.path.join(root, f.path), "wb") as out:
                out.write(b"")
    assert store.retain_articles(spark, root, NOW + dt.timedelta(hours=1), 2) == 120
    left = store.read_version(spark, root)
    assert left.rows == 80 and set(left.files) < set(version.files)


def test_many_small_batches_join_their_files(spark, scratch):
    root = os.path.join(scratch, "articles")
    for i in range(store.MAX_FILES + 2):
        store.upsert_articles(spark, root, batch(spark, [art(f"t{i}", f"https://e.com/{i}", published=NOW)]), NOW, buckets=1)
    version = store.read_version(spark, root)
    assert version.rows == store.MAX_FILES + 2 and len(version.files) <= 3


def test_random_batches_equal_a_dictionary(spark, scratch):
    import random
    rng, root, table = random.Random(3), os.path.join(scratch, "articles"), {}
    for k in range(4):
        rows = [art(f"{k}.{j}", f"https://e.com/{rng.randrange(60)}", source=f"s{rng.randrange(4)}", category=f"c{rng.randrange(3)}",
                    published=rng.choice([None, NOW - dt.timedelta(days=rng.randrange(4))])) for j in range(40)]
        store.upsert_articles(spark, root, batch(spark, rows), NOW + dt.timedelta(days=k), buckets=3)
        for title, link, summary, published, source, category, _ in rows:
            old = table.get(link)
            table[link] = (title, published, old[2] if old else source, old[3] if old else category, NOW + dt.timedelta(days=k))
    got = {r["link"]: (r["title"], r["published"], r["source"], r["category"], r["collected_at"])
           for r in store.read_articles(spark, root).collect()}
    assert got == table
    cut = NOW - dt.timedelta(days=1)
    removed = store.retain_articles(spark, root, NOW, 1)
    left = {k: v for k, v in table.items() if (v[1] or v[4]) >= cut}
    assert removed == len(table) - len(left)
    assert {r["link"] for r in store.read_articles(spark, root).collect()} == set(left)
    assert store.read_articles(spark, root, since=NOW).count() >= sum((v[1] or v[4]) >= NOW for v in left.values())


def test_retain_date_partitions(spark, scratch):
    base = os.path.join(scratch, "raw")
    for name in ("2026-03-01", "2026-03-12", "misc"):
        os.makedirs(os.path.join(base, name))
    assert store.retain_date_partitions(spark, base, 7, dt.date(2026, 3, 13)) == 1
    assert sorted(os.listdir(base)) == ["2026-03-12", "misc"]
    assert store.retain_date_partitions(spark, base, -1, dt.date(2026, 3, 13)) == 0


def test_retain_summaries_names(spark):
    df = spark.createDataFrame([(s,) for s in ("art_20260301", "2026-03-02", "art_20260312", "index")], "stem string")
    kept = {r["stem"] for r in retain_summaries(df, 7, dt.date(2026, 3, 13)).collect()}
    assert kept == {"art_20260312", "index"}


def test_raw_log_partitions_and_run_dedup(spark, scratch):
    base = os.path.join(scratch, "raw")
    b = batch(spark, [art("ü title", "https://e.com/1", source="a/b\\c"), art("t2", "https://e.com/2", source="a/b\\c")])
    b = b.withColumn("source_ord", F.lit(0)).withColumn("item_ord", F.col("batch_ord"))
    raw_log.write_raw_log(spark, b, base, NOW)
    day = os.path.join(base, "log_date=2026-03-13")
    assert os.listdir(day) == ["source_safe=a_b_c"]
    leaf = os.path.join(day, "source_safe=a_b_c", "run_id=none")
    files = [f for f in os.listdir(leaf) if f.endswith(".json")]
    rec = json.loads(open(os.path.join(leaf, files[0]), encoding="utf-8").readline())
    assert rec["published"] is None and rec["matched_entities"] == {}
    # with a run id, links already logged for that run are skipped
    raw_log.write_raw_log(spark, b, base, NOW, run_id="r1")
    raw_log.write_raw_log(spark, b, base, NOW, run_id="r1")
    logged = raw_log.read_raw_log(spark, base)
    assert logged.filter(F.col("run_id") == "r1").count() == 2
    assert logged.count() == 4


def test_raw_log_keeps_one_record_per_source_and_run(spark, scratch):
    def rows(source):
        return batch(spark, [art("t", "https://e.com/1", source=source), art("t", "https://e.com/1", source=source)])
    for source, run in (("A", "r1"), ("B/C", "r1"), ("A", "r1"), ("A", "r2")):
        raw_log.write_raw_log(spark, rows(source), scratch, NOW, run_id=run, order=("batch_ord",))
    raw_log.write_raw_log(spark, rows("A"), scratch, NOW + dt.timedelta(days=1), run_id="r1", order=("batch_ord",))
    got = sorted((r["source"], r["run_id"], str(r["log_date"])) for r in raw_log.read_raw_log(spark, scratch).collect())
    assert got == [("A", "r1", "2026-03-13"), ("A", "r1", "2026-03-14"), ("A", "r2", "2026-03-13"), ("B/C", "r1", "2026-03-13")]

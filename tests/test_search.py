"""Full-text search: BM25 equals SQLite FTS5's bm25(), result contract, index maintenance."""

import datetime as dt
import sqlite3

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import search as FTS
from tidewatch.operators import index_upkeep as U
from tidewatch.operators.index_upkeep import maintain_postings, upsert_documents
from tidewatch.plans.search_plan import search_documents
from tidewatch.sinks import store
from tidewatch.sources import bindings as B
from conftest import SF_MID, SF_SMALL

DOCS = [("https://e.com/1", "Modern art today", "A review of modern art and design."),
        ("https://e.com/2", "Ancient art", "Pottery and sculpture from ancient times."),
        ("https://e.com/3", "Modern design", "Chairs, tables and modern lamps. Modern!"),
        ("https://e.com/4", "Market news", "Auction prices for art rose; modern works led."),
        ("https://e.com/5", "Other", "Nothing relevant here.")]


def docs(spark, rows=DOCS):
    return spark.createDataFrame(rows, "link string, title string, body string")


def fts5(rows, query, limit=20):
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE d USING fts5(link UNINDEXED, title, body)")
    con.executemany("INSERT INTO d VALUES (?, ?, ?)", rows)
    return con.execute("SELECT link, bm25(d) FROM d WHERE d MATCH ? ORDER BY bm25(d), link LIMIT ?",
                       (query, limit)).fetchall()


def ours(spark, d, query, limit=20):
    terms = FTS.query_terms(query)
    top = FTS.bm25_topk(FTS.fts_postings(d, terms=terms), FTS.doc_stats(d), terms, limit)
    return [(r["link"], r["rank"]) for r in top.collect()]


def has_fts5():
    try:
        sqlite3.connect(":memory:").execute("CREATE VIRTUAL TABLE t USING fts5(x)")
        return True
    except sqlite3.OperationalError:
        return False


@pytest.mark.skipif(not has_fts5(), reason="SQLite without FTS5")
@pytest.mark.parametrize("query", ["modern art", "art", "modern", "pottery sculpture"])
def test_bm25_equals_fts5_small(spark, query):
    want = fts5(DOCS, query)
    got = ours(spark, docs(spark), query)
    assert [l for l, _ in got] == [l for l, _ in want]
    for (_, a), (_, b) in zip(got, want):
        assert a == pytest.approx(b, abs=1e-9)


@pytest.mark.skipif(not has_fts5(), reason="SQLite without FTS5")
def test_bm25_equals_fts5_on_documents(spark):
    arts = B.document_articles(spark, SF_SMALL).select("link", "title", F.col("summary").alias("body"))
    rows = [tuple(r) for r in arts.collect()]
    for query in ("que el", "the and", "der die"):
        want = fts5(rows, query, 15)
        got = ours(spark, arts, query, 15)
        assert [l for l, _ in got] == [l for l, _ in want], query
        for (_, a), (_, b) in zip(got, want):
            assert a == pytest.approx(b, rel=1e-9, abs=1e-12)


def test_search_contract(spark):
    d = docs(spark)
    arts = spark.createDataFrame([(l, dt.datetime(2026, 3, 10)) for l, _, _ in DOCS],
                                 "link string, collected_at timestamp_ntz")
    now = dt.datetime(2026, 3, 13)
    hit = search_documents(d, arts, "modern art", now).collect()
    assert {r["link"] for r in hit} == {"https://e.com/1", "https://e.com/4"}
    assert search_documents(d, arts, "zzzunknown", now).count() == 0
    assert search_documents(d, arts, "modern", now, limit=2).count() == 2
    assert search_documents(d, arts, "modern", now, limit=0).count() == 0
    assert search_documents(d, arts, "top 1 modern", now).count() == 1        # limit in text wins
    assert search_documents(d, arts, "last 2 days modern", now).count() == 0  # day filter after top-k
    snip = search_documents(d, arts, "modern", now, with_snippets=True).orderBy("rank").first()["snippet"]
    assert "<b>" in snip


def test_upsert_documents_and_postings(spark):
    d = docs(spark)
    new = docs(spark, [("https://e.com/1", "Renamed", "Completely different words.")])
    merged = upsert_documents(d, new)
    assert merged.count() == 5
    assert merged.filter(F.col("link") == "https://e.com/1").first()["title"] == "Renamed"
    post = maintain_postings(FTS.fts_postings(d), new)
    rebuilt = FTS.fts_postings(merged)
    key = ["term", "link", "col", "tf"]
    assert sorted(map(tuple, post.select(*key).collect())) == sorted(map(tuple, rebuilt.select(*key).collect()))


def test_phrase_prefix(spark):
    d = docs(spark)
    post = FTS.fts_postings(d)
    assert {r["link"] for r in FTS.fts_phrase(post, ["modern", "art"]).collect()} == {"https://e.com/1"}
    assert {r["link"] for r in FTS.fts_prefix(post, "sculp").collect()} == {"https://e.com/2"}


def test_persisted_index_prunes_buckets(spark, scratch):
    d = docs(spark)
    FTS.write_index(d, scratch + "/idx", buckets=16)
    post, stats = FTS.read_index(spark, scratch + "/idx")
    terms = FTS.query_terms("modern art")
    top = FTS.bm25_topk(post, stats, terms, 10, buckets=16)
    assert [l for l, _ in ours(spark, d, "modern art")] == [r["link"] for r in top.collect()]
    plan = top._jdf.queryExecution().executedPlan().toString()
    import re
    assert re.search(r"PartitionFilters: \[[^\]]*term_bucket#\d+ = \d+", plan)


@pytest.mark.parametrize("mode", ["all", "any"])
def test_block_maxima_keep_the_ranks_and_skip_blocks(spark, scratch, mode):
    arts = B.document_articles(spark, SF_MID).select("link", "title", F.col("summary").alias("body"))
    FTS.write_index(arts, scratch + "/idx", buckets=4, block_docs=4)
    post, _ = FTS.read_index(spark, scratch + "/idx")
    blocks, stats = FTS.read_blocks(spark, scratch + "/idx"), FTS.read_stats(spark, scratch + "/idx")
    for query in ("the and", "que el", "the und", "nowhere the"):
        terms, read = FTS.query_terms(query), {}
        for k in (1, 20, 5000):
            want = FTS.bm25_topk(post, stats, terms, k, mode=mode, buckets=4).collect()
            got, seen = FTS.bm25_topk_blocks(post, blocks, stats, terms, k, mode=mode, buckets=4, first_blocks=4)
            got = got.collect()
            assert [r["link"] for r in got] == [r["link"] for r in want], (query, k)
            assert all(a["rank"] == pytest.approx(b["rank"], rel=1e-12) for a, b in zip(got, want))
            read[k] = seen["read"]
        if mode == "any" or query in ("the and", "que el"):
            assert read[1] <= read[20] <= read[5000] <= seen["blocks"] and read[1] < 0.5 * seen["blocks"], (query, read)


def test_prefix_opens_only_the_buckets_of_its_terms(spark, scratch):
    import re
    FTS.write_index(docs(spark), scratch + "/idx", buckets=16)
    post, _ = FTS.read_index(spark, scratch + "/idx")
    lexicon = FTS.read_lexicon(spark, scratch + "/idx")
    assert lexicon.count() == post.select("term").distinct().count()
    for prefix in ("mod", "a", "zz", "sculp"):
        got = FTS.fts_prefix(post, prefix, lexicon=lexicon)
        assert {r["link"] for r in got.collect()} == {r["link"] for r in FTS.fts_prefix(post, prefix).collect()}
    plan = FTS.fts_prefix(post, "sculp", lexicon=lexicon)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*term_bucket#\d+ = \d+", plan)


def test_lengths_are_token_counts(spark):
    arts = B.document_articles(spark, SF_SMALL).select("link", "title", F.col("summary").alias("body"))
    n = arts.select("link", FTS.token_counts("title", "body").alias("n"))
    assert n.join(FTS.doc_stats(arts), "link").filter("n <> dl").count() == 0


def files_under(root):
    import os
    return {os.path.join(d, f): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(root) for f in fs}


def test_index_segments_equal_a_rebuilt_index(spark, scratch):
    """Batches that replace, repeat and add documents; merging on the way; one consistent reader."""
    import random
    rng, root, held = random.Random(4), scratch + "/segments", {}
    early = None
    for k in range(7):
        rows = [(f"https://e.com/{i}", f"Title {k} {i % 3}", " ".join(rng.choice(["modern", "art", "tide", "Lamp"])
                 for _ in range(rng.randint(0, 9)))) for i in rng.sample(range(30), 12 if k else 25)]
        before = files_under(root)
        index = U.update_index(spark, root, docs(spark, rows))
        held.update({r[0]: r for r in rows})
        after = files_under(root)
        assert all(after[p] == c for p, c in before.items())  # nothing that was written is changed
        early = early or index
    assert len(index.segments) < 7 and U.read_manifest(spark, root) == index
    post, stored, stats = U.read_segments(spark, index)
    assert sorted(map(tuple, stored.select("link", "title", "body").collect())) == sorted(held.values())
    rebuilt = docs(spark, list(held.values()))
    key = ["term", "link", "col", "tf", "dl"]
    assert sorted(map(tuple, post.select(key).collect())) == sorted(map(tuple, FTS.fts_postings(rebuilt).select(key).collect()))
    want = FTS.doc_stats(rebuilt).agg(F.count(F.lit(1)), F.avg("dl")).first()
    assert tuple(stats.first()) == pytest.approx(tuple(want))
    for query in ("modern art", "tide"):
        terms = FTS.query_terms(query)
        got = FTS.bm25_topk(post, stats, terms, 10, buckets=FTS.DEFAULT_BUCKETS).collect()
        assert [r["link"] for r in got] == [link for link, _ in ours(spark, rebuilt, query, 10)]
    # a reader that holds an early manifest still reads that index
    assert U.read_segments(spark, early)[1].count() == 25
    assert U.update_index(spark, root, docs(spark, [])) == index
    with pytest.raises(store.VersionConflict):
        U._commit(spark, index)


def test_phrase_moves_positions_once(spark):
    rows = [("1", "a b a b c", "x"), ("2", "a b c", "b a"), ("3", "c a b", "a a b"), ("4", None, "a b a b a b c c")]
    post = FTS.fts_postings(docs(spark, rows)).checkpoint()
    for phrase in ("a", "a b", "a b c", "a b a b", "b a", "a a", "c c", "b c c", "a z"):
        terms = phrase.split()
        want = {link for link, t, body in rows for text in (t, body)
                if text and any(text.split()[i:i + len(terms)] == terms for i in range(len(text.split())))}
        assert {r["link"] for r in FTS.fts_phrase(post, terms).collect()} == want, phrase
    plan = FTS.fts_phrase(post, ["a", "b", "c", "a"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 0 and plan.count("Exchange") <= 2  # by (document, column), and the distinct documents


def test_postings_are_the_grouped_tokens_and_are_not_shuffled(spark):
    """Repeated and null keys, null texts, small batches and chunks: as the tokens grouped one by one."""
    import random
    rng = random.Random(6)
    rows = [(rng.choice([None, *(f"k{i}" for i in range(12))]), rng.choice([None, "", "Modern ART", "art art"]),
             rng.choice([None, "", " ".join(rng.choice(["art", "tide", "Lamp", "é"]) for _ in range(rng.randint(1, 30)))]))
            for _ in range(200)]
    want = {}
    for link, title, body in rows:
        both = [FTS_TOKENS(t) for t in (title, body)]
        for col, tokens in enumerate(both):
            for pos, term in enumerate(tokens):
                held = want.setdefault((term, link, col), [[], 0])
                held[0].append(pos)
                held[1] = max(held[1], sum(map(len, both)))
    totals = {}
    for (term, link, col), (at, _) in want.items():
        totals[term, link] = totals.get((term, link), 0) + len(at)
    want = sorted((repr(k), sorted(at), len(at), dl, totals[k[:2]]) for k, (at, dl) in want.items())
    old, chunk = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), FTS.CHUNK_TOKENS
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        FTS.CHUNK_TOKENS = 50
        post = FTS.fts_postings(docs(spark, rows))
        got = [(repr((r.term, r.link, r.col)), r.positions, r.tf, r.dl, r.doc_tf) for r in post.collect()]
        counts = {r.term: (r.doc_freq, r.total_tf) for r in FTS.term_counts(post).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
        FTS.CHUNK_TOKENS = chunk
    assert sorted(got) == want
    for term in counts:
        assert counts[term] == (sum(t == term and link is not None for t, link in totals), sum(n for (t, _), n in totals.items() if t == term))
    plan = post._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan  # the texts by key, no token rows


def FTS_TOKENS(text):
    import re
    import unicodedata
    folded = "".join(c for c in unicodedata.normalize("NFD", text or "") if not unicodedata.combining(c)).lower()
    return re.findall(r"[^\W_]+", folded)


def test_tokens_found_by_bytes_are_the_tokenizer_s(spark):
    """ASCII and other texts, side by side in one batch, and runs that end where a text ends."""
    texts = ["Modern-ART 2x", "", None, "\u0130stanbul \u0130", "e\u0301t\u00e9 \u00c9T\u00c9", "a\x00b\u00a0c", "\U0001f600art\U0001f600",
             "\ue000x \u0663\u0664", "\ufb01n \u017fo \u212aelvin", "tail", "head", "\ud55c\uad6d\uc5b4 art_deco", "\u00df", "...", "\n x \n"]
    rows = [(f"k{i:02d}", t, u) for i, t in enumerate(texts) for u in (texts[-1 - i],)]
    d = docs(spark, rows)
    want = sorted((t, r.link, c, p) for r in FTS.with_tokens(d).collect() for c, ts in enumerate((r.tt, r.bt)) for p, t in enumerate(ts))
    got = sorted((r.term, r.link, r.col, p) for r in FTS.fts_postings(d).collect() for p in r.positions)
    assert got == want
    lengths = {r.link: r.dl for r in FTS.with_tokens(d).collect()}
    assert {r.link: r.n for r in d.select("link", FTS.token_counts("title", "body").alias("n")).collect()} == lengths


def test_postings_come_in_the_order_of_the_index(spark):
    rows = [(f"k{i:03d}", "art tide", " ".join(f"w{(i * k) % 41}" for k in range(i % 17))) for i in range(120)]
    post = FTS.fts_postings(docs(spark, rows).coalesce(1), placed=True)
    place = post.select(FTS.term_bucket(F.col("term")).alias("b"), "term", FTS.doc_block(F.col("dl"), F.col("link"), F.lit(1)).alias("k"),
                        "link", "col")
    got = [tuple(r) for r in place.collect() if r.link != "k119"]  # the last key waits for the next batch
    assert len(got) > 500 and got == sorted(got)


def test_touched_keys_are_broadcast_and_documents_computed_once(spark, scratch):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        post = maintain_postings(FTS.fts_postings(docs(spark)), docs(spark, [("https://e.com/1", "Renamed", "Other words.")]))
        plan = post._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    seen = spark.sparkContext.accumulator(0)

    def look(title):
        seen.add(1)
        return title

    U.update_index(spark, scratch + "/once", docs(spark).withColumn("title", F.udf(look, "string")("title")))
    assert seen.value == len(DOCS)

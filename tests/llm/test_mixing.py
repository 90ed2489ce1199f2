from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm import cases
from tidewatch.llm import mixing


def mixed(df):
    return df.orderBy("mix_slot", "mix_offset").collect()


def test_every_prefix_is_within_one_block_of_the_targets(spark):
    units = {"a": 5, "b": 3, "c": 2, "d": 1}
    rows = [(i, s, "x" * 9) for s in units for i in range(1000 * (s == "a") + 600)]
    docs = spark.createDataFrame([(i, s, t) for i, (_, s, t) in enumerate(rows)], "doc_id long, source string, text string")
    weights = spark.createDataFrame(list(units.items()), "source string, weight int")
    got = mixed(mixing.mix_sources(docs, weights, block_chars=10, resolution=11))
    assert len({r.doc_id for r in got}) == len(rows)
    left, done, total = dict(units), Counter(), 11
    counts = Counter(s for _, s, _ in rows)
    for t, r in enumerate(got[:2200], 1):  # all sources still hold blocks here
        done[r.source] += 1
        assert r.mix_slot == t - 1
        for s, u in left.items():
            assert abs(done[s] - t * u / total) < 1
    assert Counter(r.source for r in got) == counts


def test_phases_keep_every_row_and_share_among_those_left(spark):
    rows = [(i, "a" if i < 40 else "b" if i < 400 else "c", "y" * 4) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    weights = spark.createDataFrame([("a", 2.0), ("b", 1.0), ("c", 1.0)], "source string, weight double")
    got = mixed(mixing.mix_sources(docs, weights, block_chars=5, resolution=4))
    assert [r.source for r in got].count("a") == 40
    assert Counter(r.source for r in got[:80]) == {"a": 40, "b": 20, "c": 20}
    tail = Counter(r.source for r in got[80:680])
    assert abs(tail["b"] - tail["c"]) <= 1
    assert len({(r.mix_slot, r.mix_offset) for r in got}) == 800


def test_blocks_are_cut_by_characters_in_hash_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = mixing.mix_sources(docs, block_chars=4096).withColumn("size", F.char_length("text") + 1).collect()
    by_source = defaultdict(list)
    for r in got:
        by_source[r.source].append((r.mix_block * 4096 + r.mix_offset, r.size))
    for places in by_source.values():
        at = 0
        for start, size in sorted(places):
            assert start == at
            at += size


def test_awkward_rows_and_hot_source_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 7)
    docs = cases.documents(spark).withColumn("mix_slot", F.lit(1))
    got = mixing.mix_sources(docs)
    assert got.columns == [c for c in docs.columns if c != "mix_slot"] + ["mix_block", "mix_slot", "mix_offset"]
    rows = got.collect()
    assert len(rows) == docs.count()
    assert len({(r.mix_slot, r.mix_offset) for r in rows}) == len(rows)
    assert Counter(r.text for r in rows) == Counter(r.text for r in docs.collect())


def test_empty_table(spark):
    assert mixing.mix_sources(cases.empty_documents(spark)).collect() == []

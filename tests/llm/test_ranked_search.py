import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tests.llm import cases
from tidewatch.llm import ranked_search as R

FIND = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in FIND.findall(text or "")]


def brute(docs, items, k=20):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for (doc_id, c), length in zip(counted, lengths):
            m = 100 - 25 + (25 * length * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, doc_id is not None, doc_id or 0, doc_id))
        out += [(item_id, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(str, out))


def got(df):
    return sorted(map(str, map(tuple, df.collect())))


def corpus(n=900, seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    frequency = [1 / (i + 1) for i in range(300)]
    text = lambda size: " ".join(rng.choices(vocabulary, frequency, k=size))
    docs = [(i, text(rng.randint(1, 120))) for i in range(n)]
    return docs, [(i, text(rng.randint(1, 25))) for i in range(30)]


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_equal_to_brute_force_in_small_segments_and_blocks(spark):
    docs, items = corpus()
    docs += docs[:40] + [(None, docs[3][1]), (5000, None), (5001, ""), (5002, "--")]  # repeats, ties, no terms
    items += [items[0], (None, items[1][1]), (77, None), (78, ".."), (79, "unheard of"), (80, "W0 w0 W0 w1")]
    d, q = frames(spark, docs, items)
    index = R.build_index(d.repartition(3), segment_docs=64)
    want = brute(docs, items)
    assert got(R.search(index, q)) == want
    assert got(R.search(index, q, block_pairs=40)) == want
    assert got(R.search(index, q, k=3)) == brute(docs, items, 3)


def test_real_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").select("item_id", "text")
    assert got(R.rank_documents(docs, items)) == brute([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])


def test_pair_bounds_skip_more_postings_and_keep_the_result(spark):
    rng = random.Random(8)  # two spellings of each common word; a text keeps to one of them
    rare = [f"r{i}" for i in range(150)]
    def text(spelling, size):
        return " ".join(rng.choice([f"common{rng.randint(0, 5)}{spelling}", rng.choice(rare)]) for _ in range(size))
    docs = [(i, text(rng.choice("ab"), rng.randint(5, 60))) for i in range(3000)]
    items = [(i, " ".join([*(f"common{j}{s}" for j in range(6) for s in "ab"), *rng.sample(rare, 3)])) for i in range(20)]
    d, q = frames(spark, docs, items)
    index = R.build_index(d.coalesce(1), segment_docs=1024)
    block = next(R.query_blocks(q, "item_id", "text", 10_000))
    lists, queries = R.block_lists(index, block, 5)
    read, found = {}, {}
    for pairs in (True, False):
        rows = R.search_lists(lists, queries, 5, use_pairs=pairs)
        stats = rows.where("query is null").agg(F.sum("doc_id"), F.sum("score")).first()
        read[pairs] = stats[0]
        found[pairs] = brute_top(rows)
        assert stats[0] < stats[1]  # pruning skips postings at all
    assert found[True] == found[False]
    assert read[True] < read[False]


def brute_top(rows):
    by = {}
    for r in rows.where("query is not null").collect():
        by.setdefault(r.query, []).append((-r.score, r.doc_id))
    return {q: sorted(v)[:5] for q, v in by.items()}


def test_pair_bound_is_never_above_the_sum_nor_below_a_score(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    for _ in range(50):
        single = {}
        for t in (0, 1):
            docs = np.flatnonzero(rng.random(40) < 0.4)
            if len(docs):
                impacts = rng.integers(1, 100, len(docs))
                single[t] = docs, impacts, int(impacts.max())
        if len(single) < 2:
            continue
        docs, a, b = np.intersect1d(single[0][0], single[1][0], return_indices=True)
        joint = single[0][1][a] + single[1][1][b]
        pair = {(0, 1): (docs, joint, int(joint.max()))} if len(docs) else {}
        times = {0: int(rng.integers(1, 3)), 1: int(rng.integers(1, 3))}
        bound = R.SegmentSearch(40, single, pair, 3).pair_bound(0, 1, times)
        score = np.zeros(40, np.int64)
        for t in (0, 1):
            score[single[t][0]] += times[t] * single[t][1]
        assert score.max() <= bound <= sum(times[t] * single[t][2] for t in (0, 1))


def test_awkward_rows_and_empty_tables(spark):
    docs = cases.documents(spark)
    items = docs.select(F.col("doc_id").alias("item_id"), "text", "label", "fp").limit(30)
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got(R.rank_documents(docs, items)) == want
    assert R.rank_documents(cases.empty_documents(spark), items).collect() == []
    assert R.rank_documents(docs, items.where("false")).collect() == []

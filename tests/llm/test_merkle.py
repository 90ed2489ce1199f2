import zlib
from hashlib import sha256

import pytest

from tests.llm import cases
from tidewatch.llm import merkle as M
from tidewatch.llm.oracle import ORACLE

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def H(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def fold(levels, i, x):
    """Siblings of place ``i`` up a tree given by its levels, and the root from ``x``."""
    proof = []
    for level in levels:
        lo = i // 8 * 8
        run = level[lo:lo + 8]
        if len(level) > 1:
            proof += run[:i - lo] + run[i - lo + 1:]
            x = H([*run[:i - lo], x, *run[i - lo + 1:]])
        i //= 8
    return proof, x


def levels_over(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def brute(rows):
    """``rows`` of (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for r in rows:
        lower = None if r[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        h = leaf(r)
        trees.setdefault(r[2], []).append((r[0], h, leaf((*r[:4], lower)) if tampered else h))
    names = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    levels = {}
    for k in names:
        trees[k].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        levels[k] = levels_over([h for _, h, _ in trees[k]])
    top = levels_over([levels[k][-1][0] for k in names])
    out = []
    for t, k in enumerate(names):
        for i, (doc_id, h, claim) in enumerate(trees[k]):
            low, x = fold(levels[k], i, claim)
            high, x = fold(top, t, x)
            out.append((doc_id, h, levels[k][-1][0], top[-1][0], H(low + high), x, x == top[-1][0]))
    return out


def text_rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def fixture(n):
    return [(7 * i % 1009, "s" if i % 5 else None, [None, "en", "é", "z", "", "aa"][i % 6 if i % 7 else 1], i, f"Text {i}" if i % 11 else None)
            for i in range(n)]


@pytest.mark.parametrize("n,block_levels", [(1, 4), (2, 4), (9, 1), (300, 1), (700, 2), (700, 4)])
def test_equal_to_brute_force(spark, n, block_levels):
    rows = fixture(n)
    got = M.verify(M.manifest(spark.createDataFrame(rows, COLUMNS), block_levels=block_levels))
    assert text_rows(got) == sorted(map(str, brute(rows)))


def test_real_documents_equal_brute_force_in_three_tiers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    got = M.verify(M.manifest(docs, block_levels=1))
    assert text_rows(got) == sorted(map(str, brute([tuple(r) for r in docs.collect()])))


def test_many_trees(spark):
    rows = [(i, None, f"lang{i % 90}", None, "T") for i in range(200)]
    got = M.verify(M.manifest(spark.createDataFrame(rows, COLUMNS), block_levels=1))
    assert text_rows(got) == sorted(map(str, brute(rows)))


def test_statement_equals_brute_force():
    import duckdb
    import pandas as pd
    rows = fixture(700) + [(None, None, None, None, None), (5, "s", "en", 1, "Same"), (5, "s", "en", 1, "Same")]
    con = duckdb.connect()
    con.register("docs", pd.DataFrame(rows, columns=["doc_id", "source", "lang", "n_chars", "text"]).convert_dtypes())
    con.execute("CREATE VIEW documents AS SELECT doc_id::BIGINT doc_id, source, lang, n_chars::BIGINT n_chars, text FROM docs")
    assert sorted(map(str, con.sql(ORACLE["op12_merkle_manifest"]).fetchall())) == sorted(map(str, brute(rows)))


def test_awkward_rows_and_empty_table(spark):
    docs = cases.documents(spark)
    want = brute([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()])
    assert text_rows(M.verify(M.manifest(docs, block_levels=1))) == sorted(map(str, want))
    assert M.verify(M.manifest(cases.empty_documents(spark))).collect() == []


def test_a_hot_repeated_row_is_spread(spark):
    rows = [(1, "s", "en", 3, "same")] * 400 + fixture(50)
    got = M.verify(M.manifest(spark.createDataFrame(rows, COLUMNS).repartition(4), block_levels=1))
    assert text_rows(got) == sorted(map(str, brute(rows)))


def test_witnesses_grow_with_later_siblings():
    tree = M.OpenTree(2)
    digests = [bytes([i]) * 32 for i in range(20)]
    tree.append(digests[0])
    assert tree.witnesses[0] == [(0, [])]
    tree.append(digests[1])
    assert tree.witnesses[0] == [(0, [digests[1]]), (1, [digests[0]])]
    for d in digests[2:]:
        tree.append(d)
    assert len(tree.witnesses[1]) == 2 and tree.root is None
    root = tree.finish()
    assert all(M.folded(d, w) == root for d, w in zip(digests, tree.witness_bytes()))

import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import cases
from tidewatch.llm import packing as P


@pytest.fixture(scope="module")
def encoder():
    return Tokenizer.from_file(P.tokenizer_path())


def check_packed(rows, texts, encoder, capacity=P.CAPACITY):
    """Every id of every text is in exactly one place; sequences are gapless and fit."""
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    expect = []
    for doc_id, text in texts:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, lo in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[lo:lo + capacity], dtype="<u4").tobytes()
            expect.append((doc_id, piece, lo, len(part) // 4, zlib.crc32(part)))
    assert sorted(map(str, expect)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    total = sum(e[3] for e in expect)
    return len(by_seq), -(-total // capacity)


def test_real_documents_round_trip(spark, encoder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = P.pack_documents(docs).collect()
    bins, least = check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()], encoder)
    assert bins <= least + 1


def test_awkward_rows(spark, encoder):
    docs = cases.documents(spark)
    extra = spark.createDataFrame([(500, "a<|endoftext|>b's <|startoftext|> DON'T É́  x 12 日本語  🙂"), (501, "w" * 30000)],
                                  "doc_id long, text string")
    both = docs.unionByName(extra, allowMissingColumns=True)
    rows = P.pack_documents(both).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in both.collect()], encoder)
    assert P.pack_documents(cases.empty_documents(spark)).collect() == []


def test_sequences_hold_the_ids(spark, encoder):
    docs = spark.createDataFrame([(1, "hello world"), (2, "foo"), (3, None)], "doc_id long, text string")
    packed = P.pack_documents(docs, with_ids=True)
    (row,) = P.sequences(packed).collect()
    parts = [encoder.encode(t, add_special_tokens=False).ids + [0] for t in ("hello world", "foo", "")]
    got = np.frombuffer(row.ids, dtype="<u4").tolist()
    assert row.length == len(got) and got in [list(itertools.chain(*p)) for p in itertools.permutations(parts)]


def test_hot_length_ranks_are_gapless(spark, monkeypatch):
    monkeypatch.setattr(P, "ROWS_PER_BUCKET", 10)
    docs = spark.createDataFrame([(i % 90, "cat " * 6) for i in range(300)] + [(1000 + i, "cat " * (i % 50)) for i in range(100)],
                                 "doc_id long, text string")
    rows = P.pack_documents(docs, capacity=64).collect()
    places = {(r.sequence_id, r.offset) for r in rows}
    assert len(places) == len(rows) == 400


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 5), max_size=8))
def test_bins_hold_every_piece_once(histogram):
    patterns = P.minimum_bin_slack(histogram, 20)
    used = {}
    for p in patterns:
        assert sum(n * k for n, k in p.lengths) <= 20
        for n, k in p.lengths:
            used[n] = used.get(n, 0) + k * p.bins
    assert used == histogram


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), max_size=5), st.integers(0, 30))
def test_fullest_combination_is_the_fullest(counts, room):
    best = max((sum(n * k for n, k in zip(counts, ks)) for ks in itertools.product(*[range(c + 1) for c in counts.values()])
                if sum(n * k for n, k in zip(counts, ks)) <= room), default=0)
    got = P.fullest_combination(counts, room)
    assert sum(n * k for n, k in got) == best and all(k <= counts[n] for n, k in got)

"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints: 64 majority votes over the hashes of the text's word shingles.  Two
fingerprints that differ in at most ``d`` bits agree on at least ``parts - d`` of ``parts``
bit ranges, so each distinct fingerprint is sent to one bucket per choice of ``parts - d``
ranges; every linked pair meets in some bucket.  A bucket fixes at least the chosen
ranges, so the number of distinct fingerprints it can ever hold is bounded by the free bits
(about 4 million for the default of six ranges and two bits), whatever the corpus.

Inside a bucket the fingerprints are sorted by Gray rank, which puts codes with long shared
bit patterns side by side.  Runs of codes become leaves, runs of leaves become upper nodes;
a node holds the mask of the bits that all codes below share and their pattern.  A search
walks down from the top, charges each node only for the shared bits its parent has not
charged yet, and drops the whole group once the accumulated differences exceed ``d``.
The links found are reduced to a spanning forest per bucket (a component needs no more),
then to components over all buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.shared import connected_components, fresh_name, materialize, row_bytes

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
PARTS = 6          # bit ranges; a bucket fixes PARTS - max_bits of them
FANOUT = 16        # codes per leaf and children per upper node
SMALL_BUCKET = 32  # buckets up to this size are one leaf: compared code by code
QUERY_CHUNK = 4096


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of UTF-8 ``text``; zero when it has no word."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle_words:
        hashes = [digest(b" ".join(words), HASH_SEED)]
    else:
        runs = zip(*(words[i:] for i in range(shingle_words)))
        hashes = [digest(b" ".join(run), HASH_SEED) for run in runs]
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    votes = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(octets), 65536):
        votes += np.unpackbits(octets[lo:lo + 65536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` holds the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [fingerprint(t, shingle_words) for t in row_bytes(batch, "text")]
            fps = np.array(codes, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, fp long")


def gray_rank(code: Column) -> Column:
    """Rank of a 64-bit code in Gray order, as a signed long that sorts like the unsigned rank."""
    rank = code
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def bucket_masks(max_bits: int, parts: int = PARTS) -> list[int]:
    """One mask per choice of ``parts - max_bits`` bit ranges, as signed longs."""
    bounds = [round(i * 64 / parts) for i in range(parts + 1)]
    ranges = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(bounds, bounds[1:])]
    masks = [sum(c) for c in combinations(ranges, parts - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


class GrayIndex:
    """Hierarchical index over distinct codes that are sorted by Gray rank."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (mask, pattern), leaves first
        ones, zeros = codes, ~codes  # bits set in all codes below / clear in all codes below
        while True:
            starts = np.arange(0, len(ones), FANOUT)
            ones = np.bitwise_and.reduceat(ones, starts)
            zeros = np.bitwise_and.reduceat(zeros, starts)
            self.levels.append((ones | zeros, ones))
            if len(starts) == 1:
                break

    def pairs(self, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs ``i < j`` of codes within ``max_bits``, a chunk of queries at a time."""
        for lo in range(0, len(self.codes), QUERY_CHUNK):
            yield self._search(np.arange(lo, min(lo + QUERY_CHUNK, len(self.codes))), max_bits)

    def _search(self, rows: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        query, node = rows, np.zeros(len(rows), dtype=np.int64)
        mask, pattern = self.levels[-1]
        spent = np.bitwise_count((self.codes[query] ^ pattern[node]) & mask[node]).astype(np.int16)
        width = FANOUT ** len(self.levels)
        for level in range(len(self.levels) - 1, -1, -1):
            keep = spent <= max_bits
            query, node, spent = query[keep], node[keep], spent[keep]
            parent_mask = self.levels[level][0]
            child_mask, child_pattern = self.levels[level - 1] if level else (None, self.codes)
            width //= FANOUT
            child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            query, node, spent = (np.repeat(a, FANOUT) for a in (query, node, spent))
            # only children that exist and still hold a code after the query (pairs i < j)
            live = (child < len(child_pattern)) & ((child + 1) * width - 1 > query)
            query, node, spent, child = query[live], node[live], spent[live], child[live]
            fresh = ~parent_mask[node]
            if child_mask is not None:
                fresh &= child_mask[child]
            spent = spent + np.bitwise_count((self.codes[query] ^ child_pattern[child]) & fresh)
            node = child
        keep = (spent <= max_bits) & (node > query)
        return query[keep], node[keep]


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union the sets of ``a[i]`` and ``b[i]``; every label is the smallest index of its set."""
    while len(a):
        la, lb = labels[a], labels[b]
        differ = la != lb
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            nxt = labels[labels]
            if np.array_equal(nxt, labels):
                break
            labels = nxt
    return labels


def _bucket_forest(bucket: np.ndarray, codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of whole buckets; ``bucket`` numbers them and rises along the rows."""
    n = len(codes)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[starts, n])
    labels = np.arange(n)
    small = np.repeat(sizes <= SMALL_BUCKET, sizes)
    for gap in range(1, int(min(SMALL_BUCKET, sizes.max()))):
        i = np.flatnonzero(small[:-gap] & (bucket[gap:] == bucket[:-gap]))
        near = np.bitwise_count(codes[i] ^ codes[i + gap]) <= max_bits
        labels = merge_labels(labels, i[near], i[near] + gap)
    for s, size in zip(starts[sizes > SMALL_BUCKET], sizes[sizes > SMALL_BUCKET]):
        own = np.arange(size)
        for i, j in GrayIndex(codes[s:s + size]).pairs(max_bits):
            own = merge_labels(own, i, j)
        labels[s:s + size] = own + s
    child = np.flatnonzero(labels != np.arange(n))
    return codes[child], codes[labels[child]]


def near_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the distinct fingerprints in reach of each other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0

        def flush(block: np.ndarray) -> pa.RecordBatch:
            change = np.r_[True, np.any(block[1:, :2] != block[:-1, :2], axis=1)]
            a, b = _bucket_forest(np.cumsum(change), np.ascontiguousarray(block[:, 2]).view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append(np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1))
            rows += batch.num_rows
            if rows < 200_000:
                continue
            block = np.concatenate(held)
            change = np.flatnonzero(np.any(block[1:, :2] != block[:-1, :2], axis=1))
            if len(change):  # keep the last bucket: the next batch may go on with it
                cut = int(change[-1]) + 1
                yield flush(block[:cut])
                block = block[cut:]
            held, rows = [block], len(block)
        if rows:
            yield flush(np.concatenate(held))

    masks = F.array(*[F.struct(F.lit(i).cast("long").alias("choice"), F.lit(m).cast("long").alias("mask"))
                      for i, m in enumerate(bucket_masks(max_bits))])
    keyed = (fps.select("fp", F.explode(masks).alias("m"))
             .select(F.col("m.choice").alias("choice"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("shared"), "fp"))
    dealt = (keyed.repartition("choice", "shared")
             .withColumn("rank", gray_rank(F.col("fp")))
             .sortWithinPartitions("choice", "shared", "rank").select("choice", "shared", "fp"))
    return dealt.mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    A null or empty text has the fingerprint zero, which links like any other.  Repeated
    rows and ids each keep their row.  ``component_id`` is the smallest non-null id in
    reach (null when all ids in reach are null).  Other input columns are ignored.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = connected_components(near_links(classes.select("fp"), max_bits))
    rooted = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labelled = materialize(rooted.join(smallest, "root").select("fp", "component_id"), "fp_components")
    return prints.join(labelled, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stand for their near-duplicate group, columns as they are.

    A row goes when its id is not the smallest of its group.  An id that repeats goes only
    if all its rows would, and rows whose id is null stay: no text is lost that way.
    """
    groups = simhash_groups(docs, id_col, text_col, shingle_words, max_bits)
    (dup,) = fresh_name(docs, "dup_id")
    drop = (groups.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias(dup))
            .agg(F.bool_and(F.col("doc_id") != F.col("component_id")).alias("all_copies"))
            .where("all_copies").select(dup))
    return docs.join(materialize(drop, "duplicates"), F.col(id_col) == F.col(dup), "left_anti")

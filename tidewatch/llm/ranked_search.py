"""Ranked lexical search by MaxScore with bounds of term pairs.

Index.  Documents are dealt to segments of bounded size where they are read; a segment holds
its documents' ids and lengths and one posting list (document, count) per term.  Nothing is
shuffled to build it and every document and term is in it.

Query sets.  Queries are answered in blocks of bounded size.  A block's posting lists are
selected by a join on the term, document frequencies are summed over segments, and then each
segment precomputes, per list, the impact (the term's part of the score) of each document and
the list's largest impact, and, for pairs of terms that queries of the block hold together,
the intersection list with joint impacts and the largest joint impact.  These lists are
stored; only a block's query terms have them, as impacts depend on corpus statistics.

Search.  A segment adds a query's lists in descending order of their largest impact.  The
lists not added yet bound what any other document can score; a pair among them is bound by
the larger of its joint maximum and its single maxima, which is never more and mostly less
than the sum of the two maxima that independent terms would give.  Once that bound is below
the k-th best score so far, no new document is admitted.  The remaining lists are looked up
for the admitted documents only, pair by pair; before each step those that cannot reach the
k-th best score any more are dropped, by the same bounds.  An intersection list gives a
document both impacts in one access; a document outside it holds at most one of the terms.
Scores are whole numbers, so every bound is exact and the result equals a full evaluation.

The k-th largest impact of any list, single or pair, in any segment is a score that k
documents reach; it is the threshold each segment starts from.  Segments return at most k
documents per query, which are ranked in Spark.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.shared import materialize, row_bytes

SEGMENT_DOCS = 8192            # most documents of a segment, and
SEGMENT_POSTINGS = 2_000_000   # most postings, but that a document is never cut
BLOCK_PAIRS = 100_000          # most (query, distinct term) pairs of a block, but that a query is never cut
TOP_K = 20

# --- fixed values: the bytes of terms; all others separate. A-Z are lower-cased ------------
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
# ------------------------------------------------------------------------------------------
FOLD = bytes(0x20 if b in SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()  # the only white space left is what separators became


# ---- index ----------------------------------------------------------------------------------
SEGMENT_SCHEMA = "segment long, term binary, docs array<int>, tf array<int>, ids array<long>, lengths array<long>"


class Segment:
    def __init__(self):
        self.ids, self.lengths, self.postings, self.size = [], [], {}, 0

    def add(self, doc_id: int | None, terms: list[bytes]) -> None:
        number = len(self.ids)
        self.ids.append(doc_id)
        self.lengths.append(len(terms))
        postings = self.postings
        counts = Counter(terms)
        self.size += len(counts)
        for term, tf in counts.items():
            found = postings.get(term)
            if found is None:
                postings[term] = [number], [tf]
            else:
                found[0].append(number)
                found[1].append(tf)

    def batches(self, segment: int, rows: int = 4096) -> Iterator[pa.RecordBatch]:
        names = ["segment", "term", "docs", "tf", "ids", "lengths"]
        empty = pa.nulls(1, pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment], pa.int64()), pa.nulls(1, pa.binary()), empty, empty,
             pa.array([self.ids], pa.list_(pa.int64())), pa.array([self.lengths], pa.list_(pa.int64()))], names=names)
        terms = sorted(self.postings)
        for lo in range(0, len(terms), rows):
            part = terms[lo:lo + rows]
            nothing = pa.nulls(len(part), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), segment)), pa.array(part, pa.binary()),
                 *[pa.array([self.postings[t][j] for t in part], pa.list_(pa.int32())) for j in range(2)], nothing, nothing],
                names=names)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """The stored index: per segment one row of documents (null ``term``) and one row per term."""
    most = SEGMENT_POSTINGS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, Segment()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), row_bytes(batch, "text")):
                held.add(doc_id, terms_of(text))
                if len(held.ids) >= segment_docs or held.size >= most:
                    yield from held.batches(number)
                    number, held = number + 1, Segment()
        if held.ids:
            yield from held.batches(number)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return materialize(slim.mapInArrow(run, SEGMENT_SCHEMA), "search-index")


# ---- query sets -----------------------------------------------------------------------------
def query_blocks(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[int | None, list, list]]]:
    """Blocks of queries as ``(id, terms, multiplicities)``, read from storage part by part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter(terms_of(t)) for t in row_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([list(c) for c in counts], pa.list_(pa.binary())),
                 pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))], names=["id", "terms", "times"])

    slim = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    block, size = [], 0
    for row in materialize(slim.mapInArrow(run, "id long, terms array<binary>, times array<long>"), "queries").toLocalIterator():
        if block and size + len(row.terms) > most:
            yield block
            block, size = [], 0
        if row.terms:
            block.append((row.id, [bytes(t) for t in row.terms], row.times))
            size += len(row.terms)
    if block:
        yield block


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def adjacent_pairs(block: list, number: dict[bytes, int], df: dict[int, int], weights: np.ndarray) -> set[tuple[int, int]]:
    """Each query's terms two by two in order of their frequency: the lists that pruning leaves for last."""
    pairs = set()
    for _, terms, _ in block:
        held = sorted((number[t] for t in terms if weights[number[t]] > 0), key=lambda t: (-df[t], t))
        pairs.update((min(p), max(p)) for p in zip(held[0::2], held[1::2]))
    return pairs


LIST_SCHEMA = "segment long, a int, b int, docs array<int>, impacts array<long>, top long, kth long"


def impact_lists(relevant: DataFrame, documents: DataFrame, weights: np.ndarray, pairs: set[tuple[int, int]],
                 n_docs: int, total: int, k: int) -> DataFrame:
    """Stored impact lists per segment: single terms (``b`` = -1), pairs, and the ids (``a`` = -1).

    ``top`` is the largest impact and ``kth`` the k-th largest, 0 in shorter lists.
    """
    shipped = relevant.sparkSession.sparkContext.broadcast((weights, np.array(sorted(pairs), np.int64).reshape(-1, 2)))
    schema = pa.schema([("segment", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.list_(pa.int32())),
                        ("impacts", pa.list_(pa.int64())), ("top", pa.int64()), ("kth", pa.int64())])

    def run(key: tuple, postings: pa.Table, rows: pa.Table) -> pa.Table:
        w, wanted = shipped.value
        ids = rows.column("ids").combine_chunks()
        lengths = np.asarray(rows.column("lengths").combine_chunks().flatten())
        norm = 12 * (100 - 25 + (25 * lengths * n_docs) // total)
        single = {}
        for t, docs, tf in zip(postings.column("t").to_pylist(), lists_of(postings, "docs"), lists_of(postings, "tf")):
            tf = tf.astype(np.int64)
            single[t] = docs, w[t] * ((1_000_000_000 * tf) // (1000 * tf + norm[docs]))
        out_a, out_b, out_docs, out_impacts = [], [], [], []
        for t, (docs, impacts) in single.items():
            if w[t] > 0:
                out_a.append(t), out_b.append(-1), out_docs.append(docs), out_impacts.append(impacts)
        for a, b in wanted.tolist():
            if a in single and b in single:
                docs, at_a, at_b = np.intersect1d(single[a][0], single[b][0], assume_unique=True, return_indices=True)
                if len(docs):
                    out_a.append(a), out_b.append(b), out_docs.append(docs)
                    out_impacts.append(single[a][1][at_a] + single[b][1][at_b])
        top = [int(i.max()) for i in out_impacts]
        kth = [int(np.partition(i, len(i) - k)[len(i) - k]) if len(i) >= k else 0 for i in out_impacts]
        n = len(out_a)
        lists = pa.table([pa.array(np.full(n, key[0].as_py())), pa.array(out_a, pa.int32()), pa.array(out_b, pa.int32()),
                          pa.array(out_docs, pa.list_(pa.int32())), pa.array(out_impacts, pa.list_(pa.int64())),
                          pa.array(top, pa.int64()), pa.array(kth, pa.int64())], schema=schema)
        own = pa.table([[key[0].as_py()], [-1], [-1], [None], ids, [0], [0]], schema=schema)
        return pa.concat_tables([lists, own])

    return materialize(relevant.groupBy("segment").cogroup(documents.groupBy("segment")).applyInArrow(run, LIST_SCHEMA),
                       "search-lists")


def lists_of(table: pa.Table, name: str) -> list[np.ndarray]:
    column = table.column(name).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    values, edges = np.asarray(column.values.fill_null(0)), np.asarray(column.offsets)  # null: an id of the ids' row
    return [values[lo:hi] for lo, hi in zip(edges[:-1], edges[1:])]


# ---- search ---------------------------------------------------------------------------------
class SegmentSearch:
    """One segment's lists; ``read`` counts the postings (single and joint) that searches took, ``held`` all of the queries' single ones."""

    def __init__(self, n_docs: int, single: dict[int, tuple], pair: dict[tuple[int, int], tuple], k: int):
        self.n_docs, self.single, self.pair, self.k = n_docs, single, pair, k
        self.read = self.held = 0

    def pair_bound(self, a: int, b: int, times: dict[int, int]) -> int:
        """Most that documents gain from the two terms: both (joint maximum) or only one."""
        one = max(times[a] * self.single[a][2], times[b] * self.single[b][2])
        joint = self.pair.get((min(a, b), max(a, b)))
        if joint is None:  # never together in this segment
            return one
        both = min(max(times[a], times[b]) * joint[2], times[a] * self.single[a][2] + times[b] * self.single[b][2])
        return max(one, both)

    def search(self, terms: list[int], times: dict[int, int], paired: list[tuple[int, int]], start: int) -> tuple:
        """Documents that can be among the best ``k``, with their exact scores; ``start`` is a score
        that ``k`` documents of the corpus are known to reach."""
        terms = sorted((t for t in terms if t in self.single), key=lambda t: (-times[t] * self.single[t][2], t))
        if not terms:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held += sum(len(self.single[t][0]) for t in terms)
        mate = {a: b for p in paired if p[0] in self.single and p[1] in self.single for a, b in (p, p[::-1])}
        rest = self.bounds(terms, times, mate)
        score, threshold, added = np.zeros(self.n_docs, np.int64), max(start, 1), 0
        while added < len(terms) and rest[added] >= threshold:
            docs, impacts, _ = self.single[terms[added]]
            self.read += len(docs)
            score[docs] += times[terms[added]] * impacts
            added += 1
            if added < len(terms) and self.n_docs > self.k and rest[added] < score.max():
                threshold = max(threshold, int(np.partition(score, self.n_docs - self.k)[self.n_docs - self.k]))
        docs = np.flatnonzero(score)
        units = self.units(terms[added:], times, mate)
        remaining = sum(bound for bound, *_ in units)
        for bound, a, b in units:
            if len(docs) > self.k:
                threshold = max(threshold, int(np.partition(score[docs], len(docs) - self.k)[len(docs) - self.k]))
            docs = docs[score[docs] + remaining >= threshold]
            remaining -= bound
            if b is None:
                self.look_up(self.single[a], times[a], docs, score)
            elif times[a] == times[b]:  # both impacts in one access; the others hold one term at most
                both = self.look_up(self.pair[(a, b)], times[a], docs, score) if (a, b) in self.pair else np.zeros(len(docs), bool)
                one = docs[~both]
                one = one[~self.look_up(self.single[a], times[a], one, score)]
                self.look_up(self.single[b], times[b], one, score)
            else:
                self.look_up(self.single[a], times[a], docs, score)
                self.look_up(self.single[b], times[b], docs, score)
        keep = docs[score[docs] >= threshold]
        return keep, score[keep]

    def look_up(self, found: tuple, times: int, docs: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Adds a list's impacts to the documents that it holds; returns which these are."""
        where, impacts, _ = found
        at = np.minimum(np.searchsorted(where, docs), len(where) - 1)
        hit = where[at] == docs
        self.read += int(hit.sum())
        score[docs[hit]] += times * impacts[at[hit]]
        return hit

    def units(self, terms: list[int], times: dict[int, int], mate: dict[int, int]) -> list[tuple[int, int, int | None]]:
        """The terms as pairs and single terms with their bounds, the largest first."""
        out, inside = [], set(terms)
        for t in terms:
            m = mate.get(t)
            if m not in inside:
                out.append((times[t] * self.single[t][2], t, None))
            elif t < m:
                out.append((self.pair_bound(t, m, times), t, m))
        return sorted(out, key=lambda u: (-u[0], u[1]))

    def bounds(self, terms: list[int], times: dict[int, int], mate: dict[int, int]) -> list[int]:
        """For each place, most that a document gains from the terms at and after it."""
        out, total, inside = [0], 0, set()
        for t in reversed(terms):
            top = times[t] * self.single[t][2]
            m = mate.get(t)
            if m in inside:
                total += self.pair_bound(t, m, times) - times[m] * self.single[m][2]
            else:
                total += top
            inside.add(t)
            out.append(total)
        return out[::-1]


def search_lists(lists: DataFrame, queries: list[tuple], k: int, use_pairs: bool = True) -> DataFrame:
    """``(query int, doc_id, score)`` candidates of all segments; a row with a null ``query`` per segment
    has the number of postings read (``doc_id``) and of all postings of the queries' lists (``score``)."""
    shipped = lists.sparkSession.sparkContext.broadcast(queries)  # one block: at most BLOCK_PAIRS terms
    schema = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        single, pair, ids = {}, {}, None
        docs_of, impacts_of = lists_of(table, "docs"), lists_of(table, "impacts")
        a_of, b_of, top_of = (table.column(c).to_pylist() for c in ("a", "b", "top"))
        for i, (a, b) in enumerate(zip(a_of, b_of)):
            if a < 0:
                ids = table.column("impacts")[i].values
            elif b < 0:
                single[a] = docs_of[i], impacts_of[i], top_of[i]
            elif use_pairs:
                pair[(a, b)] = docs_of[i], impacts_of[i], top_of[i]
        order = np.asarray(ids.fill_null(np.iinfo(np.int64).min))
        engine = SegmentSearch(len(ids), single, pair, k)
        query, row, score = [], [], []
        for q, (terms, times, paired, start) in enumerate(shipped.value):
            docs, found = engine.search(terms, times, paired if use_pairs else [], start)
            best = np.lexsort((order[docs], -found))[:k]
            query.append(np.full(len(best), q)), row.append(docs[best]), score.append(found[best])
        flat = np.concatenate(row).astype(np.int64)
        rows = pa.table([pa.array(np.concatenate(query).astype(np.int32)), ids.take(pa.array(flat)), pa.array(np.concatenate(score))],
                        schema=schema)
        return pa.concat_tables([rows, pa.table([[None], [engine.read], [engine.held]], schema=schema)])

    return lists.groupBy("segment").applyInArrow(run, "query int, doc_id long, score long")


def block_lists(index: DataFrame, block: list, k: int) -> tuple[DataFrame, list[tuple]]:
    """A block's stored lists and its queries as ``(terms, times, pairs, start)`` by term number."""
    spark = index.sparkSession
    documents = index.where("term is null").select("segment", "ids", "lengths")
    holds = F.filter("lengths", lambda n: n > 0)
    n_docs, total = documents.agg(
        F.coalesce(F.sum(F.size(holds)), F.lit(0)),
        F.coalesce(F.sum(F.aggregate(holds, F.lit(0).cast("long"), lambda s, n: s + n)), F.lit(0))).first()
    number = {t: i for i, t in enumerate(sorted({t for _, terms, _ in block for t in terms}))}
    wanted = spark.createDataFrame([(t, i) for t, i in number.items()], "term binary, t int")
    relevant = materialize(index.where("term is not null").join(wanted, "term").select("segment", "t", "docs", "tf"), "search-postings")
    df = dict(relevant.groupBy("t").agg(F.sum(F.size("docs"))).collect())  # the block's terms only
    weights = np.array([weight(n_docs, df[i]) if i in df else 0 for i in range(len(number))], np.int64)
    pairs = adjacent_pairs(block, number, df, weights)
    lists = impact_lists(relevant, documents, weights, pairs, n_docs, max(total, 1), k)
    reached = {(r.a, r.b): r.kth for r in lists.where("a >= 0").groupBy("a", "b").agg(F.max("kth").alias("kth")).collect()}
    queries = []
    for _, terms, times in block:
        own = {number[t]: n for t, n in zip(terms, times) if weights[number[t]] > 0}
        held = sorted(own, key=lambda t: (-df[t], t))
        paired = [(min(p), max(p)) for p in zip(held[0::2], held[1::2])]
        start = max([own[t] * reached.get((t, -1), 0) for t in own]
                    + [min(own[a], own[b]) * reached.get((a, b), 0) for a, b in paired], default=0)
        queries.append((held, own, paired, start))
    return lists, queries


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = TOP_K,
           block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0.

    Equal scores rank by ascending document id, null first.  Items without terms (null and
    empty texts too) have no rows; repeated items and documents count each.
    """
    spark, parts = index.sparkSession, []
    for block in query_blocks(items, id_col, text_col, block_pairs):
        lists, queries = block_lists(index, block, k)
        found = search_lists(lists, queries, k).where("query is not null")
        place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("doc_id"))
        names = spark.createDataFrame([(i, b[0]) for i, b in enumerate(block)], "query int, item_id long")
        parts.append(found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
                     .join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP_K) -> DataFrame:
    return search(build_index(docs), items, k=k)

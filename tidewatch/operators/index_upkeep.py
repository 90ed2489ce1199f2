"""Keeping the search corpus and its postings in step with upserts.

Stored index.  A batch of documents becomes a segment of its own (``postings/seg=<id>``,
``docs/seg=<id>``); older segments stay as they are, and the batch's documents that they
still hold go to a deletion list (``gone/seg=<id>``, named by the segment that replaces them).
One manifest (``_manifests/<n>.json``, committed as the article table's are) names the
segments and lists that belong together, with their numbers of documents and tokens, so a
reader sees one consistent index and the corpus statistics need no data.  An upsert thus reads
the link columns of the touched buckets and writes what it touches.  When ``MERGE_FACTOR``
segments are of like size they are merged: their live rows are copied, not tokenised again.
"""

from __future__ import annotations

import math
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.search import fts_postings, place_documents, write_documents, write_postings
from tidewatch.sinks import store

MERGE_FACTOR = 4   # segments of like size that are merged; sizes are alike within this factor
DOC_BUCKETS = 64
MAX_BROADCAST_KEYS = 1_000_000  # touched or deleted keys that are broadcast to the postings; more are shuffled with them


def upsert_documents(docs: DataFrame, incoming: DataFrame, key: str = "link",
                     order: str | None = None) -> DataFrame:
    """Replace documents by key; within ``incoming`` the last row (by ``order``) wins."""
    if order is not None:
        cols = [c for c in incoming.columns if c not in (key, order)]
        incoming = (incoming.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_r"))
                    .select(key, *[F.col("_r")[c].alias(c) for c in cols]))
    return docs.join(incoming.select(key), key, "left_anti").unionByName(incoming.select(*docs.columns))


def maintain_postings(postings: DataFrame, touched_docs: DataFrame, key: str = "link",
                      title: str = "title", body: str = "body") -> DataFrame:
    """Postings after re-indexing ``touched_docs``: their old postings are removed and the
    new ones added; postings of untouched documents are kept as they are (no re-tokenising)."""
    touched = touched_docs.select(key).distinct()
    kept = postings.join(F.broadcast(touched) if touched.count() <= MAX_BROADCAST_KEYS else touched, key, "left_anti")
    return kept.unionByName(fts_postings(touched_docs, key, title, body).select(*postings.columns))


class Segment(NamedTuple):
    name: str
    docs: int      # documents and tokens when it was written
    tokens: int


class Index(NamedTuple):
    root: str
    number: int
    segments: tuple[Segment, ...]
    gone: tuple[tuple[str, int, int], ...]  # deletion lists: name, documents, tokens

    @property
    def n_docs(self) -> int:
        return sum(s.docs for s in self.segments) - sum(g[1] for g in self.gone)

    @property
    def n_tokens(self) -> int:
        return sum(s.tokens for s in self.segments) - sum(g[2] for g in self.gone)


def read_manifest(spark: SparkSession, root: str) -> Index | None:
    known = store.versions(spark, root)
    if not known:
        return None
    head, *lines = store.read_lines(spark, f"{root}/_manifests/{known[-1]}.json")
    return Index(root, head["number"], tuple(Segment(*v) for kind, *v in lines if kind == "segment"),
                 tuple(tuple(v) for kind, *v in lines if kind == "gone"))


def _commit(spark: SparkSession, index: Index) -> Index:
    lines = [{"number": index.number}, *[["segment", *s] for s in index.segments], *[["gone", *g] for g in index.gone]]
    store.write_lines(spark, lines, f"{index.root}/_manifests/{index.number}.json")
    return index


SCHEMAS = {"postings": "{key} string, col int, term string, positions array<int>, tf bigint, dl bigint, doc_tf bigint, "
                       "doc_block bigint, seg string, term_bucket int",
           "docs": "{key} string, title string, body string, dl bigint, seg string, doc_bucket int",
           "gone": "old string, {key} string, dl bigint, seg string"}


def _read(spark: SparkSession, index: Index, part: str, names, key: str) -> DataFrame:
    return (spark.read.schema(SCHEMAS[part].format(key=key)).option("basePath", f"{index.root}/{part}")
            .parquet(*[f"{index.root}/{part}/seg={n}" for n in names]))


def _live(spark: SparkSession, index: Index, part: str, names, key: str) -> DataFrame:
    rows = _read(spark, index, part, names, key)
    if not index.gone:
        return rows
    gone = _read(spark, index, "gone", [g[0] for g in index.gone], key).select(F.col("old").alias("seg"), key)
    few = sum(g[1] for g in index.gone) <= MAX_BROADCAST_KEYS
    return rows.join(F.broadcast(gone) if few else gone, ["seg", key], "left_anti")


def read_segments(spark: SparkSession, index: Index, key: str = "link") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(postings, documents, one row of statistics) of the index as its manifest names them."""
    names = [s.name for s in index.segments]
    stats = spark.createDataFrame([(float(index.n_docs), index.n_tokens / index.n_docs if index.n_docs else None)],
                                  "n_docs double, avg_dl double")
    return (_live(spark, index, "postings", names, key).drop("seg"),
            _live(spark, index, "docs", names, key).drop("seg"), stats)


def update_index(spark: SparkSession, root: str, docs: DataFrame, key: str = "link", title: str = "title",
                 body: str = "body") -> Index:
    """Index ``docs`` (one row per key) in place of the documents of the same keys.

    ``store.VersionConflict`` if another writer committed first; the index is then unchanged.
    """
    base = read_manifest(spark, root) or Index(root, 0, (), ())
    name = uuid.uuid4().hex
    path = f"{root}/docs/seg={name}"
    write_documents(docs.select(key, F.col(title).alias("title"), F.col(body).alias("body")), path, key, buckets=DOC_BUCKETS,
                    mode="errorifexists")
    size = _size(spark, path)
    if not size[0]:
        store.delete(spark, path)
        return base
    docs = _read(spark, base, "docs", [name], key)  # computed once
    write_postings(fts_postings(place_documents(docs, size[1], key), key, placed=True), f"{root}/postings/seg={name}", key,
                   mode="errorifexists")
    gone = base.gone
    if base.segments:
        buckets = [r[0] for r in docs.select("doc_bucket").distinct().collect()]
        held = _live(spark, base, "docs", [s.name for s in base.segments], key).filter(F.col("doc_bucket").isin(*buckets))
        found = held.select(F.col("seg").alias("old"), key, "dl").join(docs.select(key), key, "left_semi")
        found.write.mode("errorifexists").parquet(f"{root}/gone/seg={name}")
        replaced = _size(spark, f"{root}/gone/seg={name}")
        gone += ((name, *replaced),) if replaced[0] else ()
    segments = base.segments + (Segment(name, *size),)
    return _commit(spark, _merged(spark, Index(root, base.number + 1, segments, gone), key))


def _size(spark: SparkSession, path: str) -> tuple[int, int]:
    return tuple(spark.read.schema("dl bigint").parquet(path).agg(F.count(F.lit(1)), F.coalesce(F.sum("dl"), F.lit(0))).first())


def _tier(segment: Segment) -> int:
    return int(math.log(max(segment.docs, 1), MERGE_FACTOR))


def _merged(spark: SparkSession, index: Index, key: str) -> Index:
    """The index after merging the smallest tier that has ``MERGE_FACTOR`` segments, if any has."""
    tiers: dict[int, list[Segment]] = {}
    for s in index.segments:
        tiers.setdefault(_tier(s), []).append(s)
    full = sorted(t for t, members in tiers.items() if len(members) >= MERGE_FACTOR)
    if not full:
        return index
    old, name = tiers[full[0]], uuid.uuid4().hex
    names = [s.name for s in old]
    docs = _live(spark, index, "docs", names, key).drop("seg")
    (docs.hint("rebalance", F.col("doc_bucket")).sortWithinPartitions("doc_bucket", key)
     .write.mode("errorifexists").partitionBy("doc_bucket").parquet(f"{index.root}/docs/seg={name}"))
    postings = _live(spark, index, "postings", names, key).drop("seg", "term_bucket", "doc_block")
    write_postings(postings.hint("rebalance"), f"{index.root}/postings/seg={name}", key, mode="errorifexists")
    gone = index.gone
    if gone:  # what was deleted from the merged segments is gone for good; the rest stays listed
        rest = _read(spark, index, "gone", [g[0] for g in gone], key).select("old", key, "dl").filter(~F.col("old").isin(*names))
        rest.write.mode("errorifexists").parquet(f"{index.root}/gone/seg={name}")
        left = _size(spark, f"{index.root}/gone/seg={name}")
        gone = ((name, *left),) if left[0] else ()
    size = _size(spark, f"{index.root}/docs/seg={name}")
    segments = tuple(s for s in index.segments if s not in old) + ((Segment(name, *size),) if size[0] else ())
    return Index(index.root, index.number, segments, gone)

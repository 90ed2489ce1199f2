"""Embedding near-dedup: spherical k-means cells, blocked cosine products, one row per group.

1. Equal vectors collapse to one node with a count, so copies never meet as pairs.
2. Only vectors of one length have a cosine, so each length has cells of its own; a length with
   few vectors is one cell.  Spherical k-means, fitted to a bounded sample, gives the others'
   cells; their number is the one with the least estimated work (cosines and rows sent).  Every node has its nearest centroid as
   home.  Cells lose no pair: for a node x with home h, a vector within the angle
   ``a`` (cos a = min_cosine) can have another home c only if
       x.h - x.c <= tan(a) * sqrt(|c - h|^2 - (x.(c - h))^2),
   so x is sent as a guest to each such cell (only to cells before its home: each pair of
   cells then meets once).
3. Cells are cut into blocks of bounded size.  A block's rows are held as one matrix, and the
   rows of later blocks and the guests stream past it in batches; their cosines are matrix
   products in double precision.
4. Per node and block only the number of links and one spanning link leave the task, never the
   pairs; components of the spanning links are the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.shared import connected_components, fresh_name, materialize
from tidewatch.llm.simhash import merge_labels

MIN_COSINE = 0.95
SAMPLE = 8192        # vectors that the cells of a length are fitted to, at most
FIT_ROWS = 256       # vectors of a length from which on it has more than one cell
MAX_CELLS = 1024     # cells; their size, not their number, grows beyond
ROUNDS = 10
TRIAL_ROWS = 2048    # sample rows on which numbers of cells are compared (not those of the fit)
TRIAL_ROUNDS = 4
PAIR_COST, ROW_COST = 2.5e-10, 7e-6  # seconds per component product and per row sent, about
BLOCK_ROWS = 4096
PROBE_ROWS = 1024
SLACK = 1e-9         # for rounding in the guest bound


def usable(vec: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def unit_rows(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Unit centroids for unit rows; a cell that runs empty takes the row farthest from its own."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), size=k, replace=False)]
    for _ in range(rounds):
        similar = x @ centroids.T
        home = similar.argmax(axis=1)
        order = np.argsort(home, kind="stable")
        present, starts = np.unique(home[order], return_index=True)
        sums = np.zeros_like(centroids)
        sums[present] = np.add.reduceat(x[order], starts, axis=0)
        empty = np.setdiff1d(np.arange(k), present)
        sums[empty] = x[np.argsort(similar.max(axis=1))[:len(empty)]]
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centroids = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centroids)
    return centroids


def homes_and_guests(x: np.ndarray, c: np.ndarray, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit row, and whether it is a guest of each cell before its home."""
    s = x @ c.T
    home = s.argmax(axis=1)
    near = s[np.arange(len(x)), home][:, None] - s
    apart = 2 - 2 * (c @ c.T)[home]
    tangent = np.sqrt(1 - min_cosine ** 2) / min_cosine
    bound = tangent * np.sqrt(np.maximum(apart - near * near, 0)) + SLACK
    return home, (near <= bound) & (np.arange(len(c))[None, :] < home[:, None])


def estimated_seconds(x: np.ndarray, c: np.ndarray, min_cosine: float, total: int) -> float:
    """Work for ``total`` vectors that are spread over the cells as the rows of ``x`` are."""
    home, guest = homes_and_guests(x, c, min_cosine)
    own = np.bincount(home, minlength=len(c)) / len(x)
    visits = guest.sum(axis=0) / len(x)
    blocks = np.ceil(total * own / BLOCK_ROWS)
    pairs = total * total * float((own * own / 2 + visits * own).sum())
    rows = total * (1 + float(((own / 2 + visits) * blocks).sum()))
    return pairs * x.shape[1] * PAIR_COST + rows * ROW_COST


def choose_cells(x: np.ndarray, total: int, min_cosine: float, max_cells: int) -> int:
    """The number of cells, a power of two from 8 to ``max_cells``, with the least estimated work."""
    trial = x[:min(TRIAL_ROWS, len(x) // 2)]
    fit = x[len(trial):]
    if not len(trial):
        return 1
    most = max(1, min(max_cells, len(fit) // 8))
    sizes = [k for k in (1 << i for i in range(3, 32)) if k <= most] or [most]
    cost = {k: estimated_seconds(trial, spherical_kmeans(fit, k, TRIAL_ROUNDS), min_cosine, total) for k in sizes}
    return min(cost, key=lambda k: (cost[k], k))


def assign_cells(nodes: DataFrame, centroids: dict[int, np.ndarray], min_cosine: float) -> DataFrame:
    """One row per node and cell it belongs to: ``cell, guest, node, h, n, packed``.

    The cells of the lengths in ``centroids`` are numbered one length after the other; any
    other length is one cell with its negative as number.
    """
    shipped = nodes.sparkSession.sparkContext.broadcast(centroids)  # MAX_CELLS rows a length at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, at = {}, 0
        for dim, c in sorted(shipped.value.items()):
            first[dim], at = at, at + len(c)
        for batch in batches:
            dims = batch.column(4).to_numpy()
            for dim in np.unique(dims).tolist():
                rows_of = np.flatnonzero(dims == dim)
                for lo in range(0, len(rows_of), 2048):
                    part = batch.take(pa.array(rows_of[lo:lo + 2048]))
                    raw = _matrix(part.column(3), dim)
                    home, rows, cells = np.full(len(raw), -dim), np.zeros(0, np.int64), np.zeros(0, np.int64)
                    if dim in first:
                        home, guest = homes_and_guests(unit_rows(raw.astype(np.float64)), shipped.value[dim], min_cosine)
                        rows, cells = np.nonzero(guest)
                        home, cells = home + first[dim], cells + first[dim]
                    packed = pa.array([raw[i].tobytes() for i in range(len(raw))], pa.binary())
                    take = pa.array(np.r_[np.arange(len(raw)), rows])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.r_[home, cells].astype(np.int32)),
                         pa.array(np.r_[np.zeros(len(raw), bool), np.ones(len(rows), bool)]),
                         part.column(0).take(take), part.column(1).take(take), part.column(2).take(take),
                         packed.take(take)], names=["cell", "guest", "node", "h", "n", "packed"])

    return nodes.select("node", "h", "n", "vec", "dim").mapInArrow(
        run, "cell int, guest boolean, node long, h long, n long, packed binary")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim)


def block_links(members: DataFrame, sizes: dict[int, int], min_cosine: float, single: bool) -> DataFrame:
    """``node, links, root``: per node and block, the rows linked to it and one spanning link."""
    kind = np.float32 if single else np.float64
    blocks = {c: -(-n // BLOCK_ROWS) for c, n in sizes.items()}
    pairs = [F.lit(v) for c, b in blocks.items() if b > 1 for v in (c, b)]  # cells of over BLOCK_ROWS rows
    in_cell = F.coalesce(F.create_map(*pairs)[F.col("cell")], F.lit(1)) if pairs else F.lit(1)
    own = F.pmod(F.col("h"), F.col("n_blocks")).cast("int")
    last = F.when(F.col("guest"), F.col("n_blocks") - 1).otherwise(own)
    dealt = (members.withColumn("n_blocks", in_cell)
             .withColumn("home", F.when(~F.col("guest"), own))
             .withColumn("block", F.explode(F.sequence(F.lit(0), last)))
             .withColumn("probe", ~F.coalesce(F.col("home") == F.col("block"), F.lit(False)))
             .select("cell", "block", "probe", "node", "n", "packed")
             .repartition("cell", "block").sortWithinPartitions("cell", "block", "probe", "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None

        for batch in batches:
            key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            probe = batch.column(2).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1) | (probe[1:] != probe[:-1])) + 1
            for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(key)]):
                if block is None or block.key != tuple(key[lo]):
                    if block is not None:
                        yield block.finish()
                    block = _Block(tuple(key[lo]), min_cosine)
                rows = batch.slice(lo, hi - lo)
                node, n = (rows.column(i).to_numpy() for i in (3, 4))
                x = unit_rows(np.frombuffer(b"".join(rows.column(5).to_pylist()), dtype=kind)
                              .reshape(hi - lo, -1).astype(np.float64))
                if not probe[lo]:
                    block.hold(node, n, x)
                    continue
                for at in range(0, len(x), PROBE_ROWS):
                    cut = slice(at, at + PROBE_ROWS)
                    found = block.probe(node[cut], n[cut], x[cut])
                    if found is not None:
                        yield found
        if block is not None:
            yield block.finish()

    return dealt.mapInArrow(run, "node long, links long, root long")


class _Block:
    """The rows of one block, held while others stream past."""

    def __init__(self, key: tuple, min_cosine: float):
        self.key, self.min_cosine, self.parts, self.x = key, min_cosine, [], None

    def hold(self, node, n, x) -> None:
        self.parts.append((node, n, x))

    def close(self) -> None:
        if self.x is not None:
            return
        if not self.parts:  # a cell without home rows in this block
            self.node = self.n = np.zeros(0, np.int64)
            self.x = np.zeros((0, 0))
        else:
            self.node, self.n, self.x = (np.concatenate(c) for c in zip(*self.parts))
        size = len(self.node)
        self.links, self.labels = np.zeros(size, np.int64), np.arange(size)
        for lo in range(0, size, PROBE_ROWS):
            i, j = np.nonzero(self.x[lo:lo + PROBE_ROWS] @ self.x.T >= self.min_cosine)
            i += lo
            i, j = i[i < j], j[i < j]
            self.links += np.bincount(i, weights=self.n[j], minlength=size).astype(np.int64)
            self.links += np.bincount(j, weights=self.n[i], minlength=size).astype(np.int64)
            self.labels = merge_labels(self.labels, i, j)

    def probe(self, node, n, x) -> pa.RecordBatch | None:
        self.close()
        if not len(self.node):
            return None
        i, j = np.nonzero(x @ self.x.T >= self.min_cosine)
        if not len(i):
            return None
        self.links += np.bincount(j, weights=n[i], minlength=len(self.node)).astype(np.int64)
        links = np.bincount(i, weights=self.n[j], minlength=len(node)).astype(np.int64)
        hit, first = np.unique(i, return_index=True)
        anchor = np.zeros(len(node), np.int64)
        anchor[hit] = j[first]
        self.labels = merge_labels(self.labels, j, anchor[i])  # all anchors of a probe are one set
        return _links_batch(node[hit], links[hit], self.node[anchor[hit]])

    def finish(self) -> pa.RecordBatch:
        self.close()
        hit = np.flatnonzero((self.links > 0) | (self.labels != np.arange(len(self.labels))))
        return _links_batch(self.node[hit], self.links[hit], self.node[self.labels[hit]])


def _links_batch(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns],
                                      names=["node", "links", "root"])


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                     min_cosine: float = MIN_COSINE, sample: int = SAMPLE, max_cells: int = MAX_CELLS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Vectors that are null, empty, zero or hold null or non-finite components and rows without
    id link with nothing: no links, ``component_id`` is the own id, ``kept`` is true if there is
    one.  Vectors of different lengths never link.  Rows that repeat a vector are linked copies;
    rows that share an id are vectors of their own, each with its own links and component.
    Other input columns are ignored.
    """
    kind = vectors.schema[vec_col].dataType.elementType.simpleString()
    single = kind == "float"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vec_col).cast("array<float>" if single else "array<double>").alias("vec"))
    good = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    nodes = materialize(
        good.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
        .withColumn("h", F.xxhash64("vec")).withColumn("dim", F.size("vec"))
        .withColumn("node", F.monotonically_increasing_id()), "vectors")  # stored, so it names the vector for all readers
    lengths = dict(nodes.groupBy("dim").count().collect())  # two numbers per length
    centroids = {}
    for dim, total in sorted(lengths.items()):
        if total < FIT_ROWS:
            continue
        picked = nodes.where(F.col("dim") == dim).orderBy("h", "vec").limit(sample).select("vec").toArrow()  # bounded
        x = unit_rows(_matrix(picked.column("vec").combine_chunks(), dim).astype(np.float64))
        centroids[dim] = spherical_kmeans(x, choose_cells(x, total, min_cosine, max_cells))
    members = materialize(assign_cells(nodes, centroids, min_cosine), "cells")
    sizes = dict(members.where("not guest").groupBy("cell").count().collect())  # one row per cell
    found = materialize(block_links(members, sizes, min_cosine, single), "vector-links")

    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked_reps = materialize(nodes.select("node", "rep").join(groups, "node"), "vector-groups")
    smallest = linked_reps.groupBy("root").agg(F.min("rep").alias("component_id"))
    linked_reps = linked_reps.select("node", "root").join(smallest, "root").select("node", "component_id")
    known = (nodes.join(counts, "node", "left").join(linked_reps, "node", "left")
             .select(F.col("vec").alias("same"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("component_id", "rep").alias("component_id")))
    known = materialize(known, "vector-groups")
    linked = (rows.join(known, F.when(F.col("vec_id").isNotNull(), F.col("vec")) == F.col("same"), "left")
              .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id")))
    return linked.select("vec_id", "n_links", "component_id",
                         F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_representatives(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                         min_cosine: float = MIN_COSINE) -> DataFrame:
    """The rows of ``vectors`` that stand for their group; rows without id stay."""
    (gone,) = fresh_name(vectors, "gone_id")
    groups = embedding_groups(vectors, id_col, vec_col, min_cosine)
    drop = groups.where("vec_id is not null").groupBy(F.col("vec_id").alias(gone)).agg(
        F.bool_or("kept").alias("any_kept")).where("not any_kept").select(gone)
    return vectors.join(materialize(drop, "vector-copies"), F.col(id_col) == F.col(gone), "left_anti")

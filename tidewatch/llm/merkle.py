"""Merkle dataset manifest: incremental witnesses over distributed, aligned appends.

Every row is a leaf; per tree (language) the leaves stand in order, every ``ARITY`` consecutive
nodes become their hash, and what remains of each tree becomes a node of the tree of trees.

Appending.  Leaves are appended to their tree from left to right.  An open tree keeps, per
level, the run that is not complete yet and the partial witness of every node in it: a new
node starts with the siblings before it, and each sibling that completes later extends the
witnesses of those before it.  A witness of a subtree is kept once and shared by its leaves.
When a run is complete (or the tree is finished) its hash is appended one level up.

Distribution.  Leaves get their place by one range sort; a block is an aligned run of
``ARITY ** BLOCK_LEVELS`` places of one tree, so a hot language is many blocks, and one task
appends the leaves of a block.  The block's root is then itself a leaf of a smaller tree:
block roots are appended by the same code, tier by tier, until one node is left per tree,
and the trees' roots are appended to the tree of trees.  A leaf's whole witness is that of
its block followed by those of the blocks above it.

Texts are hashed where they are read; only digests move.  Every tier is written to the shared
folder, so a lost executor costs no more than its tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.shared import materialize

ARITY = 8
BLOCK_LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPER_EVERY = 3


# ---- leaves ---------------------------------------------------------------------------------
def encoded(value: Column) -> Column:
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]), 256))


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, tree_field: str = "lang") -> DataFrame:
    """``tree, doc_id, digest, claim, salt``: ``claim`` is the leaf as recomputed later, from the
    tampered row where the manifest's test tampers with it.  ``tree`` is '' for null."""
    doc_id, text = F.col(fields[0]), F.col(fields[-1])
    others = [F.col(c) for c in fields[:-1]]
    tampered = F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(TAMPER_EVERY)) == 0, F.lit(False))
    digest = leaf_digest(*others, text)
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(tree_field).cast("string")), F.lit("")).alias("tree"),
        doc_id.cast("long").alias("doc_id"), digest.alias("digest"),
        F.when(tampered, leaf_digest(*others, F.translate(text.cast("string"), UPPER, LOWER))).alias("claim"),
        F.monotonically_increasing_id().alias("salt"))


def placed(nodes: DataFrame, tree: str, order: list[str], label: str) -> DataFrame:
    """``nodes`` with ``pos``, the place in the tree's order, and ``n``, the nodes of the tree.

    A range sort deals neighbours to the same task whatever the tree; places are the row's
    number in its part and tree plus the rows of the tree in earlier parts.
    """
    keys = [tree, *order]
    ranged = materialize(nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("at", F.monotonically_increasing_id()), label)
    ranged = ranged.withColumn("part", F.shiftright("at", 33))
    parts = ranged.groupBy(tree, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy(tree)  # one row per part that holds the tree
    before = F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select(tree, "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                          F.sum("rows").over(whole).alias("n"))
    return ranged.join(starts, [tree, "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


# ---- appending ------------------------------------------------------------------------------
def hashed(digests: list[bytes]) -> bytes:
    return sha256("".join([d.hex() for d in digests]).encode()).digest()


class OpenTree:
    """A tree of a fixed number of levels that grows at its right edge."""

    def __init__(self, levels: int):
        self.levels = levels
        self.runs: list[list[bytes]] = [[] for _ in range(levels)]
        self.witnesses: list[list[tuple[int, list[bytes]]]] = [[] for _ in range(levels)]  # place in run, siblings
        self.root: bytes | None = None

    def append(self, digest: bytes, level: int = 0) -> None:
        if level == self.levels:
            self.root = digest
            return
        run, partial = self.runs[level], self.witnesses[level]
        for _, siblings in partial[len(partial) - len(run):]:
            siblings.append(digest)
        partial.append((len(run), run.copy()))
        run.append(digest)
        if len(run) == ARITY:
            self.complete(level)

    def complete(self, level: int) -> None:
        digest = hashed(self.runs[level])
        self.runs[level] = []
        self.append(digest, level + 1)

    def finish(self) -> bytes:
        """Completes what is still open, from the bottom; the root of the tree."""
        for level in range(self.levels):
            if self.runs[level]:
                self.complete(level)
        return self.root

    def witness_bytes(self) -> Iterator[bytes]:
        """The witness of each leaf: per level the place in the run, the siblings' number, the siblings."""
        coded = [[bytes((place, len(siblings))) + b"".join(siblings) for place, siblings in level] for level in self.witnesses]
        for i in range(len(self.witnesses[0]) if self.levels else 1):
            yield b"".join([coded[level][i // ARITY ** level] for level in range(self.levels)])


def levels_of(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


NODE = "tree string, pos long, n long, digest binary, doc_id long, claim binary"


def append_blocks(nodes: DataFrame, block_levels: int, label: str) -> DataFrame:
    """One tier: each block's members with their ``witness``, and one row per block with its root.

    A root's row has ``is_root`` and is the next tier's node: ``pos`` is the block, ``n`` the
    number of the tree's blocks.
    """
    size = ARITY ** block_levels
    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
                        ("doc_id", pa.int64()), ("claim", pa.binary()), ("witness", pa.binary()), ("is_root", pa.bool_())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        n = table.column("n")[0].as_py()
        open_tree = OpenTree(block_levels if n > size else levels_of(n))
        for digest in table.column("digest").to_pylist():
            open_tree.append(digest)
        root = open_tree.finish()
        columns = [table.column(c).combine_chunks() for c in ("tree", "pos", "n", "digest", "doc_id", "claim")]
        members = pa.table([*columns, pa.array(open_tree.witness_bytes(), pa.binary()),
                            pa.array([False] * len(table))], schema=schema)
        last = pa.table([[key[0].as_py()], [key[1].as_py()], [-(-n // size)], [root], [None], [None], [None], [True]],
                        schema=schema)
        return pa.concat_tables([members, last])

    blocks = nodes.select("tree", "pos", "n", "digest", "doc_id", "claim",
                          F.floor(F.col("pos") / size).cast("long").alias("block"))
    return materialize(blocks.groupBy("tree", "block").applyInArrow(run, f"{NODE}, witness binary, is_root boolean"), label)


def append_all(nodes: DataFrame, block_levels: int, label: str) -> tuple[DataFrame, DataFrame]:
    """All tiers: the nodes ``(tree, pos, digest, doc_id, claim, witness, above)`` and the roots ``(tree, root)``.

    ``above`` is the witness of the node's block up to the root.
    """
    tiers = [append_blocks(nodes, block_levels, label)]
    most = tiers[0].where("is_root").agg(F.max("n")).first()[0] or 0
    while most > 1:
        tiers.append(append_blocks(tiers[-1].where("is_root"), block_levels, label))
        most = -(-most // ARITY ** block_levels)
    roots = tiers[-1].where("is_root").select("tree", F.col("digest").alias("root"))
    size = ARITY ** block_levels
    above = roots.select("tree", F.lit(0).cast("long").alias("block"), F.lit(b"").alias("above"))
    for tier in reversed(tiers[1:]):
        members = tier.where("not is_root").withColumn("block", F.floor(F.col("pos") / size).cast("long"))
        above = members.join(above, ["tree", "block"]).select(
            "tree", F.col("pos").alias("block"), F.concat("witness", "above").alias("above"))
    members = tiers[0].where("not is_root").withColumn("block", F.floor(F.col("pos") / size).cast("long"))
    return members.join(above, ["tree", "block"]).drop("block", "is_root", "n"), roots


# ---- the manifest ---------------------------------------------------------------------------
def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, tree_field: str = "lang",
             block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, digest, claim, subroot, root, path``.

    ``fields`` are the hashed columns, id first and text last.  Per tree the leaves ascend by id,
    null first; rows that share an id ascend by digest.  Trees ascend by name, null first.
    ``path`` is the leaf's witness up to the root; ``claim`` is null where the row is as it was.
    Extra columns are ignored; an empty table gives no rows.
    """
    hashed_leaves = materialize(leaves(docs, fields, tree_field), "merkle-leaves")
    ordered = placed(hashed_leaves, "tree", ["doc_id", "digest", "salt"], "merkle-order")
    nodes, subroots = append_all(ordered, block_levels, "merkle-tier")
    trees = placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest")),
                   "tree", ["name"], "merkle-trees")
    trees = materialize(trees.withColumn("doc_id", F.lit(None).cast("long")).withColumn("claim", F.lit(None).cast("binary")),
                        "merkle-trees")
    tops, roots = append_all(trees, block_levels, "merkle-top")
    names = trees.select("pos", F.col("name").alias("tree"), F.col("digest").alias("subroot"))
    last = roots.first()  # the tree of trees has one root, or none over an empty table
    per_tree = materialize(
        tops.select("pos", F.concat("witness", "above").alias("top")).join(names, "pos")
        .withColumn("root", F.lit(bytes(last.root) if last else b"")), "merkle-roots")
    return nodes.join(per_tree.select("tree", "top", "subroot", "root"), "tree").select(
        "doc_id", "digest", "claim", "subroot", "root", F.concat("witness", "above", "top").alias("path"))


def unfold(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(path):
        place, count = path[at], path[at + 1]
        at += 2
        yield place, [path[at + 32 * i:at + 32 * (i + 1)] for i in range(count)]
        at += 32 * count


def folded(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    for place, siblings in unfold(path):
        digest = hashed([*siblings[:place], digest, *siblings[place:]])
    return digest


def verify(entries: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of manifest rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, digest, claim, subroot, root, path = (c.to_pylist() for c in batch.columns)
            proof = [hashed([s for _, siblings in unfold(p) for s in siblings]).hex() for p in path]
            ends = [folded(d if c is None else c, p) for d, c, p in zip(digest, claim, path)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([d.hex() for d in digest]), pa.array([s.hex() for s in subroot]),
                 pa.array([r.hex() for r in root]), pa.array(proof, pa.string()), pa.array([e.hex() for e in ends]),
                 pa.array([e == r for e, r in zip(ends, root)], pa.bool_())],
                names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return entries.select("doc_id", "digest", "claim", "subroot", "root", "path").mapInArrow(
        run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")

"""Best-fit packing by minimum bin slack.

Texts become token pieces of at most ``capacity`` tokens.  Only the number of pieces of each
length matters for the packing, so the heuristic runs on that histogram (``capacity`` rows at
most, whatever the corpus): per bin, the longest piece left is set, and subset-sum dynamic
programming over the lengths that are left, on bitsets, finds the fullest feasible
combination.  Taking one such bin away leaves the same combination the fullest as long as
its pieces last, so it is taken as often as they do.  Each such step uses up a length or
nearly so, which bounds the steps by the capacity.

The pieces then find their bin by their rank among the pieces of their length.  Ranks come
from counts per (length, hash bucket) and a row number inside each, so a length that holds
a third of all pieces is ranked by many tasks.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.shared import fresh_name, materialize, row_bytes, spread_key

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
ROWS_PER_BUCKET = 20_000
PIECE_SCHEMA = "piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: punctuation between an ASCII letter or digit and white space or the end
TAIL = re.compile(rb"([0-9A-Za-z])([!-/:-@\[-`{-~]+)(?=[ \t-\r]|\Z)")
KNOWN_WORDS = 300_000    # words remembered per worker before the memory restarts
GROUP_BYTES = 4 << 20    # texts whose new words are encoded together
JOINED_WORDS = 200       # new words that one string for the tokenizer holds


class WordIds:
    """Packed little-endian ids of texts, each distinct word encoded once per worker and memory.

    The vocabulary drops white space and merges nothing across it, so a text's ids are those
    of its words in a row.  Neither does it merge letters or digits with a run of punctuation
    after them, nor tell ASCII capitals from small letters, so a space before such a run and
    small letters change no id and leave fewer words.  New words of letters only are one unit
    each and are encoded many to a string: the units end where an id with the word-end mark
    stands.  Should their number differ, and for all other words, a word is encoded by itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        mark = self.encoder.model.end_of_word_suffix
        vocabulary = self.encoder.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if mark:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        self.known: dict[bytes, bytes] = {}

    @staticmethod
    def words(text: bytes) -> list[bytes]:
        if b"<|" in text:  # may be a special token, whose spelling counts
            return text.split()
        return TAIL.sub(rb"\1 \2", text).lower().split()

    def _encode(self, strings: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.encoder.encode_batch_fast(strings, add_special_tokens=False)]

    def _learn(self, missing: set[bytes]) -> None:
        texts = {w: w.decode("utf-8") for w in sorted(missing)}
        letters = [w for w, t in texts.items() if t.isalpha()]
        chunks = [letters[lo:lo + JOINED_WORDS] for lo in range(0, len(letters), JOINED_WORDS)]
        for chunk, ids in zip(chunks, self._encode([" ".join([texts[w] for w in c]) for c in chunks])):
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(chunk) and ends[-1] == len(ids):
                packed, start = ids.tobytes(), 0
                for word, end in zip(chunk, (4 * ends).tolist()):
                    self.known[word] = packed[start:end]
                    start = end
        rest = [w for w in texts if w not in self.known]
        for word, ids in zip(rest, self._encode([texts[w] for w in rest])):
            self.known[word] = ids.tobytes()

    def pack(self, texts: Iterator[bytes]) -> Iterator[bytes]:
        group, size = [], 0
        for text in texts:
            group.append(self.words(text))
            size += len(text)
            if size >= GROUP_BYTES:
                yield from self._pack_group(group)
                group, size = [], 0
        yield from self._pack_group(group)

    def _pack_group(self, group: list[list[bytes]]) -> Iterator[bytes]:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        self._learn(set().union(*group) - self.known.keys())
        known = self.known
        for words in group:
            yield b"".join([known[w] for w in words])


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 path: str | None = None, carry: tuple[str, ...] = (), with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``, the columns named in
    ``carry`` and, if asked for, the packed ``ids``.  A null text is empty: its only id is the
    end id.  Only documents of more than ``capacity`` tokens have more than one piece."""
    path = path or tokenizer_path()
    end = np.array([END_ID], dtype="<u4").tobytes()
    step = 4 * capacity
    names = ["doc_id", *carry, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids = WordIds(path)
        for batch in batches:
            at, rows, ids = [], [], []
            for i, packed in enumerate(word_ids.pack(row_bytes(batch, "text"))):
                packed += end
                for piece, lo in enumerate(range(0, len(packed), step)):
                    part = packed[lo:lo + step]
                    at.append(i)
                    rows.append((piece, lo // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        ids.append(part)
            keep = batch.select(["doc_id", *carry]).take(pa.array(at, pa.int64()))
            cols = list(zip(*rows)) if rows else [[]] * 4
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                keep.columns + [pa.array(c, k) for c, k in zip(cols, kinds)] + [pa.array(ids, pa.binary())] * with_ids,
                names=names)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), *carry, F.col(text_col).cast("string").alias("text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema if f.name in ("doc_id", *carry))
    return slim.mapInArrow(run, f"{kept}, {PIECE_SCHEMA}" + ", ids binary" * with_ids)


@dataclass
class Pattern:
    """A combination of lengths that fills a bin, and how many bins are filled so."""
    lengths: list[tuple[int, int]]  # (length, pieces of it in the bin), longest first
    bins: int


def fullest_combination(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """Pieces (length, number) with the largest sum up to ``room``; longer pieces win ties."""
    lengths = sorted((n for n, c in counts.items() if c and n <= room), reverse=True)
    window = (1 << (room + 1)) - 1
    reach, stages = 1, []  # bit s: the sum s can be reached with the lengths so far
    for n in lengths:
        stages.append((n, reach))
        left, power = min(counts[n], room // n), 1
        while left:
            take = min(power, left)
            reach |= (reach << (n * take)) & window
            left -= take
            power *= 2
        if reach >> room:  # a full bin: shorter lengths cannot do better
            break
    target, chosen = reach.bit_length() - 1, []
    for n, before in reversed(stages):
        k = 0
        while not before >> target & 1:
            target -= n
            k += 1
        if k:
            chosen.append((n, k))
    return chosen[::-1]


def minimum_bin_slack(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Bins for all pieces of the histogram (length -> number of pieces)."""
    counts = {n: c for n, c in histogram.items() if c}
    patterns = []
    while counts:
        longest = max(counts)
        rest = dict(counts)
        rest[longest] -= 1
        combo: dict[int, int] = defaultdict(int, fullest_combination(rest, capacity - longest))
        combo[longest] += 1
        bins = min(counts[n] // k for n, k in combo.items())
        patterns.append(Pattern(sorted(combo.items(), reverse=True), bins))
        for n, k in combo.items():
            counts[n] -= k * bins
            if not counts[n]:
                del counts[n]
    return patterns


def placement(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, runs of ranks: first rank, pieces per bin, first bin, first offset."""
    used: dict[int, int] = defaultdict(int)
    runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    first_bin = 0
    for p in patterns:
        offset = 0
        for n, k in p.lengths:
            runs[n].append((used[n], k, first_bin, offset))
            used[n] += k * p.bins
            offset += n * k
        first_bin += p.bins
    return {n: tuple(np.array(col, dtype=np.int64) for col in zip(*rows)) for n, rows in runs.items()}


def assign_bins(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``pieces`` must be a stored table."""
    bucket, rank, first = fresh_name(pieces, "pack_bucket", "pack_rank", "pack_first")
    lengths = {r[0]: r[1] for r in pieces.groupBy("length").agg(F.count(F.lit(1))).collect()}  # capacity rows at most
    plan = pieces.sparkSession.sparkContext.broadcast(placement(minimum_bin_slack(lengths, capacity)))
    buckets = max(1, -(-max(lengths.values(), default=0) // ROWS_PER_BUCKET))
    keyed = pieces.withColumn(bucket, spread_key(F.col("doc_id"), F.col("piece"), parts=buckets))
    sums = keyed.groupBy("length", bucket).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    firsts = materialize(sums.select(F.col("length").alias("pack_length"), F.col(bucket).alias("pack_in"),
                                     F.coalesce(F.sum("n").over(before), F.lit(0)).alias(first)), "pack-ranks")
    own = Window.partitionBy("length", bucket).orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (keyed.withColumn(rank, F.row_number().over(own) - 1)
              .join(firsts, (F.col("length") == F.col("pack_length")) & (F.col(bucket) == F.col("pack_in")))
              .withColumn(rank, F.col(rank) + F.col(first)).select(*pieces.columns, rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = plan.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            at = batch.column(rank).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros_like(at), np.zeros_like(at)
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                start, per_bin, first_bin, first_offset = runs[int(n)]
                run_no = np.searchsorted(start, at[rows], side="right") - 1
                within = at[rows] - start[run_no]
                sequence[rows] = first_bin[run_no] + within // per_bin[run_no]
                offset[rows] = first_offset[run_no] + within % per_bin[run_no] * n
            kept = batch.drop_columns([rank])
            yield pa.RecordBatch.from_arrays(kept.columns + [pa.array(sequence), pa.array(offset)],
                                             names=kept.schema.names + ["sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   path: str | None = None, carry: tuple[str, ...] = (), with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place in the packed sequences.

    Null ids and repeated rows each keep their pieces.  An empty table has no sequence.
    Extra input columns are left out unless named in ``carry``.
    """
    pieces = token_pieces(docs, id_col, text_col, capacity, path, carry, with_ids)
    return assign_bins(materialize(pieces, "pieces"), capacity)


def in_mix_order(packed: DataFrame) -> DataFrame:
    """``packed`` with ``first_slot`` and ``first_offset``: the mix place of the sequence's
    earliest document.  Reading sequences by them keeps the mix through the packing.  Null
    places sort last and give null if a sequence has no other."""
    place = F.struct("mix_slot", "mix_offset")
    earliest = packed.groupBy(F.col("sequence_id").alias("pack_sequence")).agg(
        F.min(F.when(F.col("mix_slot").isNotNull(), place)).alias("pack_first"))
    return packed.join(earliest, F.col("sequence_id") == F.col("pack_sequence")).select(
        *packed.columns, F.col("pack_first.mix_slot").alias("first_slot"),
        F.col("pack_first.mix_offset").alias("first_offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id, length`` and, if the pieces hold them, the ``ids``."""
    grouped = packed.groupBy("sequence_id")
    if "ids" not in packed.columns:
        return grouped.agg(F.sum("length").alias("length"))
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most one capacity of ids
    return grouped.agg(F.sum("length").alias("length"), F.aggregate(
        parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))

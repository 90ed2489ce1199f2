"""Near-duplicate detection: exact groups, URL similarity, title ratio, candidate pairs.

Pair predicate (per pair of articles): same host, normalised-title ratio >= 0.85, and
paths equal or path ratio >= 0.8, where ratio is the Ratcliff/Obershelp ``2M / T`` of
``difflib.SequenceMatcher``.  The ratio is asymmetric, so each pair is evaluated in one
fixed argument order: by (normalised title, path, key).

Plan.  (1) Rows equal on (host, path, normalised title) collapse to one representative
(``duplicate_groups``): members of a group are duplicates of each other by definition and
are reported through the group, never as all-pairs.  (2) Each representative gets a bag
signature of its title and path (``bag_signature``).  (3) Slim rows (key, lengths,
signatures) meet in tiles of two blocks of a host and length band; a tile's task compares the
signatures as whole arrays, so only pairs that can pass become rows.  (4) The exact
ratio runs in an Arrow-batched UDF on those pairs' texts.

Bag bound.  A ratio of at least t leaves at most ``D = (1 - t)(la + lb)`` characters
unmatched.  The bags of characters then differ by at most D.  Matching blocks are separated by
unmatched characters, so there are at most D + 1 of them and the bags of character pairs
differ by at most 3 D.  Signatures are bit sets whose Hamming distance never exceeds those
differences (counts in unary, capped; characters and pairs hashed to positions), so the
bounds are lossless.  Equality keys would not do: at t = 0.85 a title of 60 characters may
lose every run of four, and segment or prefix keys let 45 % to 66 % of unrelated titles of the
test pages meet, the exact bag bounds 0.4 % and these signatures about 1 %.
"""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.text import explode_rows, normalize_title, url_netloc, url_path

# --- fixed values: thresholds --------------------------------------------------------------
TITLE_THRESHOLD = 0.85
URL_THRESHOLD = 0.8
BAG_GROUPS, BAG_CAP = 32, 16     # characters: positions of a count in unary
PAIR_BITS = 512                  # character pairs: one position for each occurrence
PAIR_BLOCK = 4_000               # rows of one host and length band that one block holds, about,
MAX_BLOCKS, MAX_BLOCK = 32, 200_000  # blocks of a band before they grow, and what they grow to
# -------------------------------------------------------------------------------------------


@F.pandas_udf(T.DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib ratio of two string columns (NULL treated as '')."""
    out = []
    for x, y in zip(a, b):
        sm = SequenceMatcher(None, x if isinstance(x, str) else "", y if isinstance(y, str) else "")
        out.append(sm.ratio())
    return pd.Series(out, dtype="float64")


def ratio_at_least(threshold: float):
    """UDF: the exact ratio when it can reach ``threshold``, else a value below it.

    difflib's ``real_quick_ratio`` and ``quick_ratio`` are upper bounds of ``ratio``; the
    expensive matching-block search only runs when both bounds pass (lossless).
    """
    @F.pandas_udf(T.DoubleType())
    def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            sm = SequenceMatcher(None, x if isinstance(x, str) else "", y if isinstance(y, str) else "")
            if sm.real_quick_ratio() < threshold or sm.quick_ratio() < threshold:
                out.append(-1.0)
            else:
                out.append(sm.ratio())
        return pd.Series(out, dtype="float64")
    return _ratio


def spread_for_udf(df: DataFrame) -> DataFrame:
    """Round-robin rows over all cores before a CPU-heavy Python UDF.

    Candidate pairs are small in bytes, so adaptive execution would coalesce them into very
    few tasks; an explicit repartition by number is kept as is.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def length_bound(la: Column, lb: Column, t: float) -> Column:
    """Upper bound of the ratio from lengths: 2 * min / (la + lb) >= t (two empties: 1)."""
    total = la + lb
    return (total == 0) | (F.least(la, lb) * 2.0 >= F.lit(t) * total)


def with_url_parts(df: DataFrame, url: str = "link") -> DataFrame:
    return (df.withColumn("netloc", url_netloc(F.col(url)))
            .withColumn("path", url_path(F.col(url))))


def similar_url_pairs(pairs: DataFrame, u1: str, u2: str, threshold: float = URL_THRESHOLD) -> DataFrame:
    """Adds ``similar_url``: same netloc and (same path or path ratio >= threshold).

    The ratio UDF only sees pairs with equal netlocs, unequal paths and a passing length bound.
    """
    p = (pairs.withColumn("_n1", url_netloc(F.col(u1))).withColumn("_n2", url_netloc(F.col(u2)))
         .withColumn("_p1", url_path(F.col(u1))).withColumn("_p2", url_path(F.col(u2))))
    need = (F.col("_n1") == F.col("_n2")) & (F.col("_p1") != F.col("_p2")) & length_bound(
        F.length("_p1"), F.length("_p2"), threshold)
    easy = p.filter(~need).withColumn(
        "similar_url", F.coalesce((F.col("_n1") == F.col("_n2")) & (F.col("_p1") == F.col("_p2")), F.lit(False)))
    hard = spread_for_udf(p.filter(need)).withColumn("similar_url", seq_ratio("_p1", "_p2") >= threshold)
    return easy.unionByName(hard).drop("_n1", "_n2", "_p1", "_p2")


def duplicate_groups(articles: DataFrame, key: str = "link", title: str = "title",
                     url: str = "link") -> DataFrame:
    """One row per article: its exact group (netloc, path, normalised title), the group's
    representative (smallest key) and the group size."""
    a = with_url_parts(articles.select(key, title, *([url] if url != key else [])), url).withColumn(
        "norm_title", normalize_title(F.col(title)))
    reps = a.groupBy("netloc", "path", "norm_title").agg(
        F.min(key).alias("representative"), F.count(F.lit(1)).cast("bigint").alias("group_size"))
    return a.join(reps, ["netloc", "path", "norm_title"]).select(
        key, "netloc", "path", "norm_title", "representative", "group_size")


def _band(length: Column, t: float) -> Column:
    """Length band index: lengths passing the bound fall in the same or adjacent bands."""
    r = (2.0 - t) / t
    return F.floor(F.log(F.greatest(length, F.lit(1)).cast("double")) / math.log(r)).cast("int")


BAG_WORDS = BAG_GROUPS * BAG_CAP // 64
PAIR_WORDS = PAIR_BITS // 64


@F.pandas_udf(T.ArrayType(T.LongType()))
def bag_signature(texts: pd.Series) -> pd.Series:
    """Bit sets of a string's characters (counts in unary) and of its character pairs (the first,
    second, ... occurrence of a pair each at a position of its own), as longs."""
    unary = np.tri(BAG_CAP + 1, BAG_CAP, -1, dtype=np.uint8)  # row c: c ones
    mix = np.uint64(0x9E3779B97F4A7C15)
    out = []
    for text in texts:
        codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        counts = np.bincount((codes * mix >> np.uint64(40)) % np.uint64(BAG_GROUPS), minlength=BAG_GROUPS)
        pairs = np.sort(codes[:-1] * np.uint64(1 << 21) + codes[1:])
        at = np.arange(len(pairs))
        fresh = np.ones(len(pairs), dtype=bool)
        fresh[1:] = pairs[1:] != pairs[:-1]
        nth = at - np.maximum.accumulate(np.where(fresh, at, 0))
        held = np.zeros(PAIR_BITS, dtype=np.uint8)
        held[((pairs * np.uint64(31) + nth.astype(np.uint64)) * mix >> np.uint64(40)) % np.uint64(PAIR_BITS)] = 1
        bits = np.concatenate([unary[np.minimum(counts, BAG_CAP)].ravel(), held])
        out.append(np.packbits(bits).view(np.int64))
    return pd.Series(out)


def representatives(articles: DataFrame, key: str, title: str, url: str) -> DataFrame:
    """One row per exact group: ``k, netloc, path, norm_title``, checkpointed to the shared folder."""
    a = with_url_parts(articles.select(key, title, *([url] if url != key else [])), url).withColumn(
        "norm_title", normalize_title(F.col(title)))
    reps = (a.groupBy("netloc", "path", "norm_title").agg(F.min(key).alias("k"))
            .select("k", "netloc", "path", "norm_title"))
    from tidewatch.session import checkpoint_dir
    checkpoint_dir(reps.sparkSession)
    # the row number is stored with the row, so it names the row for all later readers
    return reps.withColumn("row", F.monotonically_increasing_id()).checkpoint(eager=True)


def candidate_pairs(reps: DataFrame, title_threshold: float = TITLE_THRESHOLD,
                    url_threshold: float = URL_THRESHOLD, block: int = PAIR_BLOCK) -> DataFrame:
    """``(row_a, row_b)`` of representatives whose lengths and signatures leave both ratios possible.

    Each pair stands once.  The rows of a host and length band are dealt to blocks; two blocks of
    one band or of adjacent bands are a tile, and a tile is compared by one task.  A band of n
    rows has blocks of ``block`` rows, or larger ones up to ``MAX_BLOCK`` where there would be
    more than ``MAX_BLOCKS`` of them: each row is sent once to every block.
    """
    tl, pl = F.length("norm_title"), F.length("path")
    slim = reps.filter(F.col("netloc").isNotNull()).select(
        "row", "netloc", tl.alias("tl"), pl.alias("pl"), F.xxhash64("path").alias("ph"),
        F.concat(bag_signature("norm_title"), bag_signature("path")).alias("sig"))
    slim = slim.withColumn("band", F.when(F.col("tl") == 0, F.lit(-1)).otherwise(_band(F.col("tl"), title_threshold)))
    slim = slim.checkpoint(eager=True)
    n = F.count(F.lit(1))
    size = F.greatest(F.lit(block), F.least(F.ceil(n / MAX_BLOCKS), F.lit(MAX_BLOCK)))
    bands = slim.groupBy("netloc", "band").agg(F.ceil(n / size).cast("int").alias("blocks"))
    near = [bands.select("netloc", (F.col("band") - d).alias("band"), F.col("blocks").alias(name)) for d, name in ((1, "above"), (-1, "below"))]
    for other in near:
        bands = bands.join(other, ["netloc", "band"], "left")
    placed = slim.join(bands, ["netloc", "band"]).withColumn("at", F.pmod(F.hash("row"), F.col("blocks")))

    def each(count: str) -> Column:
        return F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(F.array().cast("array<int>"))

    def tile(low: Column, i: Column, high: Column, j: Column, side: int) -> Column:
        return F.struct(low.alias("low"), i.alias("i"), high.alias("high"), j.alias("j"), F.lit(side).alias("side"))

    band, at = F.col("band"), F.col("at")
    tiles = F.concat(
        F.transform(each("blocks"), lambda j: F.when(at <= j, tile(band, at, band, j, 0)).otherwise(tile(band, j, band, at, 1))),
        F.transform(each("above"), lambda j: tile(band, at, band + 1, j, 0)),
        F.transform(each("below"), lambda i: tile(band - 1, i, band, at, 1)))
    offered = (placed.select("netloc", "row", "tl", "pl", "ph", "sig", explode_rows(tiles).alias("t"))
               .select("netloc", "t.*", "row", "tl", "pl", "ph", "sig"))
    # tiles are small in bytes and long in work: a number of partitions that is kept as it is
    spark, key = reps.sparkSession, ["netloc", "low", "i", "high", "j"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return offered.repartition(parts, *key).groupBy(*key).applyInArrow(
        _compare_tile(title_threshold, url_threshold, BAG_WORDS, PAIR_WORDS), "row_a bigint, row_b bigint")


def _compare_tile(title_threshold: float, url_threshold: float, bag: int, pair: int):
    """The pairs of one tile that pass the length and signature bounds.

    Signatures are compared a strip of rows at a time, ordered by length, so what is held is
    bounded.  A nested function, so that workers need not have this package.
    """
    words = bag + pair

    def compare(table):
        import numpy as np
        import pyarrow as pa

        def rows(part):
            c = {n: part.column(n).to_numpy().astype(np.int64) for n in ("row", "tl", "pl", "ph")}
            sig = part.column("sig").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, 2 * words)
            order = np.argsort(c["tl"], kind="stable")
            return {n: v[order] for n, v in c.items()} | {"sig": np.ascontiguousarray(sig[order].T)}

        def unmatched(x, y, t):
            return (1.0 - t) * (x + y) + 1e-6

        def length_ok(x, y, t):
            return (x + y == 0) | (np.minimum(x, y) * 2.0 >= t * (x + y))

        def distance(i, j, lo, hi):
            return sum(np.bitwise_count(a["sig"][w][i] ^ b["sig"][w][j]).astype(np.int32) for w in range(lo, hi))

        side = table.column("side").to_numpy()
        own = table.column("low")[0].as_py() == table.column("high")[0].as_py() and table.column("i")[0].as_py() == table.column("j")[0].as_py()
        a = rows(table.filter(pa.array(side == 0)))
        b = a if own else rows(table.filter(pa.array(side == 1)))
        left, right, n = [], [], len(b["row"])
        step = max(1, (1 << 18) // max(n, 1))
        for lo in range(0, len(a["row"]) if n else 0, step):
            hi = min(lo + step, len(a["row"]))
            short, long = int(a["tl"][lo]), int(a["tl"][hi - 1])
            # a little wider than the length bound, which is checked below
            first = np.searchsorted(b["tl"], short * title_threshold / (2 - title_threshold) - 1)
            end = np.searchsorted(b["tl"], long * (2 - title_threshold) / title_threshold + 1, side="right")
            if own:
                first = max(first, lo + 1)
            if first >= end:
                continue
            held = np.zeros((hi - lo, end - first), dtype=np.uint16)
            for w in range(bag, words):
                held += np.bitwise_count(a["sig"][w][lo:hi, None] ^ b["sig"][w][None, first:end])
            limit = np.floor(3 * unmatched(long, b["tl"][first:end], title_threshold)).astype(np.int64).clip(0, 65535).astype(np.uint16)
            i, j = np.nonzero(held <= limit[None, :])
            near = held[i, j]
            i, j = i + lo, j + first
            ta, tb = a["tl"][i], b["tl"][j]
            gap = unmatched(ta, tb, title_threshold)
            keep = length_ok(ta, tb, title_threshold) & (near <= 3 * gap) & ((i < j) | (not own))
            i, j, gap = i[keep], j[keep], gap[keep]
            keep = distance(i, j, 0, bag) <= gap
            i, j = i[keep], j[keep]
            pa_, pb = a["pl"][i], b["pl"][j]
            gap = unmatched(pa_, pb, url_threshold)
            keep = (a["ph"][i] == b["ph"][j]) | (length_ok(pa_, pb, url_threshold)
                                                 & (distance(i, j, words, words + bag) <= gap)
                                                 & (distance(i, j, words + bag, 2 * words) <= 3 * gap))
            left.append(a["row"][i[keep]])
            right.append(b["row"][j[keep]])
        x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (left, right))
        return pa.table({"row_a": np.minimum(x, y), "row_b": np.maximum(x, y)})

    return compare


def duplicate_pairs(articles: DataFrame, key: str = "link", title: str = "title", url: str = "link",
                    title_threshold: float = TITLE_THRESHOLD,
                    url_threshold: float = URL_THRESHOLD) -> DataFrame:
    """Near-duplicate pairs between exact-group representatives: (key_a, key_b, title_ratio)."""
    reps = representatives(articles, key, title, url)
    pairs = candidate_pairs(reps, title_threshold, url_threshold)
    for side in ("_x", "_y"):
        text = reps.select("row", *[F.col(c).alias(c + side) for c in ("k", "path", "norm_title")])
        pairs = pairs.join(text.withColumnRenamed("row", "row_a" if side == "_x" else "row_b"),
                           "row_a" if side == "_x" else "row_b")
    first = (F.struct("norm_title_x", "path_x", "k_x") < F.struct("norm_title_y", "path_y", "k_y"))
    cand = pairs.select(*[F.when(first, F.col(c + near)).otherwise(F.col(c + far)).alias(c + side)
                          for side, near, far in (("_a", "_x", "_y"), ("_b", "_y", "_x"))
                          for c in ("k", "path", "norm_title")])
    scored = (spread_for_udf(cand)
              .withColumn("title_ratio", ratio_at_least(title_threshold)("norm_title_a", "norm_title_b"))
              .filter(F.col("title_ratio") >= title_threshold))
    # survivors are few: one pass computes the path ratio where the paths differ
    path_ok = (F.col("path_a") == F.col("path_b")) | (
        ratio_at_least(url_threshold)("path_a", "path_b") >= url_threshold)
    return scored.filter(path_ok).select(
        F.col("k_a").alias(f"{key}_a"), F.col("k_b").alias(f"{key}_b"),
        F.round("title_ratio", 6).alias("title_ratio"))


def duplicate_flag(pairs: DataFrame, t1: str, u1: str, t2: str, u2: str,
                   title_threshold: float = TITLE_THRESHOLD,
                   url_threshold: float = URL_THRESHOLD) -> DataFrame:
    """Adds ``is_duplicate`` for given pairs of (title, url): title ratio of the normalised
    titles >= threshold and similar URLs.  The ratio UDF runs only where the length bound
    passes."""
    p = (pairs.withColumn("_a", normalize_title(F.col(t1))).withColumn("_b", normalize_title(F.col(t2))))
    maybe = length_bound(F.length("_a"), F.length("_b"), title_threshold)
    no = p.filter(~maybe).withColumn("is_duplicate", F.lit(False))
    yes = spread_for_udf(p.filter(maybe)).withColumn("_r", seq_ratio("_a", "_b"))
    close = similar_url_pairs(yes.filter(F.col("_r") >= title_threshold), u1, u2, url_threshold) \
        .withColumn("is_duplicate", F.col("similar_url")).drop("similar_url", "_r")
    far = yes.filter(~(F.col("_r") >= title_threshold)).withColumn("is_duplicate", F.lit(False)).drop("_r")
    return no.unionByName(far).unionByName(close).drop("_a", "_b")

"""Secret scans: base patterns, and sliding-window Shannon entropy per character class.

Base spans are the matches of three patterns (``BASE``).  A match is found leftmost and
non-overlapping per kind; matches that are too short are dropped after they were found, so
they still use up their text.

The method adds spans.  A candidate of a character class is a maximal run of its characters
that is long enough for one window.  A window of the class's width slides over the candidate;
entering and leaving characters change their counts and the sum of ``c log2 c`` by one term
each, so a step costs the same at any window width.  A window is secret-like when its entropy
reaches the class's least bits and it mixes the character kinds that the class asks for;
windows that overlap or touch make one span.  The sum is kept in whole millionths, so the
threshold is exact in any order of evaluation.

The allow-list suppresses candidates that are known not to be secrets: by the candidate's own
text (UUIDs, placeholders, alphabets, paths) or by the characters before it, back to the
candidate before (checksum and commit labels).  It never touches base spans.

Only DataFrame functions are used, in one narrow projection: no row moves.  Spark gives the
texts of all matches but not their places, so places are running totals over the lengths of
the pieces between the matches and of the matches themselves.  All of it is linear in the text
but for the running totals, which take ``TOTAL_BLOCK`` steps per match.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL_BLOCK = 256
CONTEXT = 16  # characters before a candidate that the allow-list reads


@dataclass(frozen=True)
class CharClass:
    kind: str
    chars: str       # inside of a regex character class
    window: int
    least_bits: float
    mixed_case: bool  # a window needs an upper and a lower-case letter; all need a letter and a digit

    @property
    def limit(self) -> int:
        """Largest sum of ``c log2 c``, in millionths, of a window that has the least bits."""
        return math.floor((math.log2(self.window) - self.least_bits) * self.window * 1_000_000)


# --- fixed values: base kinds in order, classes, allow-list -------------------------------
# kind, pattern, group whose length counts, least length; the letters of assign's first
# group match in either case
BASE = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
]
CLASSES = (
    CharClass("entropy_hex", "0-9A-Fa-f", 16, 2.6, False),
    CharClass("entropy_alnum", "0-9A-Za-z", 20, 3.5, False),
    CharClass("entropy_base64", "0-9A-Za-z+/_-", 24, 3.9, True),
)
ALLOWED = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",  # UUID
    r"[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Cc][Hh][Aa][Nn][Gg][Ee][Mm][Ee]|[Xx]{4}",
    r"0123456789|[Aa][Bb][Cc][Dd][Ee][Ff][Gg][Hh]",
    r"(/[0-9A-Za-z_-]+){3}",  # paths
)
ALLOWED_BEFORE = (
    r"([Ss][Hh][Aa]-?(1|224|256|384|512)|[Mm][Dd]5|[Cc]ommit|[Ee][Tt]ag)[\"':= -]*$",
)
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-"
FIRST_UPPER, FIRST_LOWER, FIRST_OTHER = 10, 36, 62
# ------------------------------------------------------------------------------------------


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_total(values: Column) -> Column:
    """Sums of the first 1, 2, ... numbers of a non-empty array: totals of blocks, then within them."""
    def grow(sums: Column, x: Column) -> Column:
        return F.concat(sums, F.array(F.element_at(sums, -1) + x))

    def block(v: Column, b: Column) -> Column:
        return F.slice(v, b * TOTAL_BLOCK + 1, TOTAL_BLOCK)

    def totals(v: Column) -> Column:
        at = F.sequence(F.lit(0), ((F.size(v) - 1) / TOTAL_BLOCK).cast("int"))
        sums = F.transform(at, lambda b: F.aggregate(block(v, b), F.lit(0), lambda a, x: a + x))
        before = F.slice(F.aggregate(sums, F.array(F.lit(0)), grow), F.lit(1), F.size(sums))
        return F.flatten(F.zip_with(at, before, lambda b, start: F.slice(
            F.aggregate(block(v, b), F.array(start), grow), 2, TOTAL_BLOCK)))

    return let(values, totals)


SPAN = "array<struct<start:int,end:int,found:string,part:string,before:string>>"


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches as ``SPAN``: place in code points, the whole match,
    one of its groups and the characters before it, back to the match before.

    The pattern must not match the empty text.
    """
    def located(found: Column) -> Column:
        def with_pieces(pieces: Column) -> Column:
            ends = running_total(F.slice(F.zip_with(pieces, found, lambda p, m: F.length(p) + F.length(m)),
                                         F.lit(1), F.size(found)))

            def with_ends(end: Column) -> Column:
                def rows(parts: Column) -> Column:
                    return F.transform(found, lambda m, i: F.struct(
                        (F.get(end, i) - F.length(m)).alias("start"), F.get(end, i).alias("end"), m.alias("found"),
                        F.get(parts, i).alias("part"), F.right(F.get(pieces, i), F.lit(CONTEXT)).alias("before")))

                return rows(found) if group == 0 else let(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), rows)

            return let(ends, with_ends)

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), with_pieces)).otherwise(
            F.array().cast(SPAN))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)


def base_pattern(kind: str, pattern: str, least: int) -> str:
    """The pattern as searched: positions where no long enough match can start are left early.

    The runs of ``access`` and ``hex`` hold nothing that another match of their kind could
    use, so their least length may stand in the pattern; that of ``assign`` may not.
    """
    if kind == "assign":
        return "(?=[PpSsTtAa])(?i)" + pattern  # the value's letters stand in both cases anyway
    if kind == "access":
        return f"AKIA[A-Z0-9]{{{least - 4},}}+"
    return f"[0-9a-f]{{{least},}}+"


def allowed(run: Column, patterns: tuple[str, ...], before_patterns: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for p in patterns:
        hit = hit | run["found"].rlike(p)
    for p in before_patterns:
        hit = hit | run["before"].rlike(p)
    return hit


def secret_windows(run: Column, cls: CharClass) -> Column:
    """``array<struct<start,end>>`` of a candidate: its windows that reach the least bits, joined."""
    w = cls.window
    # c log2 c in millionths for every count that a window can hold
    terms = F.array(*[F.lit(round(c * math.log2(c) * 1_000_000) if c else 0).cast("long") for c in range(w + 2)])
    codes = F.transform(F.split(run["found"], "", -1), lambda c: F.position(c, F.lit(ALPHABET)) - 1)

    def term(c: Column) -> Column:
        return F.get(terms, c)

    def slide(codes: Column) -> Column:
        zero = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0).cast("long").alias("sum"),
            F.lit(0).alias("digits"), F.lit(0).alias("uppers"), F.lit(0).alias("lowers"),
            F.lit(-1).alias("start"), F.lit(-1).alias("end"),
            F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

        def between(code: Column, lo: int, hi: int) -> Column:
            return ((code >= lo) & (code < hi)).cast("int")

        def change(enter: Column, leave: Column, lo: int, hi: int) -> Column:
            return between(enter, lo, hi) - between(leave, lo, hi)

        def step(acc: Column, i: Column) -> Column:
            enter, leave = F.get(codes, i), F.coalesce(F.get(codes, i - w), F.lit(-1))
            old = F.get(acc["counts"], F.greatest(leave, F.lit(0)))
            held = F.get(acc["counts"], enter) - (enter == leave).cast("int")
            total = (acc["sum"] - F.when(leave >= 0, term(old) - term(old - 1)).otherwise(0)
                     + term(held + 1) - term(held))
            moved = F.struct(
                F.transform(acc["counts"], lambda c, k: c + (k == enter).cast("int") - (k == leave).cast("int")).alias("counts"),
                total.alias("sum"),
                (acc["digits"] + change(enter, leave, 0, FIRST_UPPER)).alias("digits"),
                (acc["uppers"] + change(enter, leave, FIRST_UPPER, FIRST_LOWER)).alias("uppers"),
                (acc["lowers"] + change(enter, leave, FIRST_LOWER, FIRST_OTHER)).alias("lowers"))

            def judged(now: Column) -> Column:
                letters = ((now["uppers"] > 0) & (now["lowers"] > 0)) if cls.mixed_case else (now["uppers"] + now["lowers"] > 0)
                secret = (i >= w - 1) & (now["sum"] <= cls.limit) & (now["digits"] > 0) & letters
                first = i - (w - 1)
                fresh = secret & (first > acc["end"])  # a new span; the open one is complete
                return F.struct(
                    now["counts"].alias("counts"), now["sum"].alias("sum"), now["digits"].alias("digits"),
                    now["uppers"].alias("uppers"), now["lowers"].alias("lowers"),
                    F.when(fresh, first).otherwise(acc["start"]).alias("start"),
                    F.when(secret, i + 1).otherwise(acc["end"]).alias("end"),
                    F.when(fresh & (acc["end"] >= 0), F.concat(acc["spans"], F.array(
                        F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))).otherwise(acc["spans"]).alias("spans"))

            return let(moved, judged)

        def finish(acc: Column) -> Column:
            return F.when(acc["end"] >= 0, F.concat(acc["spans"], F.array(
                F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))).otherwise(acc["spans"])

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, step, finish)

    return F.transform(let(codes, slide), lambda s: F.struct(
        (s["start"] + run["start"]).alias("start"), (s["end"] + run["start"]).alias("end")))


def base_spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    return F.filter(matches(text, base_pattern(kind, pattern, least), group), lambda m: F.length(m["part"]) >= least)


def entropy_spans(text: Column, cls: CharClass, patterns: tuple[str, ...], before_patterns: tuple[str, ...]) -> Column:
    runs = F.filter(matches(text, f"(?<![{cls.chars}])[{cls.chars}]{{{cls.window},}}"),
                    lambda m: m["found"].rlike("[0-9]") & ~allowed(m, patterns, before_patterns))
    return F.flatten(F.transform(runs, lambda m: secret_windows(m, cls)))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOWED,
                 allow_before: tuple[str, ...] = ALLOWED_BEFORE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``found``, all spans as
    ``array<struct<start, rank, end, kind>>`` by start, then kind (base kinds, then classes).

    Places are code points of the whole text, the end is exclusive; the span of an assignment
    is the whole match.  A null or empty text has no spans.  Null ids and repeated rows each
    keep their row; other input columns are ignored.
    """
    text = F.col("t")
    kinds = [(kind, base_spans(text, kind, pattern, group, least)) for kind, pattern, group, least in BASE]
    kinds += [(c.kind, entropy_spans(text, c, allow, allow_before)) for c in classes]

    def listed(rank: int, kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    return rows.select("doc_id", F.array_sort(F.concat(
        *[listed(rank, kind, spans) for rank, (kind, spans) in enumerate(kinds)])).alias("found"))


def digest(scanned: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of scanned rows."""
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def n(rank: int) -> Column:
        return F.size(F.filter("found", lambda s: s["rank"] == rank)).cast("long")

    return scanned.select(
        "doc_id", *[n(rank).alias(f"n_{kind}") for rank, (kind, *_) in enumerate(BASE)],
        F.sha2(joined(F.filter("found", lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"))

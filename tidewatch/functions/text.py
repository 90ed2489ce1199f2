"""Text, URL and date expressions with one shared definition of character classes.

Three regex engines meet in this project (Python semantics we must reproduce, Java regex
inside Spark, RE2 inside the DuckDB oracle).  Their ``\\b``, ``\\w``, ``\\s`` and ``trim``
differ, so every pattern here is spelled with explicit classes.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: character classes -------------------------------------------------
# Word characters (Python's str-pattern \w): letters, numbers, underscore.
WORD_CLASS = r"[\p{L}\p{N}_]"
NON_WORD_CLASS = r"[^\p{L}\p{N}_]"
# Python's str.isspace() set, written for Java regex.
# Spelled without \s so that Java regex and RE2 read it identically.
SPACE_CHARS = (r"\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
               r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
SPACE_CLASS = "[" + SPACE_CHARS + "]"
# Characters that Python's IGNORECASE treats as equal to an ASCII letter: long s, dotless i,
# dotted capital I, Kelvin sign.  They are folded before comparing with ASCII keywords.
CASE_EXTRA_FROM = "ſıİK"
CASE_EXTRA_TO = "siik"
# Token characters of the full-text tokenizer (letters, numbers, private use).
TOKEN_PATTERN = r"[\p{L}\p{N}\p{Co}]+"
# RFC 3986 appendix B, used for netloc / path extraction.
URL_PARTS_PATTERN = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"
# Python 3 urlsplit: tab / CR / LF are removed, leading C0 controls and space stripped.
URL_REMOVE_PATTERN = r"[\t\r\n]"
URL_LEADING_PATTERN = r"^[\x{00}-\x{20}]+"
# brackets in the host only around an address
VALID_URL_PATTERN = (r"^[A-Za-z][A-Za-z0-9+.-]*://"
                     r"([^/?#\[\]]+|[^/?#\[\]]*\[[0-9A-Fa-f:.]+\][^/?#\[\]]*)([/?#]|$)")
# urlsplit: optional scheme (letter first, then letters/digits/+-.), optional //netloc, path.
URL_SPLIT_PATTERN = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"
# ---------------------------------------------------------------------------------------


def _diacritic_table() -> tuple[str, str]:
    """Map accented Latin letters to their base letter, derived from Unicode decomposition.

    Covers Latin-1 Supplement through Latin Extended Additional; a character is folded
    when its canonical decomposition is an ASCII letter followed by combining marks only.
    """
    src, dst = [], []
    for cp in list(range(0x00C0, 0x0250)) + list(range(0x1E00, 0x1F00)):
        ch = chr(cp)
        d = unicodedata.normalize("NFD", ch)
        if len(d) > 1 and d[0].isascii() and d[0].isalpha() and all(
                unicodedata.category(c) == "Mn" for c in d[1:]):
            src.append(ch)
            dst.append(d[0])
    return "".join(src), "".join(dst)


DIACRITIC_FROM, DIACRITIC_TO = _diacritic_table()


def strip_py(col: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(col, "^" + SPACE_CLASS + "+|" + SPACE_CLASS + "+$", "")


def collapse_spaces(col: Column) -> Column:
    return strip_py(F.regexp_replace(col, SPACE_CLASS + "+", " "))


def normalize_title(col: Column) -> Column:
    """lower -> collapse whitespace -> drop chars not word/space/hyphen -> collapse again."""
    t = collapse_spaces(F.lower(col))
    t = F.regexp_replace(t, r"[^\p{L}\p{N}_" + SPACE_CHARS + r"\-]", "")
    t = collapse_spaces(t)
    return F.coalesce(t, F.lit(""))


def clean_url(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(col, URL_REMOVE_PATTERN, ""), URL_LEADING_PATTERN, "")


def valid_url(col: Column) -> Column:
    """Scheme and netloc both present (urlparse semantics); NULL or empty -> False."""
    return F.coalesce(clean_url(col).rlike(VALID_URL_PATTERN), F.lit(False))


def url_netloc(col: Column) -> Column:
    """Network location (case kept): text after '//' that follows an optional valid scheme."""
    return F.regexp_extract(clean_url(col), URL_SPLIT_PATTERN, 2)


def url_path(col: Column) -> Column:
    """Path without query, fragment and the ';params' of the last segment."""
    return F.regexp_replace(F.regexp_extract(clean_url(col), URL_SPLIT_PATTERN, 3), r";[^/]*$", "")


def host_of(url: Column, fallback: Column) -> Column:
    """Lower-cased netloc of the URL, else the fallback (source name)."""
    return F.coalesce(F.nullif(F.lower(url_netloc(url)), F.lit("")), fallback)


def fts_fold(col: Column) -> Column:
    """Full-text folding: remove Latin diacritics, then lower-case."""
    return F.lower(F.translate(col, DIACRITIC_FROM, DIACRITIC_TO))


def fts_tokens(col: Column) -> Column:
    """Array of full-text tokens of a column (NULL -> empty array)."""
    return F.coalesce(F.regexp_extract_all(fts_fold(col), F.lit(TOKEN_PATTERN), 0),
                      F.array().cast("array<string>"))


def join_non_empty(parts: list[Column], sep: str = ". ", default: str | None = None) -> Column:
    """``sep.join(p for p in parts if p)`` with an optional default for the empty result."""
    arr = F.filter(F.array(*[F.coalesce(p, F.lit("")) for p in parts]), lambda x: x != "")
    joined = F.array_join(arr, sep)
    if default is None:
        return joined
    return F.when(F.size(arr) > 0, joined).otherwise(F.lit(default))


def first_line(col: Column) -> Column:
    return F.substring_index(col, "\n", 1)


def parse_iso_datetime(col: Column) -> Column:
    """ISO-8601 text (``Z`` or offset allowed) -> naive UTC timestamp; blank/invalid -> NULL."""
    t = F.trim(col)
    return F.when(t == "", F.lit(None)).otherwise(
        F.try_to_timestamp(t).cast("timestamp_ntz"))


def parse_unix_timestamp(col: Column) -> Column:
    """Integer seconds (as text or number) -> naive UTC timestamp; invalid -> NULL."""
    secs = col.cast("string").try_cast("bigint")
    return F.timestamp_seconds(secs).cast("timestamp_ntz")


def parse_feed_date(col: Column) -> Column:
    """RFC 822 feed dates ('Tue, 10 Mar 2026 09:00:00 GMT' / '+0900') -> naive UTC.

    The weekday is removed first: pattern letter 'E' cannot be used for parsing.
    A missing zone means UTC; ISO text is accepted as a last resort.
    """
    t = F.regexp_replace(F.trim(col), r"^[A-Za-z]{3},\s*", "")
    t = F.regexp_replace(t, r"\s+(GMT|UT|UTC|Z)$", " +0000")
    parsed = F.coalesce(
        F.try_to_timestamp(t, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(t, F.lit("d MMM yyyy HH:mm Z")),
        F.try_to_timestamp(t, F.lit("d MMM yyyy HH:mm:ss")),
        F.try_to_timestamp(t, F.lit("d MMM yyyy HH:mm")),
        F.try_to_timestamp(F.trim(col)),
    )
    return parsed.cast("timestamp_ntz")


def explode_rows(col: Column) -> Column:
    """``explode_outer`` for derived arrays/maps; follow with a not-null filter on the output.

    Plain ``explode`` makes the optimizer infer ``size(arr) > 0`` and push it below the
    projections that compute ``arr``, re-evaluating the whole expression in the scan filter.
    """
    return F.explode_outer(col)


def utc_naive(col: Column) -> Column:
    """Aware time (TIMESTAMP, or text with an offset) -> naive UTC TIMESTAMP_NTZ.

    Relies on the session time zone being UTC (set by ``build_session``).
    """
    return col.try_cast("timestamp").cast("timestamp_ntz")

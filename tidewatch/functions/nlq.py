"""Natural-language search queries: time window, result limit, remaining text.

Two rules, applied in turn.  A rule is one pattern whose alternatives start with different
characters, so its leftmost match is the earliest of all its phrases.  What a rule matches
is cut out of the text before the next rule reads it; at the end white space is collapsed.
The category is always NULL.

``nl_parse`` works on a column (three regex nodes per rule, no UDF), ``parse_query`` on one
string on the driver; both are made from the same phrase table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions.text import SPACE_CLASS, WORD_CLASS, collapse_spaces, strip_py

# --- fixed values: phrases and the days of a unit ---------------------------------------
KO_SINCE = ("최근", "지난")
KO_UNIT_DAYS = {"일": 1, "주": 7, "개월": 30}
EN_SINCE = "last"
EN_UNIT_DAYS = {"day": 1, "days": 1, "week": 7, "weeks": 7, "month": 30, "months": 30}
KO_COUNT = "개"
EN_COUNT = "top"
# -----------------------------------------------------------------------------------------


class Dialect(NamedTuple):
    """How an engine writes white space, a digit run and the edges of a word."""
    space: str
    number: str
    word_start: str
    word_end: str


PYTHON = Dialect(r"\s", r"(\d+)", r"\b", r"\b")
JAVA = Dialect(SPACE_CLASS, r"(\p{Nd}+)", f"(?<!{WORD_CLASS})", f"(?!{WORD_CLASS})")


def _any(words) -> str:
    return "(" + "|".join(sorted(words, key=len, reverse=True)) + ")"


def time_rule(d: Dialect) -> str:
    """Groups: number and unit of the Korean phrase, number and unit of the English one."""
    korean = f"(?:{'|'.join(KO_SINCE)}){d.space}*{d.number}{d.space}*{_any(KO_UNIT_DAYS)}"
    english = f"{d.word_start}{EN_SINCE}{d.space}+{d.number}{d.space}*{_any(EN_UNIT_DAYS)}{d.word_end}"
    return f"{korean}|(?i:{english})"


def limit_rule(d: Dialect) -> str:
    """Groups: number of the Korean phrase, number of the English one."""
    return f"{d.number}{d.space}*{KO_COUNT}{d.word_end}|(?i:{d.word_start}{EN_COUNT}{d.space}+{d.number}{d.word_end})"


@dataclass(frozen=True)
class ParsedQuery:
    search_text: str
    days: int | None
    limit: int | None
    category: str | None = None


_PY_TIME, _PY_LIMIT = re.compile(time_rule(PYTHON)), re.compile(limit_rule(PYTHON))


def _split_once(rule: re.Pattern, text: str) -> tuple[list[str], str]:
    """The groups that took part in the rule's first match, and the text around it."""
    before, *groups, after = rule.split(text, maxsplit=1) if rule.search(text) else (text, "")
    return [g for g in groups if g], " ".join(f"{before} {after}".split())


def parse_query(raw: str) -> ParsedQuery:
    window, text = _split_once(_PY_TIME, raw)
    count, text = _split_once(_PY_LIMIT, text)
    days = int(window[0]) * (KO_UNIT_DAYS | EN_UNIT_DAYS)[window[1].lower()] if window else None
    return ParsedQuery(text, days, int(count[0]) if count else None)


def _without_first(text: Column, rule: str, groups: int) -> Column:
    return F.regexp_replace(text, f"(?s)^(.*?)(?:{rule})(.*)$", f"$1 ${groups + 2}")


def _number(text: Column, rule: str, groups: tuple[int, ...]) -> Column:
    """The number of whichever phrase matched first; NULL without a match."""
    return F.concat(*[F.regexp_extract(text, rule, g) for g in groups]).try_cast("bigint")


def nl_parse(raw: Column) -> Column:
    """struct<search_text, days, limit, category> for a column of query texts."""
    text, time, limit = strip_py(raw), time_rule(JAVA), limit_rule(JAVA)
    unit = F.lower(F.concat(F.regexp_extract(text, time, 2), F.regexp_extract(text, time, 4)))
    per_unit = F.element_at(F.create_map(*[F.lit(v) for kv in (KO_UNIT_DAYS | EN_UNIT_DAYS).items() for v in kv]),
                            F.nullif(unit, F.lit("")))
    rest = _without_first(text, time, 4)
    return F.struct(collapse_spaces(_without_first(rest, limit, 2)).alias("search_text"),
                    (_number(text, time, (1, 3)) * per_unit).alias("days"),
                    _number(rest, limit, (1, 2)).alias("limit"),
                    F.lit(None).cast("string").alias("category"))

"""Matched-entity map <-> JSON text at storage and log edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY_MAP = "map<string,array<string>>"


def encode_entities(col: Column) -> Column:
    """map<string, array<string>> -> JSON object text (non-ASCII kept as is)."""
    return F.to_json(F.coalesce(col, F.create_map().cast(EMPTY_MAP)))


def decode_entities(col: Column) -> Column:
    """Tolerant JSON -> map<string, array<string>>.

    Values that are not JSON lists are skipped (a string that merely looks like a list too),
    list elements become strings, malformed JSON or a non-object document gives an empty
    map.  Values are parsed as VARIANT so that the list test is exact.
    """
    outer = F.from_json(col, "map<string,variant>")
    lists = F.transform_values(outer, lambda _, v: F.when(
        F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<string>")))
    kept = F.map_filter(lists, lambda _, v: v.isNotNull())
    return F.coalesce(kept, F.create_map().cast(EMPTY_MAP))

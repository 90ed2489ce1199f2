"""Read-only SQL over registered tables.

A query is let through if its first word is one of ``FIRST_WORDS``; if it parses as a
subquery, where statements that write or define are syntax errors; if it reads plain
one-part names only (views and common table expressions, no file paths and no other
catalogs); and if its analysed plan calls no JVM method by reflection.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

# --- fixed values --------------------------------------------------------------------------
FIRST_WORDS = ("select", "with", "explain")
REFUSED = "Only SELECT/WITH/EXPLAIN queries are allowed."
# ---------------------------------------------------------------------------------------------
REFLECTION = "CallMethodViaReflection"


class ReadOnlyViolation(ValueError):
    pass


def _nodes(plan) -> list[dict]:
    """All nodes and expressions of a logical plan, nested plans included."""
    found, todo = [], [json.loads(plan.toJSON())]
    while todo:
        item = todo.pop()
        if isinstance(item, dict):
            found.append(item)
            todo.extend(item.values())
        elif isinstance(item, list):
            todo.extend(item)
    return found


def read_only_sql(spark: SparkSession, query: str) -> DataFrame:
    body = query.strip().rstrip(";")
    first, _, rest = body.partition(" ") if not body[:7].lower().startswith("explain") else (body[:7], "", body[7:])
    word = first.split()[0].lower() if first.split() else ""
    if word not in FIRST_WORDS:
        raise ReadOnlyViolation(REFUSED)
    checked = spark.sql(f"SELECT * FROM (\n{rest.strip() if word == 'explain' else body}\n) AS _checked")  # analysis only
    execution = checked._jdf.queryExecution()
    for node in _nodes(execution.logical()):
        if str(node.get("class", "")).endswith(".UnresolvedRelation"):
            name = node.get("multipartIdentifier")
            if len(name if isinstance(name, list) else str(name).strip("[]").split(",")) != 1:
                raise ReadOnlyViolation(f"only registered views can be read, not {name}")
    if REFLECTION in execution.analyzed().toJSON():
        raise ReadOnlyViolation("calls of JVM methods are not allowed")
    return spark.sql(body)

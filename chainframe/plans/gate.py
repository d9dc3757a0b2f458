"""Checks of SQL text for derived tables, on the plans that Spark itself makes of it."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import SparkSession

#: Error codes of the admin contract and their HTTP status.
CODES = {
    "NON_INCREMENTAL_QUERY": 400,
    "INVALID_TABLE_SQL": 400,
    "UNQUALIFIED_TABLE": 400,
    "CATALOG_QUALIFIED_TABLE": 400,
    "TABLE_NOT_FOUND_IN_DATASET": 404,
    "EMPTY_TABLES_AND_FUNCTIONS": 400,
    "INVALID_TABLE_NAME": 400,
    "CATALOG_QUALIFIED_FUNCTION": 400,
    "DEPENDENCY_ALIAS_NOT_FOUND": 400,
    "FUNCTION_NOT_FOUND_IN_DATASET": 404,
    "INVALID_DEPENDENCY_ALIAS_FOR_FUNCTION_REF": 400,
}
#: Names that SQL takes without quotes.
IDENTIFIER = re.compile("[A-Za-z_][A-Za-z0-9_]*")
#: Operators of Catalyst that need more than the new rows of a block, and what they are in SQL.
NEEDS_ALL = {
    "GlobalLimit": "LIMIT",
    "LocalLimit": "LIMIT",
    "Offset": "OFFSET",
    "Sort": "ORDER BY",
    "Aggregate": "GROUP BY",
    "Distinct": "DISTINCT",
    "Deduplicate": "DISTINCT",
    "Window": "WINDOW",
    "Intersect": "INTERSECT",
    "Except": "EXCEPT",
}
OUTER = ("LeftOuter", "RightOuter", "FullOuter")


def _nodes(plan) -> Iterable:
    """Every operator of a plan, those of subqueries too."""
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        yield node
        for more in (node.children(), node.subqueries()):
            waiting += [more.apply(i) for i in range(more.size())]
        if node.nodeName() in ("UnresolvedWith", "SubqueryAlias", "View"):
            waiting += [node.innerChildren().apply(i) for i in range(node.innerChildren().size()) if hasattr(node.innerChildren().apply(i), "nodeName")]


def parsed(spark: SparkSession, sql: str):
    return spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)


def tables_in(spark: SparkSession, sql: str) -> list[list[str]]:
    """The name parts of the tables that a query reads."""
    found = []
    for node in _nodes(parsed(spark, sql)):
        if node.nodeName() == "UnresolvedRelation":
            parts = node.multipartIdentifier()
            found.append([parts.apply(i) for i in range(parts.size())])
    return sorted(found)


def functions_in(spark: SparkSession, sql: str) -> list[list[str]]:
    """The name parts of the functions that a query calls."""
    found, waiting = [], []
    for node in _nodes(parsed(spark, sql)):
        expressions = node.expressions()
        waiting += [expressions.apply(i) for i in range(expressions.size())]
    while waiting:
        expression = waiting.pop()
        more = expression.children()
        waiting += [more.apply(i) for i in range(more.size())]
        if expression.getClass().getSimpleName() == "UnresolvedFunction":
            parts = expression.nameParts()
            found.append([parts.apply(i) for i in range(parts.size())])
    return sorted(found)


def check_functions(spark: SparkSession, sql: str, known: Mapping[str, Iterable[str]]) -> str | None:
    """The error code of the functions that a query calls, or None. known: functions by dataset alias; names without an alias are Spark's own."""
    for parts in functions_in(spark, sql):
        if len(parts) > 2:
            return "CATALOG_QUALIFIED_FUNCTION"
        if len(parts) == 2:
            if not IDENTIFIER.fullmatch(parts[0]):
                return "INVALID_DEPENDENCY_ALIAS_FOR_FUNCTION_REF"
            if parts[0] not in known:
                return "DEPENDENCY_ALIAS_NOT_FOUND"
            if parts[1] not in known[parts[0]]:
                return "FUNCTION_NOT_FOUND_IN_DATASET"
    return None


def needs_all(spark: SparkSession, sql: str) -> list[str]:
    """What keeps a query from running on new rows alone (empty: it may)."""
    found = set()
    for node in _nodes(spark.sql(sql)._jdf.queryExecution().analyzed()):
        name = node.nodeName()
        if name in NEEDS_ALL:
            found.add(NEEDS_ALL[name])
        if name == "Join" and node.joinType().toString() in OUTER:
            found.add("OUTER JOIN")
    return sorted(found)


def check(spark: SparkSession, sql: str, known: Mapping[str, Iterable[str]] | None = None, functions: Mapping[str, Iterable[str]] | None = None) -> str | None:
    """The error code of a derived table's SQL, or None. known, functions: tables and functions by dataset alias; by default names are not looked up."""
    try:
        names = tables_in(spark, sql)
    except ParseException:
        return "INVALID_TABLE_SQL"
    for parts in names:
        if len(parts) == 1:
            return "UNQUALIFIED_TABLE"
        if len(parts) > 2:
            return "CATALOG_QUALIFIED_TABLE"
        if known is not None and parts[1] not in known.get(parts[0], ()):
            return "TABLE_NOT_FOUND_IN_DATASET"
    if functions is not None and (wrong := check_functions(spark, sql, functions)):
        return wrong
    try:
        return "NON_INCREMENTAL_QUERY" if needs_all(spark, sql) else None
    except AnalysisException:
        return "INVALID_TABLE_SQL"


def check_all(spark: SparkSession, tables: Mapping[str, str], functions: Mapping[str, object] | None = None, known=None, callable_=None) -> dict[str, str | None]:
    """The codes of each table of a request; a request without tables and functions has one for itself. functions: those it defines;
    known, callable_: tables and functions of its dependencies, by alias."""
    if not tables and not functions:
        return {"": "EMPTY_TABLES_AND_FUNCTIONS"}
    return {name: check(spark, sql, known, callable_) if IDENTIFIER.fullmatch(name) else "INVALID_TABLE_NAME" for name, sql in tables.items()}


def output_schema(spark: SparkSession, tables: Mapping[str, str]) -> dict[str, str]:
    """The schema that each table's SQL gives, as DDL; nothing runs."""
    return {name: spark.sql(sql).schema.simpleString() for name, sql in tables.items()}

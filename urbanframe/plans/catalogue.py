"""All registered queries of the library and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from urbanframe.plans import q_audit, q_indicators, q_more, q_places, q_reports, q_shapes, q_tables, q_timetable

MODULES = (q_timetable, q_indicators, q_more, q_places, q_audit, q_tables, q_reports, q_shapes, q_more)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}

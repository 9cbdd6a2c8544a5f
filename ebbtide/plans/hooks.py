"""The decoders as SQL functions, for queries written as SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ebbtide.functions.numbers import DECIMAL_NUMBER, WHOLE_NUMBER
from ebbtide.operators.changes import HORIZONS
from ebbtide.plans.movers import CODED_COLUMNS, ORDERED_COLUMNS


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_decoders(spark: SparkSession) -> None:
    """Temporary SQL functions of the session:

    * ``whole_number(text)`` and ``real_number(text)``: the number, NULL unless the whole
      text is one;
    * ``decode_ordered(...)`` and ``decode_coded(...)``: table functions of the report's
      columns as text, in the report's order. They give the typed row, or none where a
      slot is harmed (rules as in :func:`ebbtide.plans.movers.decode_ordered`)::

          SELECT d.* FROM results r, LATERAL decode_coded(r.Code, r.DayChange, ...) d

    They are SQL all through, so Spark plans their text as part of the query.
    """
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION whole_number(t STRING) RETURNS BIGINT
        RETURN CASE WHEN t RLIKE {_quoted(WHOLE_NUMBER)} THEN try_cast(t AS BIGINT) END"""
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION real_number(t STRING) RETURNS DOUBLE
        RETURN CASE WHEN t RLIKE {_quoted(DECIMAL_NUMBER)}
            AND abs(try_cast(t AS DOUBLE)) < double('Infinity') THEN try_cast(t AS DOUBLE) END"""
    )
    _create(spark, "decode_ordered", ORDERED_COLUMNS)
    _create(spark, "decode_coded", CODED_COLUMNS)


def _create(spark: SparkSession, name: str, columns: list[str]) -> None:
    changes = [f"{h.title()}Change" for h in HORIZONS]
    # NULL stands for a slot that is harmed; a change that is missing is 0.
    value = {c: f"CASE WHEN {c} IS NULL THEN 0D ELSE real_number({c}) END" for c in changes}
    value["Position"] = "whole_number(Position)"
    types = {c: "DOUBLE" for c in changes} | {"Position": "BIGINT"}
    given = ", ".join(f"{c} STRING" for c in columns)
    typed = ", ".join(f"{c} {types.get(c, 'STRING')}" for c in columns)
    made = ", ".join(f"{value.get(c, c)} AS {c}" for c in columns)
    sound = " AND ".join(f"{value.get(c, c)} IS NOT NULL" for c in columns)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS TABLE ({typed})
        RETURN SELECT {made} WHERE {sound}"""
    )


def call(name: str, columns: list[str], alias: str) -> str:
    """The text of a call with the columns of a table of that alias."""
    return f"{name}({', '.join(f'{alias}.{c}' for c in columns)})"

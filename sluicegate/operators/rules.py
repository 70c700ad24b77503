"""Contracts as data: a table of rules, compiled to the expressions of a contract.

A row is a rule: its place in the order of violations, code, name (of its flag ``v_name`` and
counter ``cnt_name``), kind, and what the kind needs.  Kinds are ``present``, ``range``
(low, high), ``one_of`` (allowed), ``time`` (the time column can be read) and ``fresh``
(seconds).  ``preferred`` orders codes that are equally frequent; rules without it follow
in their own order.  The time column is that of the ``time`` and ``fresh`` rules, which must
agree on it.

The table can be stored beside the tables it made, so that whoever reads these later knows
which counters they have.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from sluicegate.operators.contract import EVENT_TS, Contract, Rule, fresh, in_range, one_of, parseable_time, present

TABLE = "contract"
SCHEMA = (
    "place int, code string, name string, kind string, column string, low double, high double, "
    "allowed array<string>, seconds int, preferred int"
)


def _rule(row: Row) -> Rule:
    column = f"`{row.column}`"
    if row.kind == "present":
        return present(row.code, row.name, column)
    if row.kind == "range":
        return in_range(row.code, row.name, column, row.low, row.high)
    if row.kind == "one_of":
        return one_of(row.code, row.name, column, tuple(row.allowed))
    if row.kind == "time":
        return parseable_time(row.code, row.name)
    if row.kind == "fresh":
        return fresh(row.code, row.name, row.seconds)
    raise ValueError(f"rule {row.code} is of no known kind: {row.kind}")


def compiled(rows: DataFrame) -> Contract:
    """The contract that a table of rules describes; a contract has tens of rules at most."""
    found = sorted(rows.collect(), key=lambda r: r.place)
    for what in ("place", "code", "name"):
        if len({getattr(r, what) for r in found}) != len(found):
            raise ValueError(f"two rules have the same {what}")
    times = {r.column or EVENT_TS for r in found if r.kind in ("time", "fresh")}
    if len(times) > 1:
        raise ValueError(f"rules read different time columns: {sorted(times)}")
    preferred = sorted(found, key=lambda r: (r.preferred is None, r.preferred or 0, r.place))
    return Contract(tuple(map(_rule, found)), tuple(r.code for r in preferred), *times)


def store(rows: DataFrame, root: str) -> None:
    rows.select(*rows.sparkSession.createDataFrame([], SCHEMA).columns).coalesce(1).write.mode("overwrite").parquet(f"{root}/{TABLE}")


def load(spark: SparkSession, root: str) -> Contract | None:
    """The contract stored below ``root``; None if there is none."""
    try:
        return compiled(spark.read.schema(SCHEMA).parquet(f"{root}/{TABLE}"))
    except AnalysisException:
        return None

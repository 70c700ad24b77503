"""Keep a costly expression from being evaluated again for every use."""

from __future__ import annotations

from pyspark.sql import DataFrame


def computed_once(df: DataFrame, name: str, value: str) -> DataFrame:
    """Add a column that filters above it read instead of recomputing.

    Catalyst pushes a filter below a projection by writing the projected
    expression into it, once per mention.  It does not push one below a generator
    whose output the filter reads, while the filter's other conditions still reach
    the scan.  The generator yields exactly one row per row.
    """
    return df.selectExpr("*", f"explode(array({value})) AS {name}")

"""Every query against the same question in SQL on another engine."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry_points  # noqa: E402

from sluicegate.plans.queries import QUERIES as OWN  # noqa: E402

QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()


def test_every_query_has_its_sql():
    assert set(OWN) <= set(ORACLE) <= set(QUERIES)


@pytest.fixture(scope="module")
def engine(sf_medium):
    connection = duckdb.connect()
    for file in sorted(os.listdir(sf_medium)):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_medium}/{file}'")
    return connection


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_its_sql(spark, engine, sf_medium, name):
    got = QUERIES[name](spark, sf_medium)
    cursor = engine.execute(ORACLE[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(got.columns)
    expected = sorted(map(repr, cursor.fetchall()))
    assert sorted(repr(tuple(row)) for row in got.select(*names).collect()) == expected
    assert expected


def test_entry_reads_the_smallest_tables(spark):
    assert entry_points.entry(spark).count() == 25

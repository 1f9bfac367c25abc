"""Every registered query against its DuckDB oracle (the driver's check).

Runs at sf0.001 by default; set ROSTERLINE_ORACLE_SF=/root/testdata/sf0.01 for
the driver's scale.
"""

import os

import pytest
from oracle_compare import compare, duck

import __spark_entry__ as E
from rosterline.plans import registry

SF = os.environ.get("ROSTERLINE_ORACLE_SF", "/root/testdata/sf0.001")
QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = {"sample_rows"}
    assert set(QUERIES) - set(ORACLE) == rows_only


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "provnum" in df.columns


_DUCK_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
              "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_types_match_oracle(spark, con, name):
    spark_types = {f.name: _DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in QUERIES[name](spark, SF).schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({ORACLE[name]})").fetchall()}
    assert spark_types == duck_types

"""Every registered query against its DuckDB SQL oracle on the smallest
driver tables: same columns, same row count, same multiset of rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from furlong.registry import ORACLE, QUERIES
from oracle_compare import compare, duck

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


# The driver compares schemas too: same logical type per column.
_KINDS = {"bigint": "int", "int": "int", "integer": "int", "double": "float",
          "string": "str", "varchar": "str", "boolean": "bool"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name](), SF_SMALL)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r
    for col, (s_t, d_t) in r["types"].items():
        assert _KINDS.get(s_t.lower()) == _KINDS.get(d_t.lower()), (col, s_t, d_t)


def test_entry_smoke(spark, con):
    df = entry.entry(spark)
    # as many sire × track × going groups with >= 20 runs as the SQL finds
    want = len(con.execute(ORACLE["sire_track_condition_roi"]()).fetchall())
    assert len(df.collect()) == want > 0
    assert df.columns[:4] == ["sire_id", "sire_name", "track_type", "track_condition"]

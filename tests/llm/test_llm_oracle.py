"""Every query with SQL, against DuckDB."""

from __future__ import annotations

import pytest

from furlong.llm.registry import ORACLE, QUERIES
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    r = compare(spark, duck(SF), name, QUERIES[name], ORACLE[name], SF)
    assert r["columns_match"] and r["values_match"], r
    kinds = {"bigint": "int", "int": "int", "integer": "int", "double": "float", "string": "str", "varchar": "str"}
    for column, (a, b) in r["types"].items():
        assert kinds.get(a.lower(), a) == kinds.get(b.lower(), b.lower()), (column, a, b)


def test_one_query_per_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]

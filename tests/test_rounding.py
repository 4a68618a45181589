"""Exact half-up rounding against Python's decimal arithmetic."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from furlong.functions.rounding import hundredths


def _expected(num, den, p, q):
    if den == 0:
        return None
    x = Decimal(num) * p / (Decimal(den) * q) * 100
    return int(x.quantize(Decimal(1), rounding=ROUND_HALF_UP))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**15), st.integers(0, 10**9)), min_size=1, max_size=40),
       st.sampled_from([(1, 1), (100, 1), (100, 1000), (1, 1000)]))
def test_hundredths_matches_decimal(spark, pairs, pq):
    p, q = pq
    df = spark.createDataFrame(pairs, "num long, den long")
    got = [r[0] for r in df.select(hundredths(F.col("num"), F.col("den"), p, q)).collect()]
    assert got == [_expected(n, d, p, q) for n, d in pairs]


def test_small_totals_are_rounded_on_longs(spark):
    """Decimals only beyond what longs hold exactly; both sides of that limit agree."""
    most = 2**61 // (200 * 1000)
    pairs = [(most + a, most + b) for a in (-1, 0, 1) for b in (-1, 0, 1)] + [(7, 0), (most + 1, 0), (None, 3), (3, None)]
    df = spark.createDataFrame(pairs, "num long, den long")
    got = [r[0] for r in df.select(hundredths(F.col("num"), F.col("den"), 100, 1000)).collect()]
    assert got == [None if None in x else _expected(*x, 100, 1000) for x in pairs]
    plan = df.select(hundredths(F.col("num"), F.col("den")).alias("h"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and "decimal" in plan

"""The ROI metric library.

Every metric is built from a handful of additive totals (counts and sums),
so Spark aggregates them in two phases (map-side partial, then final after
the shuffle) and a hot group costs one row per task in the shuffle, no
matter how many runners it has.  Totals are longs (fixed-width hash
aggregate buffers, no per-row decimal arithmetic); rounded rates are derived
from them exactly, once per group, after the aggregation.

Input columns expected on the runner rows: ``finish_pos`` (text),
``odds_milli`` (win odds in thousandths, long) and ``popularity`` (int).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from furlong.functions.rounding import from_hundredths, hundredths, mean2, percent2

# --- Fixed values -----------------------------------------------------------
WIN = "01"
TOP3 = ("01", "02", "03")
# ----------------------------------------------------------------------------

ODDS_UNITS = 1000  # odds_milli per unit of odds

# Names of the additive totals (internal columns of an aggregate).
N = "_n"
WINS = "_wins"
TOP3_N = "_top3"
ODDS_SUM = "_win_odds_milli_sum"
ODDS_N = "_win_odds_n"
POP_SUM = "_pop_sum"
POP_N = "_pop_n"
MIDDLE_WINS = "_middle_wins"
LONG_WINS = "_long_wins"
NONFAV_WINS = "_nonfav_wins"

TOTALS = (N, WINS, TOP3_N, ODDS_SUM, ODDS_N, POP_SUM, POP_N,
          MIDDLE_WINS, LONG_WINS, NONFAV_WINS)

METRIC_NAMES = (
    "total_races", "wins", "top3_finishes", "win_rate", "top3_rate",
    "roi_percentage", "avg_win_odds", "avg_popularity", "middle_odds_wins",
    "longshot_wins", "non_favorite_wins",
)


def total_columns() -> list[Column]:
    """Aggregate expressions of all additive totals.  Totals a caller does
    not read are pruned by the optimizer."""
    win = F.col("finish_pos") == WIN
    pop = F.col("popularity")
    odds = F.col("odds_milli")
    return [
        F.count(F.lit(1)).alias(N),
        F.count(F.when(win, F.lit(1))).alias(WINS),
        F.count(F.when(F.col("finish_pos").isin(*TOP3), F.lit(1))).alias(TOP3_N),
        F.sum(F.when(win, odds).otherwise(F.lit(0).cast("long"))).alias(ODDS_SUM),
        F.count(F.when(win, odds)).alias(ODDS_N),
        F.sum(pop.cast("long")).alias(POP_SUM),
        F.count(pop).alias(POP_N),
        F.count(F.when(win & pop.between(4, 8), F.lit(1))).alias(MIDDLE_WINS),
        F.count(F.when(win & (pop >= 9), F.lit(1))).alias(LONG_WINS),
        F.count(F.when(win & (pop >= 4), F.lit(1))).alias(NONFAV_WINS),
    ]


def merge_columns() -> list[Column]:
    """Aggregate expressions that merge already-aggregated totals (for
    rolling finer groups up to coarser ones)."""
    return [F.sum(c).alias(c) for c in TOTALS]


def _c(name: str) -> Column:
    return F.col(name)


def roi_hundredths(odds_sum: Column | None = None, n: Column | None = None) -> Column:
    """ROI of a flat one-unit win bet on every runner, in hundredths of a
    percent: payout Σ odds of winners over stake n, × 100."""
    return hundredths(_c(ODDS_SUM) if odds_sum is None else odds_sum,
                      _c(N) if n is None else n, 100, ODDS_UNITS)


def win_rate_hundredths(wins: Column | None = None, n: Column | None = None) -> Column:
    return hundredths(_c(WINS) if wins is None else wins, _c(N) if n is None else n, 100)


_METRICS = {
    "total_races": lambda: _c(N),
    "wins": lambda: _c(WINS),
    "top3_finishes": lambda: _c(TOP3_N),
    "win_rate": lambda: from_hundredths(win_rate_hundredths()),
    "top3_rate": lambda: percent2(_c(TOP3_N), _c(N)),
    "roi_percentage": lambda: from_hundredths(roi_hundredths()),
    "avg_win_odds": lambda: mean2(_c(ODDS_SUM), _c(ODDS_N), ODDS_UNITS),
    "avg_popularity": lambda: mean2(_c(POP_SUM), _c(POP_N)),
    "middle_odds_wins": lambda: _c(MIDDLE_WINS),
    "longshot_wins": lambda: _c(LONG_WINS),
    "non_favorite_wins": lambda: _c(NONFAV_WINS),
}
assert tuple(_METRICS) == METRIC_NAMES


def metric_columns(names: Iterable[str]) -> list[Column]:
    """Output columns for the named metrics, read from the totals."""
    names = list(names)
    unknown = [n for n in names if n not in _METRICS]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}; known: {list(METRIC_NAMES)}")
    return [_METRICS[n]().alias(n) for n in names]


def ratio2(num_hundredths: Column, den_hundredths: Column) -> Column:
    """``round(a / NULLIF(b, 0), 2)`` of two values given in hundredths."""
    return from_hundredths(hundredths(num_hundredths, den_hundredths))

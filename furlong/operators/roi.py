"""``roi_by``: group rated runners, compute ROI metrics, keep big groups.

Every report is the same plan: rated runners → group by some keys →
additive totals (two-phase hash aggregate) → min-races filter → rounded
metrics → optional sort.  Only the keys, the metric list and the order
differ, so they are parameters here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.functions.metrics import N, merge_columns, metric_columns, total_columns


def roi_totals(rated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Additive totals per group (counts and sums; mergeable)."""
    return rated.groupBy(*keys).agg(*total_columns())


def roll_up(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge totals of finer groups into coarser ``keys``."""
    return totals.groupBy(*keys).agg(*merge_columns())


def finish(
    totals: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    min_races: int | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Apply the min-races filter to totals and derive the metric columns."""
    if min_races is not None:
        totals = totals.where(F.col(N) >= F.lit(min_races))
    out = totals.select(*[F.col(k) for k in keys], *metric_columns(metrics))
    return out.orderBy(*order) if order else out


def roi_by(
    rated: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    min_races: int | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """ROI report of ``rated`` grouped by ``keys``."""
    return finish(roi_totals(rated, keys), keys, metrics, min_races, order)

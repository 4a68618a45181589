"""Losing runs in a career (gaps and islands), and what follows them.

A horse's rated runs, in career order, fall into islands: an island begins
with the first run or the one after an ending run (by default a win), and
ends with the next ending run.  Before a run of an island there are as many
other runs as the horse has been without an ending: ``streak`` runs, since
the day of the island's first run.  The run that ends the streak is the last
of its island.

Career order is the race key, then finish, the named columns, odds and rank,
as in :func:`furlong.operators.extras.next_run_roi`; a horse's career is
short, so its window is bounded.  The placeholder id of unknown horses and
NULL ids have no career.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furlong.functions.filters import UNKNOWN_PARENT, is_rated
from furlong.functions.metrics import WIN, merge_columns, total_columns
from furlong.functions.rounding import mean2
from furlong.operators.as_of import race_day
from furlong.operators.roi import finish
from furlong.operators.runners import rated_runners
from furlong.schema import RACE_KEY, RaceTables

STREAK_METRICS = ("total_races", "wins", "win_rate", "roi_percentage", "avg_win_odds")


def with_streaks(runners: DataFrame, ends: Column | None = None, placeholder: str = UNKNOWN_PARENT) -> DataFrame:
    """The rated runs of known horses with ``streak`` (rated runs since the last
    one for which ``ends`` holds, this one not counted) and ``streak_days`` (days
    from the first of them to this run; NULL without one or without a date)."""
    ends = F.coalesce(F.col("kakutei_chakujun") == WIN if ends is None else ends, F.lit(False))
    order = [F.col(k).asc_nulls_first() for k in (*RACE_KEY, "kakutei_chakujun", "tansho_odds", "tansho_ninkijun")]
    career = Window.partitionBy("ketto_toroku_bango").orderBy(*order)
    runs = runners.where((F.col("ketto_toroku_bango") != placeholder) & is_rated(F.col("kakutei_chakujun"), F.col("tansho_odds")))
    runs = runs.withColumn("_island", F.coalesce(
        F.sum(ends.cast("int")).over(career.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    island = Window.partitionBy("ketto_toroku_bango", "_island").orderBy(*order)
    runs = runs.withColumns({"streak": F.row_number().over(island) - 1, "_began": F.first(race_day()).over(island)})
    return runs.withColumn("streak_days", F.when(F.col("streak") > 0, F.datediff(race_day(), F.col("_began")))).drop("_island", "_began")


def losing_streak_roi(t: RaceTables, longest: int = 10, since_year: int | None = None, ends: Column | None = None,
                      min_races: int = 1, bad_values: str = "fail") -> DataFrame:
    """ROI of the runs made after ``streak`` rated runs without a win (longer
    streaks than ``longest`` count as that): all such runs, those that ended the
    streak (``wins``, for the default ``ends``), and ``avg_streak_days``, how long
    it had lasted.  Streaks are found in all years; ``since_year`` limits the
    runs that are reported."""
    runs = with_streaks(t.runners, ends)
    rated = rated_runners(RaceTables(t.races, runs, t.horses), since_year, bad_values=bad_values, carry=("streak", "streak_days"))
    rated = rated.withColumn("streak", F.least("streak", F.lit(longest)))
    totals = rated.groupBy("streak").agg(*total_columns(), F.sum("streak_days").alias("_days"), F.count("streak_days").alias("_dated"))
    days = totals.select(F.col("streak").alias("_s"), mean2(F.col("_days"), F.col("_dated")).alias("avg_streak_days"))
    report = finish(totals.drop("_days", "_dated"), ("streak",), STREAK_METRICS, min_races)
    return report.join(days, F.col("streak") == F.col("_s")).drop("_s").orderBy("streak")

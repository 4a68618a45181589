"""Features the source project documents without code (extensions).

Their definitions are ours, built from the same parts as the reports:

* broodmare-sire ROI: the sire of the horse's dam, × track type × going;
* horse × course ROI: each horse's record at each course.

* closing-time rank ROI: rank of each runner's closing time within its
  race, then ROI per rank — the time column is named by the caller (the
  race tables here do not carry one);
* next-run ROI after a flagged run: the flag of each horse's previous run
  (a caller-supplied column, e.g. "raced against the pace and lost
  heavily"), then ROI of the following run per flag value.

The stamina index has no formula anywhere, so it is not built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furlong.functions.filters import UNKNOWN_PARENT, known_parent
from furlong.operators.roi import roi_by
from furlong.operators.runners import rated_runners
from furlong.schema import RACE_KEY, RaceTables

BROODMARE_SIRE_METRICS = (
    "total_races", "wins", "win_rate", "roi_percentage", "avg_win_odds",
    "avg_popularity", "longshot_wins",
)
HORSE_COURSE_METRICS = (
    "total_races", "wins", "top3_finishes", "win_rate", "top3_rate", "roi_percentage",
    "avg_win_odds",
)


def broodmare_sires(t: RaceTables) -> DataFrame:
    """horse id → the sire of its dam (horse table joined to itself on the
    dam id; N:1, a dam has a bounded number of foals)."""
    foals = t.horses.select(F.col("ketto_toroku_bango").alias("_horse_id"),
                            F.col("ketto_joho_02a").alias("_dam_id")).where(known_parent(F.col("_dam_id")))
    dams = t.horses.select(F.col("ketto_toroku_bango").alias("_dam_id"),
                           F.col("ketto_joho_01a").alias("bms_id"),
                           F.trim("ketto_joho_01b").alias("bms_name"))
    return foals.join(dams, "_dam_id", "inner").select("_horse_id", "bms_id", "bms_name")


def broodmare_sire_track_roi(t: RaceTables, since_year: int = 2000, min_races: int = 20,
                             bad_values: str = "fail") -> DataFrame:
    """ROI per broodmare sire × track type × going; unknown broodmare sires
    (sentinel or NULL) are left out, as unknown sires are in the sire report."""
    rated = rated_runners(t, since_year, bad_values=bad_values)
    bms = broodmare_sires(t).where(known_parent(F.col("bms_id")))
    rated = rated.join(bms, rated["horse_id"] == bms["_horse_id"], "inner")
    keys = ("bms_id", "bms_name", "track_type", "track_condition")
    return roi_by(rated, keys, BROODMARE_SIRE_METRICS, min_races,
                  [F.col("roi_percentage").desc(), *[F.col(k) for k in keys]])


def horse_course_roi(t: RaceTables, since_year: int = 2000, min_races: int = 1,
                     bad_values: str = "fail") -> DataFrame:
    """ROI of each horse at each course."""
    rated = rated_runners(t, since_year, bad_values=bad_values)
    return roi_by(rated, ("horse_id", "course_name"), HORSE_COURSE_METRICS, min_races)


CLOSING_METRICS = ("total_races", "wins", "win_rate", "roi_percentage", "avg_win_odds")


def closing_rank_roi(t: RaceTables, time_col: str, since_year: int = 2000,
                     min_races: int = 1, time_type: str = "decimal(8,1)",
                     bad_values: str = "fail") -> DataFrame:
    """ROI per closing-time rank: all runners of a race, rated or not, are
    ranked by the runner column ``time_col`` (fastest first, ties share a
    rank; runners without a time get none); then the rated ones count.  The
    window is one race, so it is bounded by the field size."""
    time = F.col(time_col).try_cast(time_type)
    in_race = Window.partitionBy(*RACE_KEY).orderBy(time.asc_nulls_last())
    ranked = t.runners.withColumn(
        "closing_rank", F.when(time.isNotNull(), F.rank().over(in_race)).cast("int"))
    rated = rated_runners(RaceTables(t.races, ranked, t.horses), since_year, bad_values=bad_values,
                          carry=("closing_rank",))
    return roi_by(rated.where(F.col("closing_rank").isNotNull()), ("closing_rank",),
                  CLOSING_METRICS, min_races, [F.col("closing_rank")])


def next_run_roi(t: RaceTables, flag_col: str, since_year: int | None = None,
                 min_races: int = 1, bad_values: str = "fail",
                 placeholder: str = UNKNOWN_PARENT) -> DataFrame:
    """ROI of each horse's next run, grouped by the value of the runner
    column ``flag_col`` on the run before it, rated or not and in any year
    (NULL for a first run).  Runs are ordered by race key within a horse (of
    equal keys, by finish, flag, odds and rank).  The ``placeholder`` id of unknown horses
    and NULL ids have no career and are left out; a horse's career is short,
    so the window is bounded."""
    order = [F.col(k).asc_nulls_first() for k in (*RACE_KEY, "kakutei_chakujun", flag_col, "tansho_odds", "tansho_ninkijun")]
    career = Window.partitionBy("ketto_toroku_bango").orderBy(*order)
    runs = t.runners.where(F.col("ketto_toroku_bango") != placeholder).withColumn(
        "previous_flag", F.lag(F.col(flag_col)).over(career))
    rated = rated_runners(RaceTables(t.races, runs, t.horses), since_year, bad_values=bad_values,
                          carry=("previous_flag",))
    return roi_by(rated, ("previous_flag",), CLOSING_METRICS, min_races, [F.col("previous_flag")])

"""Registered queries: one per operator, over tables derived from a
benchmark directory, each with its SQL oracle.

Every registered query reads the whole derived tables; batch lookups use
request tables that Spark derives from the same data (see
:mod:`furlong.sources.requests`).  Columns that an engine types differently
(row_number INT vs BIGINT, decimals vs doubles) are cast to one type here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.operators import (
    as_of, breeding, careers, extras, lookups, names, payouts, pedigree, pedigree_paths, quarantine, reports, stamina,
)
from furlong.operators.runners import rated_runners
from furlong.sources import oracle_sql as sql
from furlong.sources import requests as req
from furlong.sources import totals_store as stored
from furlong.schema import RaceTables
from furlong.sources.fixtures import breeding_stock, fixture_tables
from furlong.sources.tables import kept, with_runs

Query = Callable[[SparkSession, str], DataFrame]


def _q1(spark: SparkSession, d: str) -> DataFrame:
    return reports.sire_track_condition_roi(fixture_tables(spark, d))


def _q2(spark: SparkSession, d: str) -> DataFrame:
    return reports.jockey_course_roi(fixture_tables(spark, d))


def _q3(spark: SparkSession, d: str) -> DataFrame:
    return reports.jockey_popularity_roi(fixture_tables(spark, d))


def _q4(spark: SparkSession, d: str) -> DataFrame:
    return reports.jockey_surface_condition_roi(fixture_tables(spark, d))


def _q10(spark: SparkSession, d: str) -> DataFrame:
    df = rated_runners(fixture_tables(spark, d))
    return df.withColumn("win_odds", F.col("win_odds").cast("double"))


def _q5(spark: SparkSession, d: str) -> DataFrame:
    t = fixture_tables(spark, d)
    return lookups.jockey_course_feature(t, req.jockey_requests(t), prune=False)  # they name all that raced


def _q6(spark: SparkSession, d: str) -> DataFrame:
    t = fixture_tables(spark, d)
    return lookups.horse_sire_track_roi_feature(t, req.horse_requests(t), prune=False)


def _q7(spark: SparkSession, d: str) -> DataFrame:
    return lookups.sire_track_roi_rank(fixture_tables(spark, d))


def _q8(spark: SparkSession, d: str) -> DataFrame:
    t = fixture_tables(spark, d)
    return pedigree.pedigree_rows(t, req.registered_horses(t))


def _q9(spark: SparkSession, d: str) -> DataFrame:
    t = fixture_tables(spark, d)
    return pedigree.flatten_tree(pedigree.pedigree_tree(t, req.runner_horses(t)))


def _d1(spark: SparkSession, d: str) -> DataFrame:
    return extras.broodmare_sire_track_roi(fixture_tables(spark, d))


def _d3(spark: SparkSession, d: str) -> DataFrame:
    return extras.closing_rank_roi(fixture_tables(spark, d), "closing_time")


def _d4(spark: SparkSession, d: str) -> DataFrame:
    return extras.next_run_roi(fixture_tables(spark, d), "run_flag")


def _d2(spark: SparkSession, d: str) -> DataFrame:
    return extras.horse_course_roi(fixture_tables(spark, d))


def _days_as_text(df: DataFrame, *days: str) -> DataFrame:
    return df.withColumns({d: F.col(d).cast("string") for d in days})


def _with_runs(spark: SparkSession, d: str) -> RaceTables:
    """For queries whose requests and answers both come from the runs."""
    return with_runs(fixture_tables(spark, d), stored.new_folder(spark, "runs"))


def _requests(df: DataFrame) -> DataFrame:
    return kept(df, stored.new_folder(df.sparkSession, "requests"))


def _jockey_as_of(spark: SparkSession, d: str) -> DataFrame:
    t = _with_runs(spark, d)
    return _days_as_text(as_of.jockey_course_record_as_of(t, _requests(req.jockey_days(t))), "as_of")


def _sire_as_of(spark: SparkSession, d: str) -> DataFrame:
    t = _with_runs(spark, d)
    return _days_as_text(as_of.sire_track_record_as_of(t, _requests(req.horse_days(t))), "as_of")


def _stored_jockey_course(spark: SparkSession, d: str) -> DataFrame:
    """The report from a totals store that was filled in two loads: the days up
    to 1996, the 13th of every month without the runners that have a betting
    rank; then the days from 1996 on, with the first days of earlier months once
    more and their 13ths corrected."""
    rated = rated_runners(fixture_tables(spark, d))
    day = stored.race_day_text()
    store = stored.TotalsStore(spark, stored.new_folder(spark), stored.JOCKEY_GRAIN)
    store.replace_days(rated.where((day < "1996") & (~day.endswith("13") | F.col("popularity").isNull())))
    store.replace_days(rated.where((day >= "1996") | day.endswith("01") | day.endswith("13")))
    return store.report(("jockey_id", "jockey_name", "course_name", "track_type", "distance_category"),
                        reports.JOCKEY_COURSE_METRICS, since="2000", min_races=20)


def _jockey_payout(spark: SparkSession, d: str) -> DataFrame:
    return payouts.jockey_payout_roi(fixture_tables(spark, d))


def _names(spark: SparkSession, d: str) -> DataFrame:
    t = fixture_tables(spark, d)
    return _days_as_text(names.jockey_names_on(t, req.name_days(t)), "as_of", "valid_from", "valid_to")


def _streaks(spark: SparkSession, d: str) -> DataFrame:
    return careers.losing_streak_roi(fixture_tables(spark, d))


def _stamina(spark: SparkSession, d: str) -> DataFrame:
    return stamina.stamina_index(fixture_tables(spark, d), "run_score")


def _rejected(spark: SparkSession, d: str) -> DataFrame:
    """The fixture tables have no bad texts in rated rows: some are put in."""
    t, no, race = fixture_tables(spark, d), F.col("umaban"), F.col("race_bango")
    odds = F.when(race.endswith("7") & (no == "02"), "****").when(race.endswith("8") & (no == "03"), "12.345")
    runners = t.runners.withColumns({
        "tansho_odds": odds.otherwise(F.col("tansho_odds")),
        "tansho_ninkijun": F.when(race.endswith("7") & no.isin("01", "02"), "--").otherwise(F.col("tansho_ninkijun"))})
    races = t.races.withColumn("kyori", F.when(race.endswith("13"), "1,600").otherwise(F.col("kyori")))
    screened = quarantine.screen(RaceTables(races, runners, t.horses), stored.new_folder(spark, "screened"))
    return screened.rejects.withColumn("reasons", F.array_join("reasons", "; "))


def _inbreeding(spark: SparkSession, d: str) -> DataFrame:
    t = fixture_tables(spark, d)
    return pedigree_paths.inbreeding(t, req.registered_horses(t))


def _crosses(spark: SparkSession, d: str) -> DataFrame:
    return pedigree_paths.line_cross_roi(fixture_tables(spark, d))


def _with_stock(spark: SparkSession, d: str) -> DataFrame:
    t = fixture_tables(spark, d)
    t = RaceTables(t.races, t.runners, breeding.resolved_horses(t.horses, breeding_stock(spark, d)))
    return pedigree.pedigree_rows(t, req.registered_horses(t))


QUERIES: dict[str, Query] = {
    "sire_track_condition_roi": _q1,
    "jockey_course_roi": _q2,
    "jockey_popularity_roi": _q3,
    "jockey_surface_condition_roi": _q4,
    "jockey_course_feature": _q5,
    "horse_sire_track_roi_feature": _q6,
    "sire_track_roi_rank": _q7,
    "pedigree_rows": _q8,
    "pedigree_tree": _q9,
    "rated_runners": _q10,
    # extensions: documented by the source project, defined here
    "broodmare_sire_track_roi": _d1,
    "horse_course_roi": _d2,
    "closing_rank_roi": _d3,
    "next_run_roi": _d4,
    "jockey_course_record_as_of": _jockey_as_of,
    "sire_track_record_as_of": _sire_as_of,
    "stored_jockey_course_roi": _stored_jockey_course,
    "jockey_payout_roi": _jockey_payout,
    "jockey_names_on": _names,
    "losing_streak_roi": _streaks,
    "stamina_index": _stamina,
    "rejected_runners": _rejected,
    "pedigree_inbreeding": _inbreeding,
    "line_cross_roi": _crosses,
    "pedigree_rows_with_stock": _with_stock,
}

ORACLE: dict[str, Callable[[], str]] = {
    "sire_track_condition_roi": sql.sire_track_condition_roi,
    "jockey_course_roi": sql.jockey_course_roi,
    "jockey_popularity_roi": sql.jockey_popularity_roi,
    "jockey_surface_condition_roi": sql.jockey_surface_condition_roi,
    "jockey_course_feature": sql.jockey_course_feature,
    "horse_sire_track_roi_feature": sql.horse_sire_track_roi_feature,
    "sire_track_roi_rank": sql.sire_track_roi_rank,
    "pedigree_rows": sql.pedigree_rows,
    "pedigree_tree": sql.pedigree_tree,
    "rated_runners": sql.rated_runners,
    "broodmare_sire_track_roi": sql.broodmare_sire_track_roi,
    "horse_course_roi": sql.horse_course_roi,
    "closing_rank_roi": sql.closing_rank_roi,
    "next_run_roi": sql.next_run_roi,
    "jockey_course_record_as_of": sql.jockey_course_record_as_of,
    "sire_track_record_as_of": sql.sire_track_record_as_of,
    "stored_jockey_course_roi": sql.jockey_course_roi,
    "jockey_payout_roi": sql.jockey_payout_roi,
    "jockey_names_on": sql.jockey_names_on,
    "losing_streak_roi": sql.losing_streak_roi,
    "stamina_index": sql.stamina_index,
    "rejected_runners": sql.rejected_runners,
    "pedigree_inbreeding": sql.pedigree_inbreeding,
    "line_cross_roi": sql.line_cross_roi,
    "pedigree_rows_with_stock": sql.pedigree_rows_with_stock,
}

"""Point-in-time records: what was known of an entity before a day.

The lookups of :mod:`furlong.operators.lookups` sum over all history, races
after the one being scored included, as their source does.  A model trained
on them sees the results it is to predict (target leakage).  The features
here take a day with every request and count only races run before it.

Same-day rule: a race on the day itself is not known, whatever its course or
number; requests of one day see the same.  Runs whose year and month-day are
not a date are in no point-in-time record.

Plan: runs become additive totals per key and day, in one two-phase aggregate
that also marks the days that are asked for, so that both are derived once.
After it a key has at most as many rows as the calendar has days, however many
runs or requests it has.  They are dealt by key and sorted by day; a running sum
inside the calendar year and one over the earlier years answer each marked day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furlong.functions.buckets import course_code
from furlong.functions.filters import is_rated
from furlong.functions.metrics import (
    N, ODDS_SUM, TOTALS, WINS, metric_columns, ratio2, roi_hundredths, total_columns, win_rate_hundredths,
)
from furlong.functions.rounding import from_hundredths
from furlong.operators.lookups import CONDITION_KEYS, COURSE_METRICS, SIRE_KEYS, horse_sires
from furlong.operators.runners import rated_runners, runner_columns
from furlong.schema import RACE_KEY, RaceTables

AS_OF = "as_of"
COUNTS = ("total_races", "wins", "top3_finishes", "middle_odds_wins", "longshot_wins", "non_favorite_wins")


def race_day() -> Column:
    """The day of a race from its year and month-day (NULL if that is no date)."""
    return F.try_to_date(F.concat("kaisai_nen", "kaisai_tsukihi"), "yyyyMMdd")


def totals_before(rated: DataFrame, keys: Sequence[str], requests: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Totals of the rated runs of each requested key before each requested
    day: one row per distinct (``keys``, ``as_of``) of ``requests`` without a
    NULL among them.  Totals are 0 where there is nothing before."""
    keys = list(keys)
    zero = F.lit(0).cast("long")
    runs = rated.withColumn("_day", race_day()).select(*keys, "_day", "finish_pos", "odds_milli", "popularity", F.lit(1).alias("_run"))
    asked = requests.select(*keys, F.col(as_of).cast("date").alias("_day"), F.lit(0).alias("_run"))
    days = runs.unionByName(asked, allowMissingColumns=True)
    for c in (*keys, "_day"):
        days = days.where(F.col(c).isNotNull())
    # a request has nothing to sum but itself: runs are counted by their mark
    sums = [F.sum(F.col("_run").cast("long")).alias(N), *total_columns()[1:]]
    days = days.groupBy(*keys, "_day").agg(*sums, (F.min("_run") == 0).alias("_asked")).withColumn("_year", F.year("_day"))

    # the runs of a day itself are not known on it
    inside = Window.partitionBy(*keys, "_year").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*keys).orderBy("_year").rangeBetween(Window.unboundedPreceding, -1)
    in_year = days.repartition(*keys).select("*", *[F.sum(c).over(inside).alias(f"_in{c}") for c in TOTALS])
    known = in_year.select("*", *[F.sum(c).over(ahead).alias(f"_before{c}") for c in TOTALS]).where("_asked")
    return known.select(*keys, F.col("_day").alias(as_of), *[
        (F.coalesce(f"_in{c}", zero) + F.coalesce(f"_before{c}", zero)).alias(c) for c in TOTALS])


def _metrics(names: Sequence[str]) -> list[Column]:
    """The named metrics: counts are 0 without runs, rates and averages NULL."""
    zero = F.lit(0).cast("long")
    return [F.coalesce(x, zero).alias(n) if n in COUNTS else x for n, x in zip(names, metric_columns(names), strict=True)]


def jockey_course_record_as_of(t: RaceTables, requests: DataFrame, bad_values: str = "fail") -> DataFrame:
    """Per request (jockey_id, course_name, track_type, distance_category,
    as_of): the jockey's record under that condition and the jockey's overall
    record, both before the day ``as_of``, with two ratios of the rounded rates.

    ``course_name`` may be a name or a raw course code.  Records are by jockey
    id, over all names it has had.  The overall record needs no known race.
    Without runs before the day counts are 0 and rates NULL; so they are for
    requests with a NULL in them."""
    keys = ["jockey_id", *CONDITION_KEYS]
    coded = requests.withColumn("keibajo_code", course_code(F.col("course_name"))).withColumn(AS_OF, F.col(AS_OF).cast("date"))
    cond = totals_before(rated_runners(t, bad_values=bad_values), keys, coded)
    runs = t.runners.where(is_rated(F.col("kakutei_chakujun"), F.col("tansho_odds"))).select(*RACE_KEY, *runner_columns(bad_values))
    overall = totals_before(runs, ["jockey_id"], coded).select(
        "jockey_id", AS_OF, F.col(N).alias("_all_n"), F.col(WINS).alias("_all_wins"), F.col(ODDS_SUM).alias("_all_odds"))
    all_win = win_rate_hundredths(F.col("_all_wins"), F.col("_all_n"))
    all_roi = roi_hundredths(F.col("_all_odds"), F.col("_all_n"))
    met = coded.join(cond, [*keys, AS_OF], "left").join(overall, ["jockey_id", AS_OF], "left")
    met = met.withColumns({"_roi": roi_hundredths(), "_win": win_rate_hundredths(), "_all_roi": all_roi, "_all_win": all_win})
    return met.select(
        *requests.columns,
        *_metrics(COURSE_METRICS),
        F.coalesce("_all_n", F.lit(0).cast("long")).alias("all_total_races"),
        from_hundredths(F.col("_all_win")).alias("all_win_rate"),
        from_hundredths(F.col("_all_roi")).alias("all_roi_percentage"),
        ratio2(F.col("_roi"), F.col("_all_roi")).alias("course_aptitude_index"),
        ratio2(F.col("_win"), F.col("_all_win")).alias("win_rate_ratio"),
    )


SIRE_METRICS = ("total_races", "wins", "win_rate", "roi_percentage", "avg_win_odds")


def sire_track_record_as_of(t: RaceTables, requests: DataFrame, bad_values: str = "fail") -> DataFrame:
    """Per request (horse_id, track_type, track_condition, as_of): the horse's
    sire and what the sire's runners had done under that track and going before
    the day.  Unknown horse: NULL sire, counts 0.  A rank among all sires is not
    given: it would need every sire's record at every requested day."""
    sires = horse_sires(t)
    known = requests.withColumn(AS_OF, F.col(AS_OF).cast("date")).join(
        sires, F.col("horse_id") == F.col("_horse_id"), "left").drop("_horse_id")
    totals = totals_before(rated_runners(t, with_sire=True, bad_values=bad_values), SIRE_KEYS, known)
    # requests without a sire get join keys of their own, so that they are not one task
    known = known.withColumn("_sire", F.coalesce("sire_id", F.concat(F.lit("?"), F.col("horse_id"))))
    met = known.join(totals.withColumnRenamed("sire_id", "_sire"), ["_sire", "track_type", "track_condition", AS_OF], "left")
    return met.select(*requests.columns, "sire_id", "sire_name", *[x.alias(f"sire_track_{n}") for n, x in zip(
        SIRE_METRICS, _metrics(SIRE_METRICS), strict=True)])

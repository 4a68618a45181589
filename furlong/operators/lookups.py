"""Batch feature lookups (Q5-Q7).

A point lookup ("this jockey under this course condition", "this horse's
sire on this going") becomes a join of a request table with an aggregate,
so any number of requests costs one job:

* the request keys cut the scan first (``prune``): runners are semi-joined with
  the requested jockeys, races with the requested courses or classes, below the
  runner-race join and the aggregate.  Where the requests name most of what
  there is, this only reads them more often: the caller says
  ``prune=False``, with the same result;
* requests are joined to the aggregate with left joins; adaptive execution
  broadcasts whichever side measures small, otherwise the join is sort-merge;
* duplicate requests are answered once and joined back, so every request
  row gets exactly one answer row.

Target leakage: as in the source, records and ranks span all history, races
on and after the day being scored included.  They describe an entity; they
are not features to train on.  For those, :mod:`furlong.operators.as_of`
counts only races before the day of the request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furlong.functions import buckets as B
from furlong.functions.buckets import course_code
from furlong.functions.filters import is_rated
from furlong.functions.metrics import (
    N, ODDS_SUM, WINS, metric_columns, ratio2, roi_hundredths, win_rate_hundredths,
)
from furlong.functions.rounding import exact_ratio, from_hundredths
from furlong.operators.roi import roi_totals
from furlong.operators.runners import rated_runners, runner_columns
from furlong.schema import RaceTables

SIRE_KEYS = ("sire_id", "track_type", "track_condition")
RANK_MIN_RACES = 20


# --- Q7 ---------------------------------------------------------------------

def _by_exact_roi() -> list[Column]:
    # Unrounded ROI (exact decimal quotient), ties broken by sire id.
    return [exact_ratio(F.col(ODDS_SUM), F.col(N)).desc(), F.col("sire_id").asc_nulls_last()]


def sire_track_totals(t: RaceTables, since_year: int | None = None,
                      exclude_unknown_sire: bool = False,
                      bad_values: str = "fail") -> DataFrame:
    """Totals per sire × track type × going over all rated runners."""
    rated = rated_runners(t, since_year, with_sire=True,
                          exclude_unknown_sire=exclude_unknown_sire, bad_values=bad_values)
    return roi_totals(rated, SIRE_KEYS)


RANK_GROUP = ("track_type", "track_condition")


def _roi_ranked(qualifying: DataFrame) -> DataFrame:
    """``qualifying`` totals with ``roi_rank``: the row number by unrounded ROI
    (ties by sire id) within each track type and going.

    There are about fifteen such groups, each as large as the number of sires.
    So a group is cut into buckets that follow its order: the sizes of the
    buckets before give a bucket its offset, and rows are numbered within a
    bucket.  The buckets are whole percents of ROI.  Only sires that all have
    the same ROI are also cut by the first characters of their ids, since ids
    come after ROI in the order: those at exactly zero (many sires have no
    winner), in a bucket apart from other ROIs below one percent, and those
    without a ROI (only unreadable odds), who come last.  The bucket sizes are
    one more aggregate over the totals' exchange; only they meet per group."""
    last = 2**63 - 1
    tied = F.coalesce(F.col(ODDS_SUM) == 0, F.lit(True))
    bucket = [F.coalesce(-F.floor(roi_hundredths() / 100), F.lit(last)).alias("_b_roi"),
              F.coalesce(-F.signum(ODDS_SUM).cast("int"), F.lit(0)).alias("_b_sign"),
              (tied & F.col("sire_id").isNull()).alias("_b_null"),
              F.when(tied, F.coalesce(F.substring("sire_id", 1, 7), F.lit(""))).otherwise("").alias("_b_id")]
    order = ["_b_roi", "_b_sign", "_b_null", "_b_id"]
    rows = qualifying.select("*", *bucket)
    keys = [*RANK_GROUP, *order]
    ahead = (Window.partitionBy(*RANK_GROUP).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, -1))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_b_n")).withColumn(
        "_b_before", F.coalesce(F.sum("_b_n").over(ahead), F.lit(0))).drop("_b_n")
    inside = Window.partitionBy(*keys).orderBy(*_by_exact_roi())
    return rows.join(sizes, keys).withColumn(
        "roi_rank", (F.col("_b_before") + F.row_number().over(inside)).cast("long")).drop(
        *order, "_b_before")


def sire_track_roi_rank(t: RaceTables, min_races: int = RANK_MIN_RACES,
                        since_year: int | None = None,
                        exclude_unknown_sire: bool = False,
                        bad_values: str = "fail") -> DataFrame:
    """Every sire's ROI rank within each track type × going (Q7)."""
    totals = sire_track_totals(t, since_year, exclude_unknown_sire, bad_values)
    ranked = _roi_ranked(totals.where(F.col(N) >= F.lit(min_races)))
    return ranked.select(
        *SIRE_KEYS,
        *metric_columns(["total_races", "roi_percentage"]),
        "roi_rank",
    )


# --- Q6 ---------------------------------------------------------------------

def horse_sires(t: RaceTables) -> DataFrame:
    """One sire per horse id (a duplicated horse row keeps the smallest
    sire id, then the smallest name)."""
    return (t.horses
            .groupBy(F.col("ketto_toroku_bango").alias("_horse_id"))
            .agg(F.min(F.struct(F.col("ketto_joho_01a").alias("sire_id"),
                                F.trim("ketto_joho_01b").alias("sire_name"))).alias("_s"))
            .select("_horse_id", "_s.sire_id", "_s.sire_name"))


def _in_requested_classes(t: RaceTables, requests: DataFrame) -> RaceTables:
    """The races of the requested track type × going classes only."""
    wanted = requests.select(F.col("track_type").alias("_type"), F.col("track_condition").alias("_going")).distinct()
    track, shiba, dirt = F.col("track_code"), F.col("babajotai_code_shiba"), F.col("babajotai_code_dirt")
    races = t.races.join(wanted, (B.track_type(track) == F.col("_type"))
                         & (B.track_condition(track, shiba, dirt) == F.col("_going")), "left_semi")
    return RaceTables(races, t.runners, t.horses)


def horse_sire_track_roi_feature(
    t: RaceTables,
    requests: DataFrame,
    min_races: int = RANK_MIN_RACES,
    since_year: int | None = None,
    exclude_unknown_sire: bool = False,
    bad_values: str = "fail",
    prune: bool = True,
) -> DataFrame:
    """Per request (horse_id, track_type, track_condition): the horse's sire,
    the sire's ROI / win rate / runs under that track and going, and the
    sire's ROI rank there (Q6).

    Unknown horse: NULL sire name and zeros.  Known horse, no runs of the
    sire in that class: zeros.  Below ``min_races``: rank 0.  Only races of
    requested classes are read into the totals; the rank in a class needs all
    its sires, but only those that qualify.
    """
    seen = _in_requested_classes(t, requests) if prune else t
    totals = sire_track_totals(seen, since_year, exclude_unknown_sire, bad_values)
    ranked = _roi_ranked(totals.where(F.col(N) >= F.lit(min_races))).select(
        F.struct(*SIRE_KEYS).alias("_key"), "roi_rank")
    answers = totals.select(
        *SIRE_KEYS,
        F.col(N).alias("_n"),
        *metric_columns(["roi_percentage", "win_rate"]),
    ).withColumn("_key0", F.struct(*SIRE_KEYS))
    answers = answers.join(ranked, F.col("_key0") == F.col("_key"), "left").drop("_key", "_key0")
    req = requests.join(horse_sires(t), requests["horse_id"] == F.col("_horse_id"), "left")
    req = req.drop("_horse_id")
    # Requests without a sire have no answer: a key of their own spreads them
    # over the join's tasks instead of one task for NULL.
    lost = F.concat(F.lit("?"), F.col("horse_id"))
    req = req.withColumn("_sire_key", F.coalesce(F.col("sire_id"), lost)).drop("sire_id")
    joined = req.join(answers.withColumnRenamed("sire_id", "_sire_key"),
                      ["_sire_key", "track_type", "track_condition"], "left")
    return joined.select(
        *[F.col(c) for c in requests.columns],
        F.col("sire_name"),
        F.coalesce(F.col("roi_percentage"), F.lit(0.0)).alias("sire_track_roi"),
        F.coalesce(F.col("win_rate"), F.lit(0.0)).alias("sire_track_win_rate"),
        F.coalesce(F.col("_n"), F.lit(0).cast("long")).alias("sire_track_races"),
        F.coalesce(F.col("roi_rank"), F.lit(0).cast("long")).alias("sire_track_roi_rank"),
    )


# --- Q5 ---------------------------------------------------------------------

JOCKEY_REQUEST = ("jockey_id", "course_name", "track_type", "distance_category")
COURSE_METRICS = (
    "total_races", "wins", "top3_finishes", "win_rate", "top3_rate", "roi_percentage",
    "avg_win_odds", "avg_popularity", "middle_odds_wins", "longshot_wins",
)


def _no_data() -> dict[str, Column]:
    """What a request without data gets: the reference's defaults for the
    twelve keys it fills; the other answer columns stay NULL."""
    return {
        "jockey_name": F.lit(""),
        "total_races": F.lit(0).cast("long"),
        "wins": F.lit(0).cast("long"),
        "win_rate": F.lit(0.0),
        "roi_percentage": F.lit(0.0),
        "avg_win_odds": F.lit(0.0),
        "course_aptitude_index": F.lit(0.0),
        "win_rate_ratio": F.lit(0.0),
    }


ANSWER_COLUMNS = (
    "jockey_name", *COURSE_METRICS, "all_total_races", "all_win_rate",
    "all_roi_percentage", "course_aptitude_index", "win_rate_ratio",
)


JOCKEY_KEYS = ("jockey_id", "jockey_name")
CONDITION_KEYS = ("keibajo_code", "track_type", "distance_category")


def _overall_records(runners: DataFrame, bad_values: str) -> DataFrame:
    """The overall record of every jockey id: all rated runner rows, whether or
    not their race is known (no race join), under the name with the most."""
    rated = runners.where(is_rated(F.col("kakutei_chakujun"), F.col("tansho_odds"))).select(
        *runner_columns(bad_values))
    record = F.struct(F.col(N).alias("n"), F.col(WINS).alias("wins"), F.col(ODDS_SUM).alias("odds"))
    return (roi_totals(rated, JOCKEY_KEYS).groupBy("jockey_id")
            .agg(F.min_by(record, F.struct(-F.col(N), F.col("jockey_name"))).alias("_best")))


def jockey_course_feature(t: RaceTables, requests: DataFrame,
                          bad_values: str = "fail", prune: bool = True) -> DataFrame:
    """Per request (jockey_id, course_name, track_type, distance_category):
    the jockey's record under that condition next to the jockey's overall
    record, with two ratios of the rounded rates (Q5).

    ``course_name`` may be a course name or a raw course code.  A jockey
    whose name changed has one group per name on both sides; the answer is
    the row with the most conditioned runs, then the smallest name, then the
    most overall runs, then the smallest overall name.
    """
    keys = list(JOCKEY_REQUEST)
    distinct_req = requests.select(*keys).distinct().withColumn(
        "keibajo_code", course_code(F.col("course_name")))

    runners, races = t.runners, t.races
    if prune:
        jockeys = distinct_req.select(F.col("jockey_id").alias("_jockey")).distinct()
        courses = distinct_req.select(F.col("keibajo_code").alias("_course")).distinct()
        runners = runners.join(jockeys, F.col("kishu_code") == F.col("_jockey"), "left_semi")
        races = races.join(courses, F.col("keibajo_code") == F.col("_course"), "left_semi")
    rated = rated_runners(RaceTables(races, runners, t.horses), bad_values=bad_values)
    cond = roi_totals(rated, [*JOCKEY_KEYS, *CONDITION_KEYS]).select(
        *JOCKEY_KEYS, *CONDITION_KEYS,
        *metric_columns(COURSE_METRICS),
        roi_hundredths().alias("_roi_h"),
        win_rate_hundredths().alias("_win_h"),
    )
    overall = _overall_records(runners, bad_values).select(
        "jockey_id",
        F.col("_best.n").alias("all_total_races"),
        roi_hundredths(F.col("_best.odds"), F.col("_best.n")).alias("_all_roi_h"),
        win_rate_hundredths(F.col("_best.wins"), F.col("_best.n")).alias("_all_win_h"),
    )
    candidates = distinct_req.join(
        cond, ["jockey_id", "keibajo_code", "track_type", "distance_category"]).join(overall, "jockey_id")
    answer = F.struct(
        F.col("jockey_name"),
        *[F.col(m) for m in COURSE_METRICS],
        F.col("all_total_races"),
        from_hundredths(F.col("_all_win_h")).alias("all_win_rate"),
        from_hundredths(F.col("_all_roi_h")).alias("all_roi_percentage"),
        ratio2(F.col("_roi_h"), F.col("_all_roi_h")).alias("course_aptitude_index"),
        ratio2(F.col("_win_h"), F.col("_all_win_h")).alias("win_rate_ratio"),
    )
    preference = F.struct(-F.col("total_races"), F.col("jockey_name"))
    best = (candidates.groupBy(*keys)
            .agg(F.min_by(answer, preference).alias("_a"))
            .select(*keys, F.lit(True).alias("_found"), "_a.*"))

    joined = requests.join(best, keys, "left")
    found = F.col("_found").isNotNull()
    defaults = _no_data()
    out: list[Column] = [F.col(c) for c in requests.columns]
    for c in ANSWER_COLUMNS:
        if c in defaults:
            out.append(F.when(found, F.col(c)).otherwise(defaults[c]).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)

"""The four ROI reports (Q1-Q4), each one use of :func:`roi_by`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.operators.roi import roi_by
from furlong.operators.runners import rated_runners
from furlong.schema import RaceTables


def _by_roi(keys: tuple[str, ...]) -> list:
    """Highest ROI first; equal ROIs (many groups have none) by group key, so
    the order is total and a range sort can split them."""
    return [F.col("roi_percentage").desc(), *[F.col(k) for k in keys]]


SIRE_TRACK_METRICS = (
    "total_races", "wins", "win_rate", "roi_percentage", "avg_win_odds",
    "avg_popularity", "longshot_wins",
)
JOCKEY_COURSE_METRICS = (
    "total_races", "wins", "top3_finishes", "win_rate", "top3_rate",
    "roi_percentage", "avg_win_odds", "avg_popularity", "middle_odds_wins",
    "longshot_wins",
)
JOCKEY_POPULARITY_METRICS = (
    "total_races", "wins", "top3_finishes", "win_rate", "top3_rate",
    "roi_percentage", "avg_win_odds",
)
JOCKEY_SURFACE_METRICS = (
    "total_races", "wins", "top3_finishes", "win_rate", "top3_rate",
    "roi_percentage", "avg_win_odds", "avg_popularity", "non_favorite_wins",
)


def sire_track_condition_roi(
    t: RaceTables, since_year: int = 2000, min_races: int = 20, bad_values: str = "fail"
) -> DataFrame:
    """ROI per sire × track type × going (Q1).  Runners of horses whose sire
    is unknown are left out."""
    rated = rated_runners(t, since_year, with_sire=True, exclude_unknown_sire=True,
                          bad_values=bad_values)
    keys = ("sire_id", "sire_name", "track_type", "track_condition")
    return roi_by(rated, keys, SIRE_TRACK_METRICS, min_races, _by_roi(keys))


def jockey_course_roi(
    t: RaceTables, since_year: int = 2000, min_races: int = 20, bad_values: str = "fail"
) -> DataFrame:
    """ROI per jockey × course × track type × distance class (Q2)."""
    rated = rated_runners(t, since_year, bad_values=bad_values)
    keys = ("jockey_id", "jockey_name", "course_name", "track_type", "distance_category")
    return roi_by(rated, keys, JOCKEY_COURSE_METRICS, min_races, _by_roi(keys))


def jockey_popularity_roi(
    t: RaceTables, since_year: int = 2000, min_races: int = 20, bad_values: str = "fail"
) -> DataFrame:
    """ROI per jockey × betting-rank class (Q3); runners without a rank are
    left out (one that is not a number, with ``bad_values='null'``, is not:
    the source tests the raw text)."""
    rated = rated_runners(t, since_year, bad_values=bad_values, carry=("tansho_ninkijun",)).where(
        F.col("tansho_ninkijun").isNotNull())
    keys = ("jockey_id", "jockey_name", "popularity_category")
    return roi_by(rated, keys, JOCKEY_POPULARITY_METRICS, min_races,
                  [F.col("popularity_category"), *_by_roi(keys)])


def jockey_surface_condition_roi(
    t: RaceTables, since_year: int = 2000, min_races: int = 20, bad_values: str = "fail"
) -> DataFrame:
    """ROI per jockey × track type × going (Q4)."""
    rated = rated_runners(t, since_year, bad_values=bad_values).withColumnRenamed(
        "track_condition", "surface_condition")
    keys = ("jockey_id", "jockey_name", "track_type", "surface_condition")
    return roi_by(rated, keys, JOCKEY_SURFACE_METRICS, min_races, _by_roi(keys))

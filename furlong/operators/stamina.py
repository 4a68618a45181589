"""Stamina slope: how a horse's score changes with the distance (ours).

The source documents a stamina index for long races without a formula.  This
one is our definition: the least-squares slope of a caller-named whole-number
score on the distance in hundreds of metres, over a horse's rated runs,
pulled towards the slope of all runs of its sire's offspring:

    index = (n * slope + prior * sire_slope) / (n + prior)

The regression is five additive sums (n, x, y, xy, xx) in exact longs, merged
map-side like the other totals; horse sums merge to sire sums.  A slope is one
quotient of exact products.  Without two different distances there is no
slope: a horse then has its sire's index, and without that NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.operators.lookups import horse_sires
from furlong.operators.runners import _caster, rated_runners
from furlong.schema import RACE_KEY, RaceTables

SUMS = ("_n", "_x", "_y", "_xy", "_xx")
METRES = 100


def regression_columns(x: Column, y: Column) -> list[Column]:
    """The five sums of the pairs in which neither is NULL."""
    both = x.isNotNull() & y.isNotNull()
    values = (F.lit(1).cast("long"), x, y, x * y, x * x)
    return [F.coalesce(F.sum(F.when(both, v)), F.lit(0).cast("long")).alias(c) for c, v in zip(SUMS, values, strict=True)]


def slope(prefix: str = "") -> Column:
    """(n Σxy - Σx Σy) / (n Σx² - (Σx)²) of the sums; NULL without spread."""
    n, x, y, xy, xx = (F.col(f"{prefix}{c}").cast("decimal(19,0)") for c in SUMS)
    spread = n * xx - x * x
    return F.when(spread != 0, (n * xy - x * y).cast("double") / spread.cast("double"))


def stamina_index(t: RaceTables, score: str, prior: int = 10, since_year: int | None = None, bad_values: str = "fail") -> DataFrame:
    """Per horse with a rated run: ``horse_id``, ``sire_id``, ``runs`` (with a
    score and a distance), ``slope``, ``sire_runs``, ``sire_slope`` and
    ``stamina_index``, in score per 100 m.  ``score`` names a runner column of
    whole numbers (text); a horse of a doubled race counts in both."""
    cast = _caster(bad_values)
    rated = rated_runners(t, since_year, bad_values=bad_values, carry=(score, "kyori"))
    x = F.call_function("div", cast(F.col("kyori"), "bigint"), F.lit(METRES)).cast("long")
    sums = rated.groupBy("horse_id").agg(*regression_columns(x, cast(F.col(score), "bigint")))
    horses = sums.join(horse_sires(t).select("_horse_id", "sire_id"), F.col("horse_id") == F.col("_horse_id"), "left").drop("_horse_id")
    of_sire = horses.where(F.col("sire_id").isNotNull()).groupBy(F.col("sire_id").alias("_sire")).agg(
        *[F.sum(c).alias(f"_s{c}") for c in SUMS])
    met = horses.join(of_sire, F.col("sire_id") == F.col("_sire"), "left")
    met = met.select("horse_id", "sire_id", F.col("_n").alias("runs"), slope().alias("slope"),
                     F.col("_s_n").alias("sire_runs"), slope("_s").alias("sire_slope"))
    n, k = F.col("runs").cast("double"), F.lit(float(prior))
    pulled = (n * F.col("slope") + k * F.col("sire_slope")) / (n + k)
    return met.withColumn("stamina_index", F.coalesce(pulled, F.col("slope"), F.col("sire_slope")))

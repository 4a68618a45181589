"""Features of the three-generation pedigree: inbreeding and line crosses.

The source names features of a three-generation pedigree without a formula;
these are our definitions.  Ancestors are those of :mod:`pedigree` up to the
great-grandparents (parents, and what the last generation records as its
parents): seven on the sire's side, seven on the dam's.

Inbreeding is Wright's coefficient over these generations, common ancestors
taken as not inbred themselves:

    F = sum over pairs of paths of (1/2) ** (n1 + n2 + 1)

where a pair is a path from the sire and one from the dam, of n1 and n2 steps
(0 to 2), that meet in one ancestor and share no horse before it.  It is
summed in thirty-seconds, so it is exact.

Plan: the ancestors of a horse become one row (a bounded aggregate, like the
tree); pairs are found inside the row, 49 at most, and never join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.functions.filters import known_parent
from furlong.operators.pedigree import HORSE_KEY, MAX_DEPTH, _expand
from furlong.operators.roi import roi_by
from furlong.operators.runners import rated_runners
from furlong.schema import RaceTables

SIDES = {"1": "sire_id", "2": "dam_id"}
CHILDREN = ("1", "11", "12", "111", "112", "121", "122")
UNITS = 32  # the closest pair of paths, sire and dam being one horse, counts 16 of them


def ancestors(t: RaceTables, horses: DataFrame, key: str = HORSE_KEY) -> DataFrame:
    """One row per requested horse that is known: ``root_id`` and the ids of its
    fourteen ancestors, columns named by position (``p11`` the sire, ``p12`` the
    dam, ``p112`` the sire's dam ...); unknown ones are NULL."""
    rows = _expand(t, horses.select("horse_id").distinct(), MAX_DEPTH, keep_unknown=False, key=key)
    parents = F.struct("sire_id", "dam_id")
    slots = rows.groupBy("root_id").agg(*[F.min(F.when(F.col("position") == p, parents)).alias(f"of{p}") for p in CHILDREN])
    return slots.select("root_id", *[
        F.when(known_parent(F.col(f"of{p}.{c}")), F.col(f"of{p}.{c}")).alias(f"p{p}{s}") for p in CHILDREN for s, c in SIDES.items()])


def _paths(side: str) -> Column:
    """The known ancestors of one side: id, steps from the parent, and the horses
    on the way."""
    positions = [p for p in (c + s for c in CHILDREN for s in SIDES) if p.startswith(side)]
    paths = [F.struct(F.col(f"p{p}").alias("id"), F.lit(len(p) - 2).alias("steps"),
                      F.array(*[F.col(f"p{p[:k]}") for k in range(2, len(p))]).cast("array<string>").alias("way")) for p in positions]
    return F.filter(F.array(*paths), lambda x: x["id"].isNotNull())


def inbreeding(t: RaceTables, horses: DataFrame, key: str = HORSE_KEY) -> DataFrame:
    """Per requested horse that is known: ``horse_id``, ``common_ancestors``
    (different ones in which paths meet), ``path_pairs``, ``inbreeding_32nds``,
    ``inbreeding``, and the ends of its male and female lines (``sire_line_id``,
    ``dam_line_id``: the furthest known of sire's sire's sire and dam's dam's
    dam)."""
    rows = ancestors(t, horses, key).withColumns({"_sires": _paths("11"), "_dams": _paths("12")})
    met = F.flatten(F.transform("_sires", lambda s: F.transform(
        F.filter("_dams", lambda d: (d["id"] == s["id"]) & ~F.arrays_overlap(s["way"], d["way"])),
        lambda d: F.struct(s["id"].alias("id"), (s["steps"] + d["steps"]).alias("steps")))))
    rows = rows.withColumn("_met", met)
    share = F.aggregate("_met", F.lit(0).cast("long"), lambda x, m: x + F.call_function("div", F.lit(UNITS // 2), F.pow(F.lit(2), m["steps"]).cast("long")))
    return rows.select(
        F.col("root_id").alias("horse_id"),
        F.size(F.array_distinct(F.transform("_met", lambda m: m["id"]))).cast("long").alias("common_ancestors"),
        F.size("_met").cast("long").alias("path_pairs"),
        share.alias("inbreeding_32nds"), (share.cast("double") / F.lit(float(UNITS))).alias("inbreeding"),
        F.coalesce("p1111", "p111", "p11").alias("sire_line_id"), F.coalesce("p1222", "p122", "p12").alias("dam_line_id"))


CROSS_METRICS = ("total_races", "wins", "win_rate", "roi_percentage", "avg_win_odds")


def line_cross_roi(t: RaceTables, since_year: int = 2000, min_races: int = 20, bad_values: str = "fail",
                   key: str = HORSE_KEY) -> DataFrame:
    """ROI per cross of lines: the horse's sire's sire × its dam's sire (horses of
    which either is unknown are left out)."""
    registered = t.horses.select(F.col(key).alias("horse_id"))
    crosses = ancestors(t, registered, key).select(
        F.col("root_id").alias("_horse"), F.col("p111").alias("sire_sire_id"), F.col("p121").alias("dam_sire_id"))
    crosses = crosses.where(F.col("sire_sire_id").isNotNull() & F.col("dam_sire_id").isNotNull())
    rated = rated_runners(t, since_year, bad_values=bad_values)
    rated = rated.join(crosses, F.col("horse_id") == F.col("_horse")).drop("_horse")
    keys = ("sire_sire_id", "dam_sire_id")
    return roi_by(rated, keys, CROSS_METRICS, min_races, [F.col("roi_percentage").desc(), *[F.col(k) for k in keys]])

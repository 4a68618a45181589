"""Names over time: which name an id went by on a day.

Jockeys and stables keep their id when their name changes, and every runner
row carries the name of its day.  From these the validity of names is read
off: one name per id and day (that of the day's last race), runs of days with
one name, each valid until the day before the next name appears.  A name that
comes back has an interval of its own; before its first day an id has none.

Plan: rows become one per id and day first, so a hot id has no more rows than
the calendar has days.  Lookups are an equi-join on id and year, an interval
standing once in each year it touches, with the day compared inside: a request
meets only the intervals of its id in its year, and at most one holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furlong.operators.as_of import race_day
from furlong.schema import RaceTables


def name_intervals(runners: DataFrame, id_col: str = "kishu_code", name_col: str = "kishumei_ryakusho") -> DataFrame:
    """``entity_id, name, valid_from, valid_to`` (first day of the next name; NULL
    for the present one).  Names are trimmed; rows without an id, a name or a
    valid day say nothing.  Of the names of one day that of the last race (by
    course, race number, then name) holds."""
    rows = runners.select(F.col(id_col).alias("entity_id"), F.trim(name_col).alias("name"), race_day().alias("day"),
                          F.struct("keibajo_code", "race_bango", F.trim(name_col)).alias("_last"))
    rows = rows.where(F.col("entity_id").isNotNull() & F.col("name").isNotNull() & F.col("day").isNotNull())
    daily = rows.groupBy("entity_id", "day").agg(F.max_by("name", "_last").alias("name"))
    of_id = Window.partitionBy("entity_id").orderBy("day")
    starts = daily.withColumn("_before", F.lag("name").over(of_id)).where(
        F.col("_before").isNull() | (F.col("_before") != F.col("name")))
    return starts.select("entity_id", "name", F.col("day").alias("valid_from"), F.lead("day").over(of_id).alias("valid_to"))


def names_on(requests: DataFrame, intervals: DataFrame, id_col: str, as_of: str = "as_of") -> DataFrame:
    """``requests`` with ``name``, ``valid_from`` and ``valid_to`` of the interval
    that holds on the day ``as_of`` (NULL if there is none).  Runs one job for
    the last requested day, up to which open intervals are cut into years."""
    last = requests.agg(F.max(F.col(as_of).cast("date"))).first()[0]
    until = F.year(F.coalesce(F.date_sub("valid_to", 1), F.lit(last).cast("date"), F.col("valid_from")))
    cut = intervals.select(
        F.col("entity_id").alias("_id"), "name", "valid_from", "valid_to",
        F.explode(F.sequence(F.year("valid_from"), F.greatest(F.year("valid_from"), until))).alias("_year"))
    day = F.col(as_of).cast("date")
    holds = (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (day < F.col("valid_to")))
    return requests.join(cut, (F.col(id_col) == F.col("_id")) & (F.year(day) == F.col("_year")) & holds, "left").drop("_id", "_year")


def jockey_names_on(t: RaceTables, requests: DataFrame) -> DataFrame:
    """Per request (jockey_id, as_of): the jockey's name on that day."""
    return names_on(requests, name_intervals(t.runners), "jockey_id").withColumnRenamed("name", "jockey_name")

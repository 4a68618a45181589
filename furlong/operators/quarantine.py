"""Quarantine of bad values: good rows, rejects with reasons, and counts.

Rated runners whose odds, betting rank or distance is text that is no number
stop a report (``bad_values='fail'``) or count without the value (``'null'``).
Here they are set apart instead: one pass over the runners gives every rated
runner of a known race the reasons that speak against it, and writes good
rows and rejects into two directories of one table.  Counts are observed
while it is written (``DataFrame.observe``), not by another scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from furlong.functions.filters import is_rated
from furlong.operators.runners import ODDS_TYPE, _TOO_FINE, rated_runners
from furlong.schema import RACE_KEY, RaceTables

#: Reason -> (column, test that the text is bad), in the order they are listed.
BAD = {
    "odds are no number": ("tansho_odds", lambda c: c.try_cast(ODDS_TYPE).isNull()),
    "odds are finer than hundredths": ("tansho_odds", lambda c: c.try_cast(ODDS_TYPE).isNotNull() & c.rlike(_TOO_FINE)),
    "betting rank is no number": ("tansho_ninkijun", lambda c: c.try_cast("int").isNull()),
    "distance is no number": ("kyori", lambda c: c.try_cast("int").isNull()),
}
RAW = ("ketto_toroku_bango", "kishu_code", "kakutei_chakujun", "tansho_odds", "tansho_ninkijun", "kyori")


def reasons() -> Column:
    """Array of the reasons against a rated runner with its race's distance; NULL
    texts are missing values, not bad ones."""
    found = [F.when(F.col(c).isNotNull() & test(F.col(c)), F.lit(reason)) for reason, (c, test) in BAD.items()]
    return F.filter(F.array(*found), lambda r: r.isNotNull())


@dataclass(frozen=True)
class Screened:
    """``good``: rated runners as :func:`rated_runners` gives them; ``rejects``: race
    key, the raw columns and ``reasons``; ``counts``: rows seen, and rows by reason."""

    good: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def screen(t: RaceTables, path: str, since_year: int | None = None, fmt: str = "parquet") -> Screened:
    """Writes the rated runners of known races under ``path`` and returns both
    sides of them.  Good and rejected rows add up to all rated runners; a row
    with several bad values is one reject with several reasons."""
    rated = rated_runners(t, since_year, bad_values="null", carry=RAW)
    kept = [c for c in rated.columns if c not in RAW]
    rows = rated.withColumn("reasons", reasons()).withColumn("rejected", F.size("reasons") > 0)
    seen = Observation("screened")
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rated"), F.count(F.when(F.col("rejected"), 1)).alias("rejected"),
                        *[F.count(F.when(F.array_contains("reasons", r), 1)).alias(r) for r in BAD])
    rows.write.format(fmt).partitionBy("rejected").save(path)
    spark = rows.sparkSession
    schema = rows.drop("rejected").schema.add("rejected", "boolean")
    back = spark.read.format(fmt).schema(schema).load(path)
    return Screened(back.where(~F.col("rejected")).select(*kept),
                    back.where("rejected").select(*RACE_KEY, *RAW, "reasons"), dict(seen.get))

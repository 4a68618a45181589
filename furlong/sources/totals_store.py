"""A store of additive totals per key and race day.

All metrics are made of counts and sums that merge, so a report over years of
races needs the totals of each day once.  The store keeps them as Parquet,
one directory per month; new races add days, a corrected result replaces its
day, and reports read totals instead of runs.

* A load holds whole days: all rated runs of each day it names.  It writes the
  months of these days anew, from its own totals and from what the store has
  of their other days, and touches no other month.
* Loading is idempotent: a day's totals are those of the last load that named
  it, so loading a day again, or running a failed load again, leaves the same.
  A day that is loaded without any run left is cleared: every loaded day has a
  marker row, so its month is always written.
* Days are text (yyyymmdd), compared as text like the year filter of the
  reports; reads are pruned to the wanted months.
* The new directories take the place of the old ones when all are written.  A
  reader that runs at that moment may miss one of them; loads of the same
  month must not run at the same time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from furlong.functions.metrics import TOTALS, merge_columns
from furlong.operators.roi import finish, roi_totals
from furlong.plans.session import shared_checkpoint_dir

DAY, MONTH = "race_day", "race_month"
_MARK = "_loaded"


def race_day_text() -> Column:
    return F.concat("kaisai_nen", "kaisai_tsukihi")


def new_folder(spark: SparkSession, what: str = "totals") -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    base = shared_checkpoint_dir(spark)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/furlong/{what}-{uuid.uuid4().hex}"


class TotalsStore:
    """Totals of rated runs by ``keys`` (text columns of the rated runners) and
    race day, under ``path``."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.schema = StructType([
            *[StructField(k, StringType()) for k in self.keys], *[StructField(c, LongType()) for c in TOTALS],
            StructField(_MARK, BooleanType()), StructField(DAY, StringType()), StructField(MONTH, StringType())])

    def replace_days(self, rated: DataFrame, days: DataFrame | None = None) -> None:
        """The totals of ``days`` (column ``race_day``; default: all days of
        ``rated``) become those of ``rated``, which holds all their rated runs;
        runs of other days are left out, other days of the store stay."""
        runs = rated.withColumn(DAY, race_day_text()).where(F.col(DAY).isNotNull())
        days = (runs if days is None else days.where(F.col(DAY).isNotNull())).select(DAY).distinct()
        totals = roi_totals(runs.join(days, DAY, "left_semi"), [*self.keys, DAY]).withColumn(_MARK, F.lit(False))
        marks = days.select(DAY, F.lit(True).alias(_MARK), *[F.lit(None).cast("string").alias(k) for k in self.keys],
                            *[F.lit(None).cast("long").alias(c) for c in TOTALS])
        rows = totals.unionByName(marks).withColumn(MONTH, F.substring(DAY, 1, 6)).select(*self.schema.fieldNames())
        if self._exists():
            # bounded by the calendar: a few hundred names of directories at most
            months = [r[0] for r in days.select(F.substring(DAY, 1, 6)).distinct().collect()]
            others = self._rows().where(F.col(MONTH).isin(months)).join(days, DAY, "left_anti")
            rows = rows.unionByName(others.select(*self.schema.fieldNames()))
        (rows.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(MONTH).parquet(self.path))

    def _exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def daily(self, since: str | None = None, before: str | None = None) -> DataFrame:
        """Totals by key and day, from day ``since`` (text prefix, for example a
        year) to the last before ``before``."""
        rows = self._rows().where(~F.col(_MARK)).drop(_MARK)
        if since is not None:
            rows = rows.where((F.col(DAY) >= since) & (F.col(MONTH) >= since[:6]))
        if before is not None:
            rows = rows.where((F.col(DAY) < before) & (F.col(MONTH) <= before[:6]))
        return rows.drop(MONTH)

    def totals(self, keys: Sequence[str], since: str | None = None, before: str | None = None) -> DataFrame:
        """Totals by some of the store's keys."""
        return self.daily(since, before).groupBy(*keys).agg(*merge_columns())

    def report(self, keys: Sequence[str], metrics: Sequence[str], since: str | None = None, before: str | None = None,
               min_races: int | None = None, order: Sequence[Column] | None = None) -> DataFrame:
        """The ROI report of :func:`furlong.operators.roi.roi_by`, from the stored totals."""
        return finish(self.totals(keys, since, before), keys, metrics, min_races, order)


#: Keys of a store that carries the jockey reports, and of one for the sires'.
JOCKEY_GRAIN = ("jockey_id", "jockey_name", "course_name", "track_type", "track_condition", "distance_category",
                "popularity_category")
SIRE_GRAIN = ("sire_id", "sire_name", "track_type", "track_condition")

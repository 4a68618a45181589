"""Properties that must hold on any data, checked on the
tables derived from the smallest driver data set."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from furlong.functions.metrics import METRIC_NAMES
from furlong.operators import lookups, pedigree, reports
from furlong.operators.roi import finish, roi_by, roi_totals, roll_up
from furlong.operators.runners import rated_runners
from furlong.schema import RaceTables
from furlong.sources import requests as R
from furlong.sources.fixtures import fixture_tables


@pytest.fixture(scope="module")
def t(spark):
    return fixture_tables(spark, SF_SMALL)


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_popularity_classes_partition_the_rated_runners(t):
    q3 = reports.jockey_popularity_roi(t, min_races=1)
    total = q3.agg(F.sum("total_races")).collect()[0][0]
    expected = (rated_runners(t, since_year=2000)
                .where(F.col("popularity").isNotNull()).count())
    assert total == expected


def test_counts_are_ordered(t):
    q2 = reports.jockey_course_roi(t, min_races=1)
    bad = q2.where((F.col("wins") > F.col("top3_finishes"))
                   | (F.col("top3_finishes") > F.col("total_races"))
                   | (F.col("middle_odds_wins") + F.col("longshot_wins") > F.col("wins")))
    assert bad.count() == 0


def test_coarser_report_is_roll_up_of_finer(t):
    rated = rated_runners(t, since_year=2000)
    fine = roi_totals(rated, ["jockey_id", "jockey_name", "course_name", "track_type",
                              "distance_category"])
    keys = ["jockey_id", "jockey_name"]
    merged = finish(roll_up(fine, keys), keys, METRIC_NAMES)
    direct = roi_by(rated, keys, METRIC_NAMES)
    assert _rows(merged) == _rows(direct)


def test_input_partitioning_changes_nothing(t):
    shuffled = RaceTables(t.races.repartition(7), t.runners.repartition(5, "kishu_code"),
                          t.horses.repartition(3))
    for report in (reports.sire_track_condition_roi, reports.jockey_course_roi):
        assert _rows(report(t, min_races=1)) == _rows(report(shuffled, min_races=1))
    assert _rows(lookups.sire_track_roi_rank(t, min_races=5)) == \
        _rows(lookups.sire_track_roi_rank(shuffled, min_races=5))


def test_batch_lookup_equals_single_lookups(spark, t):
    reqs = R.horse_requests(t).orderBy("horse_id", "track_type", "track_condition").limit(4)
    reqs = spark.createDataFrame(reqs.collect(), reqs.schema)
    batch = _rows(lookups.horse_sire_track_roi_feature(t, reqs))
    single = Counter()
    for row in reqs.collect():
        one = spark.createDataFrame([row], reqs.schema)
        single += _rows(lookups.horse_sire_track_roi_feature(t, one))
    assert batch == single

    jreqs = R.jockey_requests(t).orderBy("jockey_id", "course_name").limit(3)
    jreqs = spark.createDataFrame(jreqs.collect(), jreqs.schema)
    batch = _rows(lookups.jockey_course_feature(t, jreqs))
    single = Counter()
    for row in jreqs.collect():
        single += _rows(lookups.jockey_course_feature(t, spark.createDataFrame([row], jreqs.schema)))
    assert batch == single


def test_sire_feature_rank_equals_rank_table(t):
    q7 = {(r.sire_id, r.track_type, r.track_condition): r.roi_rank
          for r in lookups.sire_track_roi_rank(t).collect()}
    sire_of = {r.ketto_toroku_bango: r.ketto_joho_01a for r in t.horses.collect()}
    q6 = lookups.horse_sire_track_roi_feature(t, R.horse_requests(t))
    for r in q6.collect():
        want = q7.get((sire_of.get(r.horse_id), r.track_type, r.track_condition), 0)
        assert r.sire_track_roi_rank == want


def test_pedigree_rows_per_horse_bounded(t):
    rows = pedigree.pedigree_rows(t, R.registered_horses(t))
    worst = rows.groupBy("root_id").count().agg(F.max("count")).collect()[0][0]
    assert worst <= 7
    # a row's position length is its generation
    assert rows.where(F.length("position") != F.col("generation")).count() == 0


def test_lookups_without_pruning_are_the_same(t):
    horses, jockeys = R.horse_requests(t), R.jockey_requests(t)
    assert _rows(lookups.horse_sire_track_roi_feature(t, horses, prune=False)) == _rows(lookups.horse_sire_track_roi_feature(t, horses))
    assert _rows(lookups.jockey_course_feature(t, jockeys, prune=False)) == _rows(lookups.jockey_course_feature(t, jockeys))

"""Plan shape: pruning, pushdown, one aggregate per scan, no Python."""

from __future__ import annotations

import os
from collections import Counter

import pytest

from conftest import SF_SMALL
from furlong.operators import lookups, reports
from furlong.plans.inspect import final_tree, operator_count, plan_text, python_nodes, scans
from furlong.registry import QUERIES
from furlong.sources import requests as R
from furlong.sources.fixtures import fixture_tables
from furlong.sources.tables import read_race_tables, write_race_tables


@pytest.fixture(scope="module")
def stored(spark, scratch):
    base = os.path.join(scratch, "stored")
    write_race_tables(fixture_tables(spark, SF_SMALL), base)
    return read_race_tables(spark, base)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_in_plans(spark, name):
    assert python_nodes(QUERIES[name](spark, SF_SMALL)) == []


def test_partitioned_tables_round_trip(spark, stored):
    t = fixture_tables(spark, SF_SMALL)
    assert stored.runners.schema["kaisai_nen"].dataType.simpleString() == "string"
    t = t.select_known()
    assert Counter(map(tuple, stored.runners.collect())) == Counter(map(tuple, t.runners.collect()))
    assert stored.races.count() == t.races.count()


def test_year_filter_prunes_both_tables(stored):
    df = reports.jockey_course_roi(stored, since_year=2000)
    found = {s["Location"].split("/")[-1].rstrip("]"): s for s in scans(df)}
    for table in ("jvd_se", "jvd_ra"):
        pf = next(v for k, v in found.items() if k.startswith(table)).get("PartitionFilters", "")
        assert "kaisai_nen" in pf and "2000" in pf, (table, pf)


def test_filters_and_columns_reach_the_scan(stored):
    df = reports.sire_track_condition_roi(stored)
    runner_scan = next(s for s in scans(df) if "jvd_se" in s.get("Location", ""))
    assert "IsNotNull(tansho_odds)" in runner_scan["PushedFilters"]
    # only the columns the report needs are read
    assert "kishu_code" not in runner_scan["ReadSchema"]
    horse_scan = next(s for s in scans(df) if "jvd_um" in s.get("Location", ""))
    assert "bamei" not in horse_scan["ReadSchema"]
    assert "Not(EqualTo(ketto_joho_01a,0000000000))" in horse_scan["PushedFilters"]


def _local(spark, df):
    # a small request table given as data (its plan has no scan)
    return spark.createDataFrame(df.limit(20).collect(), df.schema)


def test_sire_feature_aggregates_runners_once(spark, stored):
    df = lookups.horse_sire_track_roi_feature(stored, _local(spark, R.horse_requests(stored)))
    df.collect()  # inspect the final adaptive plan
    # totals, ranks and bucket sizes share one pass over the runners
    runner_scans = [s for s in scans(df) if "jvd_se" in s.get("Location", "")]
    assert len(runner_scans) == 1
    tree = final_tree(df)
    assert "LeftSemi" in tree  # only races of requested classes


def test_rank_numbers_within_buckets(spark, stored):
    df = lookups.sire_track_roi_rank(stored)
    df.collect()
    assert len([s for s in scans(df) if "jvd_se" in s.get("Location", "")]) == 1
    # no window over a whole class: one numbers rows inside a bucket, one adds
    # up the buckets' sizes
    windows = [line for line in plan_text(df, "extended").splitlines() if "row_number()" in line and "Window" in line]
    assert windows and all("_b_roi" in w and "_b_id" in w for w in windows)


def test_jockey_feature_is_cut_by_its_requests(spark, stored):
    one = _local(spark, R.jockey_requests(stored).limit(1))
    df = lookups.jockey_course_feature(stored, one)
    df.collect()  # inspect the final adaptive plan
    tree = final_tree(df)
    assert "LeftSemi" in tree and "Window" not in tree
    # the overall record and the conditioned one read the runners, one each;
    # only the latter reads races
    assert len([s for s in scans(df) if "jvd_se" in s.get("Location", "")]) <= 2
    assert len([s for s in scans(df) if "jvd_ra" in s.get("Location", "")]) == 1


def _joins_written(df):
    """Joins of the analysed plan: as many as the operator asks for."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_pedigree_has_one_join_per_generation(spark, stored):
    from furlong.operators import pedigree
    horses = R.registered_horses(stored)
    assert _joins_written(pedigree.pedigree_rows(stored, horses)) == 3
    assert _joins_written(pedigree.pedigree_tree(stored, horses)) == 2


def test_pedigree_rows_are_ordered(spark, stored):
    from furlong.operators import pedigree
    rows = [(r["root_id"], r["generation"], r["position"])
            for r in pedigree.pedigree_rows(stored, R.registered_horses(stored)).collect()]
    assert rows == sorted(rows)


def test_reports_are_totally_ordered(stored):
    got = [(-r["roi_percentage"], r["sire_id"], r["sire_name"], r["track_type"], r["track_condition"])
           for r in reports.sire_track_condition_roi(stored, min_races=1).collect()]
    assert got == sorted(got)


def test_jdbc_reads_runners_in_parts(spark):
    from furlong.sources.tables import read_race_tables_jdbc, year_predicates
    parts = year_predicates(1998, 2000)
    assert parts == ["kaisai_nen < '1998'", "kaisai_nen = '1998'", "kaisai_nen = '1999'", "kaisai_nen = '2000'",
                     "kaisai_nen > '2000'", "kaisai_nen IS NULL"]
    with pytest.raises(ValueError):
        read_race_tables_jdbc(spark, "jdbc:none", {}, {})
    with pytest.raises(ValueError):
        read_race_tables_jdbc(spark, "jdbc:none", {}, {"runners": ["1 = 1"]})
    with pytest.raises(ValueError):
        read_race_tables_jdbc(spark, "jdbc:none", {}, {"runners": parts, "riders": parts})


def test_bucketed_tables_join_without_shuffle(spark, scratch):
    from furlong.sources.tables import catalog_race_tables, save_race_tables

    spark.sql("CREATE DATABASE IF NOT EXISTS furlong_test")
    save_race_tables(fixture_tables(spark, SF_SMALL), "furlong_test", buckets=4,
                     location=os.path.join(scratch, "bucketed"), mode="overwrite")
    t = catalog_race_tables(spark, "furlong_test")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    prev_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = reports.jockey_course_roi(t, min_races=1)
        rows = Counter(map(tuple, df.collect()))
        tree = final_tree(df)
        # sort-merge join fed straight by the two bucketed scans: the only
        # exchanges are the aggregate's and the final sort's
        assert "SortMergeJoin" in tree
        assert operator_count(df, "Exchange") == 2, tree
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", prev_aqe)
    assert rows == Counter(map(tuple, reports.jockey_course_roi(
        fixture_tables(spark, SF_SMALL), min_races=1).collect()))


def test_pedigree_tree_reads_requests_once(spark, stored):
    from furlong.operators import pedigree
    df = pedigree.pedigree_tree(stored, R.runner_horses(stored))
    df.collect()
    runner_scans = [s for s in scans(df) if "jvd_se" in s.get("Location", "")]
    assert len(runner_scans) == 1

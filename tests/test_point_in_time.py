"""Point-in-time records, the totals store and names over time."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from furlong.functions.metrics import TOTALS
from furlong.operators import as_of, lookups, names, reports
from furlong.operators.roi import roi_totals
from furlong.operators.runners import rated_runners
from furlong.plans.inspect import plan_text, python_nodes, scans
from furlong.sources import requests as R
from furlong.sources.fixtures import fixture_tables
from furlong.sources.tables import with_runs
from furlong.sources.totals_store import JOCKEY_GRAIN, TotalsStore, new_folder

DAYS = ["20031230", "20031231", "20040101", "20040102", "20040229", "20040301", "20050501", "20050230", "2006xx01"]


def _career(rng, n):
    rows = []
    for k in range(n):
        day = rng.choice(DAYS)
        rows.append({"kaisai_nen": day[:4], "kaisai_tsukihi": day[4:], "race_bango": f"{k:02d}", "kishu_code": rng.choice(["J1", "J1", "J2", None]),
                     "kakutei_chakujun": rng.choice(["01", "02", "05", "00", "1"]), "tansho_odds": rng.choice(["0015", "0240", None]),
                     "tansho_ninkijun": rng.choice(["01", "05", "11", None])})
    return rows


def test_totals_before_a_day(tables, spark):
    rows = _career(random.Random(5), 150)
    t = tables(races=[{k: r[k] for k in ("kaisai_nen", "kaisai_tsukihi", "race_bango")} for r in rows], runners=rows)
    rated = rated_runners(t)
    asked = [(j, dt.date(y, m, d)) for j in ("J1", "J2", "J9", None) for y, m, d in
             [(2003, 12, 30), (2003, 12, 31), (2004, 1, 1), (2004, 2, 29), (2004, 12, 31), (2005, 5, 1), (2005, 5, 2), (2009, 1, 1), (1999, 1, 1)]]
    asked += asked[:5] + [("J1", None)]
    requests = spark.createDataFrame(asked, "jockey_id string, as_of date")
    got = {(r["jockey_id"], r["as_of"]): [r[c] for c in TOTALS] for r in as_of.totals_before(rated, ["jockey_id"], requests).collect()}
    assert set(got) == {a for a in asked if None not in a}
    for (jockey, day), totals in got.items():
        known = rated.where((F.col("jockey_id") == jockey) & (as_of.race_day() < F.lit(day)))
        want = roi_totals(known, ["jockey_id"]).collect()
        assert totals == ([want[0][c] or 0 for c in TOTALS] if want else [0] * len(TOTALS)), (jockey, day)


def test_the_day_itself_and_later_races_are_not_known(tables, spark):
    days = [("20040101", "01"), ("20040108", "02"), ("20040108", "03"), ("20040115", "04")]
    races = [{"kaisai_nen": d[:4], "kaisai_tsukihi": d[4:], "race_bango": n} for d, n in days]
    runners = [{**r, "kakutei_chakujun": "01", "tansho_odds": "0050"} for r in races]
    t = tables(races=races, runners=runners, horses=[{}])
    request = [("J1", "05", "芝", "中距離", d) for d in (dt.date(2004, 1, 1), dt.date(2004, 1, 8), dt.date(2004, 1, 9), dt.date(2020, 1, 1), None)]
    requests = spark.createDataFrame(request, "jockey_id string, course_name string, track_type string, distance_category string, as_of date")
    got = {r["as_of"]: r for r in as_of.jockey_course_record_as_of(t, requests).collect()}
    assert [got[d]["total_races"] for d in [x[4] for x in request]] == [0, 1, 3, 4, 0]
    assert got[dt.date(2004, 1, 1)]["roi_percentage"] is None and got[dt.date(2004, 1, 9)]["roi_percentage"] == 500.0
    assert got[dt.date(2004, 1, 8)]["all_total_races"] == 1 and got[dt.date(2004, 1, 8)]["course_aptitude_index"] == 1.0
    sire = spark.createDataFrame([("H1", "芝", "良", dt.date(2004, 1, 15)), ("H9", "芝", "良", dt.date(2004, 1, 15))],
                                 "horse_id string, track_type string, track_condition string, as_of date")
    r = {x["horse_id"]: x for x in as_of.sire_track_record_as_of(t, sire).collect()}
    assert (r["H1"]["sire_id"], r["H1"]["sire_track_total_races"], r["H1"]["sire_track_win_rate"]) == ("S1", 3, 100.0)
    assert (r["H9"]["sire_id"], r["H9"]["sire_track_total_races"], r["H9"]["sire_track_win_rate"]) == (None, 0, None)


def test_far_future_equals_all_history(spark):
    """Where a jockey has one name, asking after the last race gives the lookup's record."""
    t = fixture_tables(spark, SF_SMALL)
    requests = R.jockey_requests(t).where("jockey_id != '00007'")
    now = as_of.jockey_course_record_as_of(t, requests.withColumn("as_of", F.lit(dt.date(2100, 1, 1))))
    columns = ["jockey_id", "course_name", "track_type", "distance_category", "total_races", "roi_percentage", "avg_popularity",
               "all_total_races", "all_win_rate", "course_aptitude_index", "win_rate_ratio"]
    want = lookups.jockey_course_feature(t, requests).where("total_races > 0")
    got = now.where("total_races > 0")
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))


def test_requests_never_meet_runs(spark):
    """Runs are aggregated before they stand beside requests, and the windows are
    cut by year."""
    t = fixture_tables(spark, SF_SMALL)
    df = as_of.totals_before(rated_runners(t), ["jockey_id"], R.jockey_days(t))
    text = plan_text(df)
    assert not python_nodes(df) and "CartesianProduct" not in text and "NestedLoop" not in text
    windows = [x for x in text.split("\n\n") if ") Window" in x.split("\n")[0] and "partition" not in x.split("\n")[0]]
    assert any("_year" in w and "jockey_id" in w for w in windows)


def test_runs_and_requests_are_derived_once(tables, spark):
    """Of the runs that are asked about, one aggregate and one exchange by key; and
    runs that are kept are not joined again, with the same answers."""
    rows = _career(random.Random(6), 80)
    t = tables(races=[{k: r[k] for k in ("kaisai_nen", "kaisai_tsukihi", "race_bango")} for r in rows], runners=rows, horses=[{}])
    df = as_of.totals_before(rated_runners(t), ["jockey_id"], R.jockey_days(t))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2  # rated runs; requests
    kept = with_runs(t, new_folder(spark, "runs"))
    for ask, answer in ((R.jockey_days, as_of.jockey_course_record_as_of), (R.horse_days, as_of.sire_track_record_as_of)):
        got = answer(kept, ask(kept))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, answer(t, ask(t)).collect()), key=repr)
    assert "Join" not in kept.runs._jdf.queryExecution().optimizedPlan().toString()


# --- totals store --------------------------------------------------------------

def _stored(store, keys=("jockey_id", "track_type")):
    return sorted(map(tuple, store.totals(keys).collect()), key=repr)


def test_store_equals_recomputation(tables, spark, tmp_path):
    rows = [r for r in _career(random.Random(8), 120)]
    races = [{k: r[k] for k in ("kaisai_nen", "kaisai_tsukihi", "race_bango")} for r in rows]

    def rated(keep=lambda r: True):
        return rated_runners(tables(races=races, runners=[r for r in rows if keep(r)]))

    keys = ("jockey_id", "track_type")
    want = sorted(map(tuple, roi_totals(rated(), keys).collect()), key=repr)
    store = TotalsStore(spark, f"file://{tmp_path}/totals", JOCKEY_GRAIN)
    day = F.concat("kaisai_nen", "kaisai_tsukihi")
    store.replace_days(rated(lambda r: r["kishu_code"] != "J2").where(day <= "20040101"))  # without J2: wrong
    store.replace_days(rated().where(day > "20040101"))  # an append, into the month of a day that is there
    store.replace_days(rated().where(day > "20040229"))  # a replay
    assert _stored(store) != want
    store.replace_days(rated().where(day <= "20040101"))  # the correction
    assert _stored(store) == want
    store.replace_days(rated().where(day <= "20040101"))  # once more
    assert _stored(store) == want
    since = sorted(map(tuple, store.totals(keys, since="20040101", before="20040301").collect()), key=repr)
    assert since == sorted(map(tuple, roi_totals(rated().where(day.between("20040101", "20040229")), keys).collect()), key=repr)
    # days that lose all their runs: nothing of them is left, other days of the month stay
    gone = spark.createDataFrame([("20040102",), ("20040101",)], "race_day string")
    store.replace_days(rated().where(F.lit(False)), gone)
    left = roi_totals(rated().where(~day.isin("20040102", "20040101")), keys)
    assert _stored(store) == sorted(map(tuple, left.collect()), key=repr)


def test_store_reads_are_pruned(spark, tmp_path):
    t = fixture_tables(spark, SF_SMALL)
    store = TotalsStore(spark, f"file://{tmp_path}/totals", JOCKEY_GRAIN)
    store.replace_days(rated_runners(t))
    keys = ("jockey_id", "jockey_name", "course_name", "track_type", "distance_category")
    got = store.report(keys, reports.JOCKEY_COURSE_METRICS, since="2000", min_races=1)
    assert any("race_month" in s.get("PartitionFilters", "") for s in scans(got))
    want = reports.jockey_course_roi(t, min_races=1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


# --- names ---------------------------------------------------------------------

def test_name_intervals(tables, spark):
    rows = [("20040101", "01", "A"), ("20040105", "01", "A "), ("20040105", "02", " A"), ("20040110", "01", "A"), ("20040110", "02", "B"),
            ("20050301", "01", "B"), ("20050302", "05", "A"), ("20050230", "01", "Z"), ("20060101", "01", None)]
    runners = [{"kaisai_nen": d[:4], "kaisai_tsukihi": d[4:], "race_bango": n, "kishumei_ryakusho": x} for d, n, x in rows]
    t = tables(runners=[*runners, {"kishu_code": None}, {"kishu_code": "J2", "kishumei_ryakusho": "C", "kaisai_nen": "2010"}])
    day = dt.date
    got = sorted(map(tuple, names.name_intervals(t.runners).collect()))
    assert got == [("J1", "A", day(2004, 1, 1), day(2004, 1, 10)), ("J1", "A", day(2005, 3, 2), None),
                   ("J1", "B", day(2004, 1, 10), day(2005, 3, 2)), ("J2", "C", day(2010, 1, 1), None)]
    asked = {("J1", day(2003, 12, 31)): None, ("J1", day(2004, 1, 1)): "A", ("J1", day(2004, 1, 9)): "A", ("J1", day(2004, 1, 10)): "B",
             ("J1", day(2005, 3, 1)): "B", ("J1", day(2005, 3, 2)): "A", ("J1", day(2031, 7, 7)): "A", ("J2", day(2009, 1, 1)): None,
             ("J3", day(2009, 1, 1)): None, (None, day(2009, 1, 1)): None, ("J1", None): None}
    requests = spark.createDataFrame(list(asked) * 2, "jockey_id string, as_of date")
    out = names.jockey_names_on(t, requests).collect()
    assert len(out) == 2 * len(asked) and all(asked[r["jockey_id"], r["as_of"]] == r["jockey_name"] for r in out)
    assert names.jockey_names_on(t, requests.limit(0)).count() == 0


def test_one_name_a_day_at_most(tables, spark):
    rng = random.Random(2)
    start = dt.date(2001, 11, 1)
    runners, by_day = [], defaultdict(list)
    for k in range(300):
        d, name = start + dt.timedelta(rng.randint(0, 900)), rng.choice("AB")
        by_day[d].append((f"{k:03d}", name))
        runners.append({"kaisai_nen": f"{d:%Y}", "kaisai_tsukihi": f"{d:%m%d}", "race_bango": f"{k:03d}", "kishumei_ryakusho": name})
    t = tables(runners=runners)
    days = [start + dt.timedelta(k) for k in range(-3, 950)]
    got = names.jockey_names_on(t, spark.createDataFrame([("J1", d) for d in days], "jockey_id string, as_of date")).collect()
    assert len(got) == len(days)
    now, want = None, {}
    for d in days:
        now = max(by_day[d])[1] if by_day[d] else now
        want[d] = now
    assert {r["as_of"]: r["jockey_name"] for r in got} == want

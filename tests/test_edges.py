"""Hand-made edge rows for the semantics decided in SURVEY §2.10."""

from __future__ import annotations

from collections import Counter
from fractions import Fraction

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from furlong.functions import buckets as B
from furlong.functions.metrics import N, ODDS_SUM
from furlong.operators import lookups, pedigree, reports
from furlong.operators.runners import rated_runners


def _one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


# --- N1, N2: which finishes count ------------------------------------------

def test_finish_codes(tables):
    finishes = ["01", "1", "01\n", "１", "00", "99", "", None, "取消", "12"]
    t = tables(runners=[{"kakutei_chakujun": f} for f in finishes])
    rated = rated_runners(t)
    assert sorted(r.finish_pos for r in rated.collect()) == ["01", "1", "12"]
    r = _one(reports.jockey_surface_condition_roi(t, min_races=1))
    assert (r.total_races, r.wins, r.top3_finishes) == (3, 1, 1)  # '1' is not a win


# --- N3, N20: bad numbers ----------------------------------------------------

def test_bad_odds_fail_or_null(tables):
    t = tables(runners=[{"kakutei_chakujun": "01", "tansho_odds": "----"},
                        {"kakutei_chakujun": "02", "tansho_odds": "0100"}])
    with pytest.raises(PySparkException):
        rated_runners(t).collect()
    r = _one(reports.jockey_surface_condition_roi(t, min_races=1, bad_values="null"))
    assert (r.total_races, r.wins, r.roi_percentage, r.avg_win_odds) == (2, 1, 0.0, None)


def test_bad_values_on_excluded_rows_are_harmless(tables):
    t = tables(runners=[{"kakutei_chakujun": "00", "tansho_odds": "----", "tansho_ninkijun": "x"},
                        {"kakutei_chakujun": "DNF", "tansho_odds": ""},
                        {"kakutei_chakujun": "01", "tansho_odds": "0250"}])
    r = _one(reports.jockey_course_roi(t, min_races=1))
    assert (r.total_races, r.wins, r.roi_percentage, r.avg_win_odds) == (1, 1, 2500.0, 25.0)


# --- N4: rounding ------------------------------------------------------------

def test_exact_half_rounds_up(tables):
    runners = [{"kakutei_chakujun": "05", "tansho_ninkijun": "02"} for _ in range(799)]
    runners.append({"kakutei_chakujun": "01", "tansho_odds": "0010", "tansho_ninkijun": "01"})
    t = tables(runners=runners)
    r = _one(reports.jockey_course_roi(t, min_races=1))
    # 1/800 = 0.125 % win rate; ROI 1.0 / 800 * 100 = 0.125 %; both half -> up.
    assert (r.win_rate, r.roi_percentage, r.top3_rate) == (0.13, 0.13, 0.13)
    # average rank (799*2 + 1)/800 = 1.99875 -> 2.0
    assert r.avg_popularity == 2.0


def test_repeating_quotient(tables):
    t = tables(runners=[{"kakutei_chakujun": "01", "tansho_odds": "0011"},
                        {"kakutei_chakujun": "04"}, {"kakutei_chakujun": "05"}])
    r = _one(reports.jockey_course_roi(t, min_races=1))
    assert (r.win_rate, r.roi_percentage, r.avg_win_odds) == (33.33, 36.67, 1.1)


# --- N19 and P1-P4: class rules --------------------------------------------

def test_distance_classes(spark):
    df = spark.createDataFrame([(None,), (1400,), (1401,), (2000,), (2001,)], "k int")
    got = [r[0] for r in df.select(B.distance_category(F.col("k"))).collect()]
    assert got == [B.LONG, B.SHORT, B.MIDDLE, B.MIDDLE, B.LONG]


def test_popularity_classes(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (3,), (4,), (8,), (9,)], "p int")
    got = [r[0] for r in df.select(B.popularity_category(F.col("p"))).collect()]
    assert got == [B.LONGSHOT, B.LONGSHOT, B.FAVOURITE, B.FAVOURITE, B.MIDFIELD,
                   B.MIDFIELD, B.LONGSHOT]


def test_course_track_going(spark):
    rows = [("10", "11", "3", "9"), ("11", "23", "1", "4"), ("05", "51", "1", "1"),
            ("01", None, "1", "1"), ("02", "17", "0", "1"), ("03", "17", None, "1")]
    df = spark.createDataFrame(rows, "c string, t string, s string, d string")
    got = df.select(B.course_name(F.col("c")), B.track_type(F.col("t")),
                    B.track_condition(F.col("t"), F.col("s"), F.col("d")),
                    B.condition_code(F.col("t"), F.col("s"), F.col("d"))).collect()
    assert [tuple(r) for r in got] == [
        ("小倉", B.TURF, "重", "3"),
        ("11", B.DIRT, "不良", "4"),
        ("東京", B.OTHER_TRACK, B.UNKNOWN_GOING, "0"),
        ("札幌", B.OTHER_TRACK, B.UNKNOWN_GOING, "0"),
        ("函館", B.TURF, B.UNKNOWN_GOING, "0"),
        ("福島", B.TURF, B.UNKNOWN_GOING, None),
    ]


def test_course_code_inverse(spark):
    df = spark.createDataFrame([("東京",), ("05",), ("11",), ("nowhere",)], "n string")
    assert [r[0] for r in df.select(B.course_code(F.col("n"))).collect()] == \
        ["05", "05", "11", "nowhere"]


# --- P9: trimming --------------------------------------------------------------

def test_trim_ascii_spaces_only(tables):
    t = tables(runners=[{"kishumei_ryakusho": "  Name　 "}])
    assert _one(rated_runners(t)).jockey_name == "Name　"


# --- F4: year filter on text ----------------------------------------------------

def test_since_year(tables):
    races = [{"kaisai_nen": "1999"}, {"kaisai_nen": "2000"}]
    runners = [{"kaisai_nen": "1999", "kakutei_chakujun": "01"},
               {"kaisai_nen": "2000", "kakutei_chakujun": "02"}]
    t = tables(races=races, runners=runners)
    r = _one(reports.jockey_course_roi(t, since_year=2000, min_races=1))
    assert (r.total_races, r.wins) == (1, 0)
    assert _one(reports.jockey_course_roi(t, since_year=1999, min_races=1)).total_races == 2


# --- N8, N18: sires ---------------------------------------------------------

def test_unknown_sire_excluded_from_q1_kept_in_q7(tables):
    horses = [{"ketto_toroku_bango": "H1", "ketto_joho_01a": "0000000000"}]
    runners = [{"kakutei_chakujun": "01"}] * 20
    t = tables(runners=runners, horses=horses)
    assert reports.sire_track_condition_roi(t, min_races=1).count() == 0
    r = _one(lookups.sire_track_roi_rank(t))
    assert (r.sire_id, r.total_races, r.roi_rank) == ("0000000000", 20, 1)


def test_duplicate_horse_rows(tables):
    horses = [{"ketto_toroku_bango": "H1", "ketto_joho_01a": "S2", "ketto_joho_01b": "B"},
              {"ketto_toroku_bango": "H1", "ketto_joho_01a": "S1", "ketto_joho_01b": "A"}]
    t = tables(runners=[{"kakutei_chakujun": "01"}], horses=horses)
    # the runner joins both horse rows (as the SQL join does)
    assert reports.sire_track_condition_roi(t, min_races=1).count() == 2
    req = t.runners.sparkSession.createDataFrame([("H1", B.TURF, "良")],
                                                 "horse_id string, track_type string, track_condition string")
    r = _one(lookups.horse_sire_track_roi_feature(t, req))
    assert (r.sire_name, r.sire_track_races) == ("A", 1)


# --- N7, N9: sire feature and rank --------------------------------------------

def _sire_fixture(tables):
    horses, runners = [], []
    # three sires tied at ROI 0 with 20 runs, one with 19 runs and a win, one
    # with 20 runs and a win
    for sire, n, win in [("S3", 20, False), ("S1", 20, False), ("S2", 20, False),
                         ("S4", 19, True), ("S5", 20, True)]:
        horses.append({"ketto_toroku_bango": f"H{sire}", "ketto_joho_01a": sire,
                       "ketto_joho_01b": f"Sire {sire}"})
        for i in range(n):
            runners.append({"ketto_toroku_bango": f"H{sire}", "race_bango": "01",
                            "kakutei_chakujun": "01" if (win and i == 0) else "05"})
    horses.append({"ketto_toroku_bango": "HX", "ketto_joho_01a": "S9", "ketto_joho_01b": " Nine "})
    return tables(runners=runners, horses=horses)


def test_rank_ties_and_minimum(tables, spark):
    t = _sire_fixture(tables)
    ranks = {r.sire_id: r.roi_rank for r in lookups.sire_track_roi_rank(t).collect()}
    assert ranks == {"S5": 1, "S1": 2, "S2": 3, "S3": 4}
    req = spark.createDataFrame(
        [("HS4", B.TURF, "良"), ("HS2", B.TURF, "良"), ("HX", B.TURF, "良"),
         ("NOPE", B.TURF, "良"), ("HS5", B.DIRT, "良")],
        "horse_id string, track_type string, track_condition string")
    got = {r.horse_id: (r.sire_name, r.sire_track_roi, r.sire_track_win_rate,
                        r.sire_track_races, r.sire_track_roi_rank)
           for r in lookups.horse_sire_track_roi_feature(t, req).collect()}
    assert got["HS4"] == ("Sire S4", 52.63, 5.26, 19, 0)   # below the minimum: rank 0
    assert got["HS2"] == ("Sire S2", 0.0, 0.0, 20, 3)
    assert got["HX"] == ("Nine", 0.0, 0.0, 0, 0)            # sire without runs
    assert got["NOPE"] == (None, 0.0, 0.0, 0, 0)            # unknown horse
    assert got["HS5"] == ("Sire S5", 0.0, 0.0, 0, 0)        # unseen condition


def test_rank_follows_roi_before_sire_id(tables):
    # ROIs in the same whole percent, with ids that differ from the first
    # character on and run against the ROIs; the order is ROI, then id
    odds = {"A000000001": "0020", "B000000001": None, "C000000001": "0021", "D000000001": "0021", "E000000001": "0020",
            "F000000001": None, "G000000001": "0100", "Z000000001": "0200", None: None}
    horses, runners = [], []
    for i, (sire, won) in enumerate(odds.items()):
        horses.append({"ketto_toroku_bango": f"H{i}", "ketto_joho_01a": sire})
        runners += [{"ketto_toroku_bango": f"H{i}", "kakutei_chakujun": "01" if won and k == 0 else "05",
                     "tansho_odds": won or "0100"} for k in range(300)]
    ranked = lookups.sire_track_roi_rank(tables(runners=runners, horses=horses)).collect()
    assert [r.sire_id for r in sorted(ranked, key=lambda r: r.roi_rank)] == [
        "Z000000001", "G000000001", "C000000001", "D000000001", "A000000001", "E000000001",
        "B000000001", "F000000001", None]
    assert sorted(r.roi_rank for r in ranked) == list(range(1, 10))


def test_rank_is_the_row_number_over_each_class(spark):
    # ROIs of exactly zero, below one percent, on whole percents, equal ones
    # and none; the ids do not follow them.  (sire, class, races, win odds)
    totals = []
    for i in range(1, 1200):
        odds = None if i % 97 == 0 else 0 if i % 3 == 0 else (i * 37) % 61 * (1 if i % 4 else 100)
        totals.append((str(i * 7919 % 100003), B.TURF if i % 2 else B.DIRT, "良", 20 + i % 7, odds))
    totals += [(sire, B.TURF, "良", 20, odds) for sire, odds in (("", 0), (None, 0))]
    totals += [(sire, B.DIRT, "良", 20, odds) for sire, odds in (("", 100), (None, 100))]
    df = spark.createDataFrame(totals, "sire_id string, track_type string, track_condition string, "
                                       f"{N} long, {ODDS_SUM} long")
    got = lookups._roi_ranked(df).collect()
    want = []
    for track in (B.TURF, B.DIRT):
        group = sorted((r for r in totals if r[1] == track),
                       key=lambda r: (r[4] is None, -Fraction(r[4] or 0, r[3]), r[0] is None, r[0] or ""))
        want += [(*r, k) for k, r in enumerate(group, 1)]
    assert Counter(want) == Counter(
        (r.sire_id, r.track_type, r.track_condition, r[N], r[ODDS_SUM], r.roi_rank) for r in got)


def test_rank_keeps_sires_whose_odds_are_unreadable(tables):
    horses = [{"ketto_toroku_bango": f"H{s}", "ketto_joho_01a": s} for s in ("S1", "S2", "S3")]
    runners = [{"ketto_toroku_bango": f"H{s}", "kakutei_chakujun": finish, "tansho_odds": odds}
               for s, finish, odds in (("S1", "01", "bad"), ("S2", "05", "0100"), ("S3", "01", "0100")) for _ in range(20)]
    ranked = lookups.sire_track_roi_rank(tables(runners=runners, horses=horses), bad_values="null").collect()
    assert {r.sire_id: (r.roi_percentage, r.roi_rank) for r in ranked} == {
        "S3": (1000.0, 1), "S2": (0.0, 2), "S1": (None, 3)}


def test_q6_rank_equals_q7_rank(tables, spark):
    t = _sire_fixture(tables)
    q7 = {(r.sire_id, r.track_type, r.track_condition): r.roi_rank
          for r in lookups.sire_track_roi_rank(t).collect()}
    req = t.horses.select(F.col("ketto_toroku_bango").alias("horse_id"),
                          F.lit(B.TURF).alias("track_type"), F.lit("良").alias("track_condition"))
    sires = {r.ketto_toroku_bango: r.ketto_joho_01a for r in t.horses.collect()}
    for r in lookups.horse_sire_track_roi_feature(t, req).collect():
        assert r.sire_track_roi_rank == q7.get((sires[r.horse_id], B.TURF, "良"), 0)


# --- N6, N10, A13/A14: jockey course feature ----------------------------------

def test_jockey_feature_name_split_and_defaults(tables, spark):
    runners = (
        [{"kishumei_ryakusho": "A", "kakutei_chakujun": "01", "tansho_odds": "0050"}] * 3
        + [{"kishumei_ryakusho": "B", "kakutei_chakujun": "03"}] * 2
        # an overall-only run (race missing) under name A
        + [{"kishumei_ryakusho": "A", "race_bango": "99", "kakutei_chakujun": "02"}]
        # a jockey without wins anywhere
        + [{"kishu_code": "J2", "kishumei_ryakusho": "Z", "kakutei_chakujun": "04"}]
    )
    t = tables(runners=runners)
    req = spark.createDataFrame(
        [("J1", "東京", B.TURF, B.MIDDLE), ("J1", "05", B.TURF, B.MIDDLE),
         ("J1", "東京", B.TURF, B.SHORT), ("J9", "東京", B.TURF, B.MIDDLE),
         ("J2", "東京", B.TURF, B.MIDDLE), ("J1", "東京", B.TURF, B.MIDDLE)],
        "jockey_id string, course_name string, track_type string, distance_category string")
    rows = lookups.jockey_course_feature(t, req).collect()
    assert len(rows) == 6  # one answer per request row, duplicates included
    by = {}
    for r in rows:
        by.setdefault((r.jockey_id, r.course_name, r.distance_category), r)
    a = by[("J1", "東京", B.MIDDLE)]
    # name A: 3 conditioned runs, 3 wins, ROI 500; overall A: 4 runs, ROI 375
    assert (a.jockey_name, a.total_races, a.wins, a.roi_percentage) == ("A", 3, 3, 500.0)
    assert (a.all_total_races, a.all_win_rate, a.all_roi_percentage) == (4, 75.0, 375.0)
    assert (a.course_aptitude_index, a.win_rate_ratio) == (1.33, 1.33)
    assert by[("J1", "05", B.MIDDLE)].asDict() | {"course_name": "東京"} == a.asDict()
    for key in [("J1", "東京", B.SHORT), ("J9", "東京", B.MIDDLE)]:
        d = by[key]
        assert (d.jockey_name, d.total_races, d.wins, d.win_rate, d.roi_percentage,
                d.avg_win_odds, d.course_aptitude_index, d.win_rate_ratio) == \
            ("", 0, 0, 0.0, 0.0, 0.0, 0.0, 0.0)
        assert (d.top3_finishes, d.all_total_races, d.all_roi_percentage) == (None, None, None)
    z = by[("J2", "東京", B.MIDDLE)]
    assert (z.avg_win_odds, z.course_aptitude_index, z.win_rate_ratio) == (None, None, None)


# --- N12, N13: pedigree -------------------------------------------------------------

def _family(tables):
    horses = [
        {"ketto_toroku_bango": "H", "bamei": "Horse ", "ketto_joho_01a": "S", "ketto_joho_01b": "Sire",
         "ketto_joho_02a": "D", "ketto_joho_02b": "Dam"},
        {"ketto_toroku_bango": "S", "bamei": "Sire", "ketto_joho_01a": "0000000000",
         "ketto_joho_01b": "unknown", "ketto_joho_02a": None, "ketto_joho_02b": "none"},
        {"ketto_toroku_bango": "D", "bamei": "Dam", "ketto_joho_01a": "DS", "ketto_joho_01b": "Dam Sire",
         "ketto_joho_02a": "MISSING", "ketto_joho_02b": "Lost"},
        {"ketto_toroku_bango": "DS", "bamei": "Dam Sire", "ketto_joho_01a": "X", "ketto_joho_01b": "x",
         "ketto_joho_02a": "Y", "ketto_joho_02b": "y"},
        {"ketto_toroku_bango": "LOOP", "bamei": "Loop", "ketto_joho_01a": "LOOP",
         "ketto_joho_01b": "Loop", "ketto_joho_02a": None, "ketto_joho_02b": None},
    ]
    return tables(horses=horses)


def test_pedigree_rows(tables, spark):
    t = _family(tables)
    roots = spark.createDataFrame([("H",), ("NOPE",)], "horse_id string")
    rows = {(r.position): r for r in pedigree.pedigree_rows(t, roots).collect()}
    assert sorted(rows) == ["1", "11", "12", "121", "122"]
    assert rows["11"].sire_id == "0000000000" and rows["11"].dam_id is None
    assert (rows["122"].horse_id, rows["122"].horse_name, rows["122"].sire_id) == \
        ("MISSING", "Lost", None)
    assert rows["121"].generation == 3
    for depth, n in [(0, 1), (1, 1), (2, 3), (3, 5), (4, 5)]:
        assert pedigree.pedigree_rows(t, roots, depth).count() == n


def test_pedigree_self_ancestor_is_bounded(tables, spark):
    t = _family(tables)
    roots = spark.createDataFrame([("LOOP",)], "horse_id string")
    got = sorted((r.position, r.horse_id) for r in pedigree.pedigree_rows(t, roots).collect())
    assert got == [("1", "LOOP"), ("11", "LOOP"), ("111", "LOOP")]


def test_pedigree_tree(tables, spark):
    t = _family(tables)
    roots = spark.createDataFrame([("H",), ("NOPE",), ("H",)], "horse_id string")
    trees = {r.root_id: r.tree for r in pedigree.pedigree_tree(t, roots).collect()}
    assert trees["NOPE"] is None and len(trees) == 2
    tree = trees["H"]
    assert (tree.id, tree.name) == ("H", "Horse")
    assert (tree.sire.id, tree.sire.name) == ("S", "Sire")
    # the sire's parents: sentinel stub kept, NULL dam stub kept
    assert tuple(tree.sire.sire) == ("0000000000", "unknown")
    assert tuple(tree.sire.dam) == (None, "none")
    assert tuple(tree.dam.sire) == ("DS", "Dam Sire")
    assert tuple(tree.dam.dam) == ("MISSING", "Lost")


def test_pedigree_tree_shallow(tables, spark):
    t = _family(tables)
    roots = spark.createDataFrame([("H",)], "horse_id string")
    for depth in (1, 2):
        tree = pedigree.pedigree_tree(t, roots, depth).collect()[0].tree
        assert (tree.sire.id, tree.sire.name, tree.sire.sire, tree.sire.dam) == \
            ("S", "Sire", None, None)
        assert (tree.dam.id, tree.dam.name) == ("D", "Dam")


# --- documented-only extensions with caller-named columns ----------------------

def _with_column(t, name, values):
    from furlong.schema import RaceTables
    rows = t.runners.collect()
    spark = t.runners.sparkSession
    schema = t.runners.schema.add(name, "string")
    return RaceTables(t.races, spark.createDataFrame(
        [tuple(r) + (v,) for r, v in zip(rows, values)], schema), t.horses)


def test_closing_rank_roi(tables):
    from furlong.operators import extras
    # race 01: closers 33.5 (won, odds 4.0), 34.0, 34.0; race 02: 35.0 (won, 10.0), 36.1, no time
    runners = [
        {"race_bango": "01", "kakutei_chakujun": "01", "tansho_odds": "0040"},
        {"race_bango": "01", "kakutei_chakujun": "02"},
        {"race_bango": "01", "kakutei_chakujun": "03"},
        {"race_bango": "02", "kakutei_chakujun": "01", "tansho_odds": "0100"},
        {"race_bango": "02", "kakutei_chakujun": "02"},
        {"race_bango": "02", "kakutei_chakujun": "03"},
    ]
    t = tables(races=[{"race_bango": "01"}, {"race_bango": "02"}], runners=runners)
    t = _with_column(t, "kohan_3f", ["33.5", "34.0", "34.0", "35.0", "36.1", None])
    got = {r.closing_rank: (r.total_races, r.wins, r.roi_percentage)
           for r in extras.closing_rank_roi(t, "kohan_3f").collect()}
    assert got == {1: (2, 2, 700.0), 2: (3, 0, 0.0)}


def test_next_run_roi(tables):
    from furlong.operators import extras
    runners = [
        {"ketto_toroku_bango": "H1", "kaisai_tsukihi": "0101", "kakutei_chakujun": "09"},
        {"ketto_toroku_bango": "H1", "kaisai_tsukihi": "0201", "kakutei_chakujun": "01",
         "tansho_odds": "0120"},
        {"ketto_toroku_bango": "H2", "kaisai_tsukihi": "0101", "kakutei_chakujun": "02"},
        {"ketto_toroku_bango": "H2", "kaisai_tsukihi": "0201", "kakutei_chakujun": "05"},
    ]
    races = [{"kaisai_tsukihi": "0101"}, {"kaisai_tsukihi": "0201"}]
    t = _with_column(tables(races=races, runners=runners), "bad_trip", ["Y", "N", "N", "N"])
    got = {r.previous_flag: (r.total_races, r.wins, r.roi_percentage)
           for r in extras.next_run_roi(t, "bad_trip").collect()}
    assert got == {None: (2, 0, 0.0), "Y": (1, 1, 1200.0), "N": (1, 0, 0.0)}


# --- what the round's review found ----------------------------------------------

def test_long_keys_stay_whole(spark):
    from furlong.sources.fixtures import _pad
    df = spark.createDataFrame([(7,), (100000001,), (100000009,), (12345678901,)], "k bigint")
    assert [r[0] for r in df.select(_pad(F.col("k"), 8)).collect()] == \
        ["00000007", "100000001", "100000009", "12345678901"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_numbers_raise_with_and_without_ansi(spark, tables, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for bad in ({"tansho_odds": "----"}, {"tansho_odds": "10.555"}, {"tansho_ninkijun": "**"}):
            t = tables(runners=[bad])
            with pytest.raises(Exception, match="not a"):
                rated_runners(t).collect()
            assert rated_runners(t, bad_values="null").count() == 1
        assert rated_runners(tables(runners=[{"tansho_odds": "10.50"}])).first()["odds_milli"] == 1050
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_unreadable_popularity_counts_in_the_popularity_report(tables):
    from furlong.operators import reports
    t = tables(runners=[{"tansho_ninkijun": "**"}, {"tansho_ninkijun": None}])
    got = reports.jockey_popularity_roi(t, min_races=1, bad_values="null").collect()
    assert [(r["popularity_category"], r["total_races"]) for r in got] == [(B.LONGSHOT, 1)]


def test_overall_record_ignores_races(spark, tables):
    """Two of three runs in a race stored twice, one in no race: overall 3."""
    from furlong.operators import lookups
    t = tables(races=[{"race_bango": "01"}, {"race_bango": "01"}],
               runners=[{"race_bango": "01"}, {"race_bango": "01", "ketto_toroku_bango": "H2"}, {"race_bango": "77"}])
    req = spark.createDataFrame([("J1", "05", B.TURF, B.MIDDLE)],
                                "jockey_id string, course_name string, track_type string, distance_category string")
    row = lookups.jockey_course_feature(t, req).first()
    assert (row["total_races"], row["all_total_races"]) == (4, 3)


def test_closing_rank_counts_the_whole_field(spark, tables):
    """The fastest runner has no odds: the second fastest keeps rank 2."""
    from furlong.operators import extras
    from furlong.schema import RaceTables
    t = tables(runners=[{"ketto_toroku_bango": "A", "tansho_odds": None}, {"ketto_toroku_bango": "B"},
                        {"ketto_toroku_bango": "C"}])
    times = F.when(F.col("ketto_toroku_bango") == "A", "33.1").when(F.col("ketto_toroku_bango") == "B", "33.9").otherwise("34.5")
    t = RaceTables(t.races, t.runners.withColumn("t", times), t.horses)
    assert [(r["closing_rank"], r["total_races"]) for r in extras.closing_rank_roi(t, "t").collect()] == [(2, 1), (3, 1)]


def test_next_run_looks_back_over_unrated_runs_and_years(tables):
    from furlong.operators import extras
    from furlong.schema import RaceTables
    t = tables(races=[{"kaisai_nen": y} for y in ("2003", "2004", "2005")],
               runners=[{"kaisai_nen": "2003", "kishu_code": "flag"}, {"kaisai_nen": "2004", "kakutei_chakujun": "99"},
                        {"kaisai_nen": "2005"}, {"kaisai_nen": "2005", "ketto_toroku_bango": "0000000000"}])
    t = RaceTables(t.races, t.runners.withColumn("f", F.col("kishu_code")), t.horses)
    got = extras.next_run_roi(t, "f").collect()
    assert {(r["previous_flag"], r["total_races"]) for r in got} == {(None, 1), ("J1", 1)}
    late = extras.next_run_roi(t, "f", since_year=2004).collect()
    assert {(r["previous_flag"], r["total_races"]) for r in late} == {("J1", 1)}


def test_pedigree_depth_over_three_warns(spark, tables):
    from furlong.operators import pedigree
    with pytest.warns(UserWarning, match="over 3"):
        pedigree.pedigree_rows(tables(), spark.createDataFrame([("H1",)], "horse_id string"), depth=4)


def test_labels_are_pinned():
    """The SQL oracle shares the label constants, so they are checked here."""
    assert list(B.COURSE_NAMES.items()) == [
        ("01", "札幌"), ("02", "函館"), ("03", "福島"), ("04", "新潟"), ("05", "東京"), ("06", "中山"),
        ("07", "中京"), ("08", "京都"), ("09", "阪神"), ("10", "小倉")]
    assert (B.TURF, B.DIRT, B.OTHER_TRACK) == ("芝", "ダート", "その他")
    assert B.GOING_NAMES == {"1": "良", "2": "稍重", "3": "重", "4": "不良"} and B.UNKNOWN_GOING == "不明"
    assert (B.SHORT, B.MIDDLE, B.LONG) == ("短距離", "中距離", "長距離")
    assert (B.FAVOURITE, B.MIDFIELD, B.LONGSHOT) == ("人気（1-3位）", "中穴（4-8位）", "大穴（9位-）")

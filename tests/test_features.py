"""Payouts, losing streaks, stamina, quarantine, pedigree paths and breeding
stock, on hand-made rows and against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from furlong.operators import breeding, careers, payouts, pedigree, pedigree_paths, quarantine, stamina
from furlong.operators.runners import rated_runners
from furlong.plans.inspect import python_nodes
from furlong.schema import RaceTables
from furlong.sources.fixtures import breeding_stock, fixture_tables


def _slots(*pairs, marks="00000000"):
    out = {"henkan_umaban": marks}
    for k in range(3):
        a, b = pairs[k] if k < len(pairs) else ("00", "")
        out |= {f"haraimodoshi_tansho_{k + 1}a": a, f"haraimodoshi_tansho_{k + 1}b": b}
    return out


# --- payouts -------------------------------------------------------------------

def test_dead_heat_pays_both_winners(tables):
    runners = [{"umaban": f"{k:02d}", "kakutei_chakujun": "01" if k <= 2 else "03", "tansho_odds": "0040"} for k in range(1, 5)]
    t = tables(runners=runners, payouts=[_slots(("01", "0000210"), ("02", "0000190"))])
    r = payouts.jockey_payout_roi(t, min_bets=1).collect()[0]
    # quoted odds pay 4.0 twice over four bets; the pool pays 2.1 and 1.9
    assert (r["total_races"], r["wins"], r["roi_percentage"]) == (4, 2, 200.0)
    assert (r["bets"], r["refunds"], r["paid_bets"], r["payout_roi_percentage"]) == (4, 0, 2, 100.0)


def test_refunds_unsettled_races_and_odd_numbers(tables):
    races = [{"race_bango": n} for n in ("01", "02", "03")]
    runners = [
        {"umaban": "01", "kakutei_chakujun": "01"}, {"umaban": "02", "kakutei_chakujun": "00", "tansho_odds": None},  # scratched, refunded
        {"umaban": "3", "kakutei_chakujun": "99"}, {"umaban": None}, {"umaban": "xx"}, {"umaban": "00"}, {"umaban": "77"},
        {"umaban": "04", "kakutei_chakujun": "DNF"},  # not rated, but in a winning slot: paid
        {"race_bango": "02", "umaban": "01", "kakutei_chakujun": "01"},  # no payout record
        {"race_bango": "03", "umaban": "01", "kakutei_chakujun": "01"},  # refunded although it won
    ]
    records = [_slots(("01", "0000300"), ("04", "0000500"), ("01", "0000100"), marks="01"),
               {"race_bango": "03", **_slots(("01", "0000999"), marks="1")}]
    t = tables(races=races, runners=runners, payouts=records)
    got = {(r["race_bango"], r["umaban"]): (r["settled"], r["refunded"], r["stake"], r["paid"]) for r in payouts.settled_runners(t).collect()}
    assert got["01", "01"] == (True, False, 1, 400)  # two slots name it: their sum
    assert got["01", "02"] == (True, True, 0, 0)
    assert got["01", "3"] == got["01", None] == got["01", "xx"] == got["01", "00"] == got["01", "77"] == (True, False, 1, 0)
    assert got["01", "04"] == (True, False, 1, 500)
    assert got["02", "01"] == (False, False, 0, 0) and got["03", "01"] == (True, True, 0, 0)
    r = payouts.jockey_payout_roi(t, min_bets=1).collect()[0]
    assert (r["bets"], r["refunds"], r["paid_bets"], r["total_races"], r["wins"]) == (7, 2, 2, 7, 3)
    assert sorted(map(tuple, payouts.win_payouts(t.payouts).select("race_bango", "horse_number", "amount").collect())) == [
        ("01", 1, 400), ("01", 4, 500), ("03", 1, 999)]
    with pytest.raises(ValueError):
        payouts.settled_runners(RaceTables(t.races, t.runners, t.horses))


def test_settlement_copies_no_row(tables):
    """Two records of one race do not double its runners."""
    t = tables(runners=[{"umaban": "01"}], payouts=[_slots(("01", "0000300")), _slots(("01", "0000200"))])
    assert [r["paid"] for r in payouts.settled_runners(t).collect()] == [300]


# --- careers -------------------------------------------------------------------

def test_streaks(tables):
    finishes = ["05", "02", "01", "01", "00", "03", "99", "04", "DNF", "01", "02"]
    days = [f"{k + 1:02d}10" for k in range(11)]
    runners = [{"kaisai_tsukihi": d, "kakutei_chakujun": f} for d, f in zip(days, finishes, strict=True)]
    runners += [{"ketto_toroku_bango": "0000000000"}, {"ketto_toroku_bango": None}, {"ketto_toroku_bango": "H2", "kakutei_chakujun": "07"}]
    t = tables(runners=runners)
    got = {(r["ketto_toroku_bango"], r["kaisai_tsukihi"]): (r["streak"], r["streak_days"]) for r in careers.with_streaks(t.runners).collect()}
    assert got == {("H1", "0110"): (0, None), ("H1", "0210"): (1, 31), ("H1", "0310"): (2, 59), ("H1", "0410"): (0, None),
                   ("H1", "0610"): (0, None), ("H1", "0810"): (1, 61), ("H1", "1010"): (2, 122), ("H1", "1110"): (0, None), ("H2", "0101"): (0, None)}
    ends_with_top3 = careers.with_streaks(t.runners, ends=F.col("kakutei_chakujun").isin("01", "02", "03"))
    assert {(r["kaisai_tsukihi"], r["streak"]) for r in ends_with_top3.where("ketto_toroku_bango = 'H1'").collect()} == {
        ("0110", 0), ("0210", 1), ("0310", 0), ("0410", 0), ("0610", 0), ("0810", 0), ("1010", 1), ("1110", 0)}


def test_losing_streak_report(tables):
    races = [{"kaisai_tsukihi": f"01{k:02d}"} for k in range(1, 8)]
    runners = [{**r, "kakutei_chakujun": f, "tansho_odds": "0080"} for r, f in zip(races, ["02", "03", "04", "01", "02", "01", "01"], strict=True)]
    got = [tuple(r) for r in careers.losing_streak_roi(tables(races=races, runners=runners), longest=2).collect()]
    # streaks before the seven runs: 0 1 2 3 0 1 0; the third and fourth count as 2
    assert got == [(0, 3, 1, 33.33, 266.67, 8.0, None), (1, 2, 1, 50.0, 400.0, 8.0, 1.0), (2, 2, 1, 50.0, 400.0, 8.0, 2.5)]


# --- stamina -------------------------------------------------------------------

def test_stamina_index(tables):
    rng = random.Random(4)
    horses = [{"ketto_toroku_bango": f"H{k}", "ketto_joho_01a": f"S{k % 2}"} for k in range(5)]
    races, runners, seen = [], [], {}
    for k in range(60):
        metres, h = rng.choice(["1000", "1600", "2450", None]), rng.randrange(7)
        races.append({"race_bango": f"{k:02d}", "kyori": metres})
        score = rng.choice([None, str(rng.randint(0, 90))])
        if h == 4:
            metres = races[-1]["kyori"] = "1200"  # one distance only: no slope of its own
        runners.append({"race_bango": f"{k:02d}", "ketto_toroku_bango": f"H{h}", "run_score": score})
        if metres and score:
            seen.setdefault(f"H{h}", []).append((int(metres) // 100, int(score)))
    t = tables(races=races, runners=runners, horses=horses, extra=["run_score"])
    got = {r["horse_id"]: r for r in stamina.stamina_index(t, "run_score", prior=5).collect()}

    def fit(points):
        x = [p[0] for p in points]
        return np.polyfit(x, [p[1] for p in points], 1)[0] if len(set(x)) > 1 else None

    for horse, r in got.items():
        own, pooled = fit(seen.get(horse, [])), None
        if horse in ("H5", "H6"):
            assert r["sire_id"] is None and r["sire_slope"] is None
        else:
            pooled = fit([p for h, points in seen.items() if h < "H5" and int(h[1]) % 2 == int(horse[1]) % 2 for p in points])
            assert r["sire_slope"] == pytest.approx(pooled)
        assert r["runs"] == len(seen.get(horse, [])) and (r["slope"] is None) == (own is None)
        n = r["runs"]
        want = (n * own + 5 * pooled) / (n + 5) if own is not None and pooled is not None else own if own is not None else pooled
        assert r["stamina_index"] == (None if want is None else pytest.approx(want))
    assert got["H4"]["slope"] is None and got["H4"]["stamina_index"] == got["H4"]["sire_slope"]


# --- quarantine ----------------------------------------------------------------

def test_every_bad_column_is_rejected(tables, tmp_path):
    races = [{"race_bango": "01"}, {"race_bango": "02", "kyori": "1,600"}, {"race_bango": "03", "kyori": None}]
    runners = [{"kishu_code": "ok"}, {"kishu_code": "odds", "tansho_odds": "----"}, {"kishu_code": "fine", "tansho_odds": "1.005"},
               {"kishu_code": "zeros", "tansho_odds": "1.5000"}, {"kishu_code": "rank", "tansho_ninkijun": "**"},
               {"kishu_code": "norank", "tansho_ninkijun": None}, {"kishu_code": "far", "race_bango": "02"},
               {"kishu_code": "all", "race_bango": "02", "tansho_odds": "x", "tansho_ninkijun": "y"}, {"kishu_code": "nokyori", "race_bango": "03"},
               {"kishu_code": "scratched", "kakutei_chakujun": "00", "tansho_odds": "----"}, {"kishu_code": "norace", "race_bango": "09", "tansho_odds": "?"}]
    t = tables(races=races, runners=runners)
    got = quarantine.screen(t, f"file://{tmp_path}/screened")
    why = {r["kishu_code"]: list(r["reasons"]) for r in got.rejects.collect()}
    assert why == {"odds": ["odds are no number"], "fine": ["odds are finer than hundredths"], "rank": ["betting rank is no number"],
                   "far": ["distance is no number"], "all": ["odds are no number", "betting rank is no number", "distance is no number"]}
    good = {r["jockey_id"] for r in got.good.collect()}
    assert good == {"ok", "zeros", "norank", "nokyori"}
    assert got.counts == {"rated": 9, "rejected": 5, "odds are no number": 2, "odds are finer than hundredths": 1,
                          "betting rank is no number": 2, "distance is no number": 2}
    assert got.good.columns == rated_runners(t).columns
    assert {r["tansho_odds"] for r in got.rejects.where("kishu_code = 'odds'").collect()} == {"----"}  # as it came
    clean = RaceTables(t.races.where("race_bango != '02'"), t.runners.where(F.col("kishu_code").isin(*good)), t.horses)
    assert sorted(map(tuple, got.good.collect()), key=repr) == sorted(map(tuple, rated_runners(clean).collect()), key=repr)


# --- pedigree paths ------------------------------------------------------------

def _family(rng, n):
    """Parents have smaller numbers; few horses, so that lines meet."""
    rows = []
    for k in range(n):
        pick = lambda: rng.choice([None, "0000000000", "X9", *[f"{x:03d}" for x in range(k)][-9:]])
        rows.append({"ketto_toroku_bango": f"{k:03d}", "ketto_joho_01a": pick(), "ketto_joho_02a": pick()})
    return rows


def _wright(rows, root):
    parents = {r["ketto_toroku_bango"]: (r["ketto_joho_01a"], r["ketto_joho_02a"]) for r in rows}

    def ways(horse, steps):
        """Paths up from a horse, itself included, of at most ``steps`` steps."""
        if horse in (None, "0000000000"):
            return
        yield (horse,)
        if steps:
            for p in parents.get(horse, ()):
                for w in ways(p, steps - 1):
                    yield (horse, *w)

    sire, dam = parents[root]
    met = [(a, b) for a in ways(sire, 2) for b in ways(dam, 2) if a[-1] == b[-1] and not set(a[:-1]) & set(b[:-1])]
    return len({a[-1] for a, _ in met}), len(met), sum(2 ** (4 - (len(a) - 1) - (len(b) - 1)) for a, b in met)


def test_inbreeding_against_all_paths(tables, spark):
    rng = random.Random(11)
    rows = _family(rng, 120)
    t = tables(horses=rows)
    roots = spark.createDataFrame([(r["ketto_toroku_bango"],) for r in rows] + [("nobody",), (None,)], "horse_id string")
    df = pedigree_paths.inbreeding(t, roots)
    got = {r["horse_id"]: (r["common_ancestors"], r["path_pairs"], r["inbreeding_32nds"]) for r in df.collect()}
    assert got == {r["ketto_toroku_bango"]: _wright(rows, r["ketto_toroku_bango"]) for r in rows}
    assert len({x[2] for x in got.values()}) > 5 and not python_nodes(df)


def test_known_coefficients(tables, spark):
    """Full siblings' foal: 1/4; half siblings': 1/8; sire mated with his daughter: 1/4."""
    def h(i, s=None, d=None):
        return {"ketto_toroku_bango": i, "ketto_joho_01a": s, "ketto_joho_02a": d}

    rows = [h("A"), h("B"), h("C"), h("S", "A", "B"), h("D", "A", "B"), h("E", "A", "C"), h("full", "S", "D"), h("half", "S", "E"),
            h("back", "A", "D"), h("none", "S", "C"), h("self", "self", "self")]
    roots = spark.createDataFrame([("full",), ("half",), ("back",), ("none",), ("self",)], "horse_id string")
    got = {r["horse_id"]: r for r in pedigree_paths.inbreeding(tables(horses=rows), roots).collect()}
    assert [got[x]["inbreeding"] for x in ("full", "half", "back", "none")] == [0.25, 0.125, 0.25, 0.0]
    assert (got["full"]["sire_line_id"], got["full"]["dam_line_id"]) == ("A", "B") and got["back"]["sire_line_id"] == "A"


# --- breeding stock ------------------------------------------------------------

def test_resolved_horses(tables, spark):
    horses = [{"ketto_toroku_bango": "R1", "bamei": "One", "ketto_joho_01a": "B7", "ketto_joho_01b": "Seven", "ketto_joho_02a": "B8", "ketto_joho_02b": "Eight"},
              {"ketto_toroku_bango": "R2", "bamei": "Two", "ketto_joho_01a": "0000000000", "ketto_joho_01b": None, "ketto_joho_02a": "R1", "ketto_joho_02b": "One"},
              {"ketto_toroku_bango": "R3", "bamei": "Three", "ketto_joho_01a": "B3", "ketto_joho_01b": "Self", "ketto_joho_02a": None, "ketto_joho_02b": None}]
    stock = spark.createDataFrame(
        [("B7", None, "Seven", "B9", None), ("B8", "R2", "Two!", "B7", "B9"), ("B9", "0000000000", "Nine", "0000000000", "B7"),
         ("B3", "R3", "Three!", "B7", None), ("B33", "R3", "Three?", "B8", None), (None, "R1", "lost", "B7", "B7")], list(breeding.STOCK_COLUMNS))
    t = tables(horses=horses)
    got = {r["ketto_toroku_bango"]: tuple(r)[1:] for r in breeding.resolved_horses(t.horses, stock).collect()}
    assert got["R1"] == ("One", "B7", "Seven", "R2", "Eight")  # B8 is registered as R2
    assert got["R2"] == ("Two", "B7", "Seven", "R1", "One")  # its unknown sire comes from the stock, its dam from its own row
    assert got["R3"] == ("Three", "B7", "Seven", None, None)  # not its own sire; of the stock rows the smallest parent
    assert got["B7"] == ("Seven", "B9", "Nine", None, None) and got["B9"] == ("Nine", None, None, "B7", "Seven")
    assert set(got) == {"R1", "R2", "R3", "B7", "B9"}
    mixed = RaceTables(t.races, t.runners, breeding.resolved_horses(t.horses, stock))
    roots = spark.createDataFrame([("R1",)], "horse_id string")
    rows = {r["position"]: r["horse_id"] for r in pedigree.pedigree_rows(mixed, roots).collect()}
    assert rows == {"1": "R1", "11": "B7", "12": "R2", "111": "B9", "121": "B7", "122": "R1"}  # the loop ends with the depth
    tree = pedigree.pedigree_tree(mixed, roots).collect()[0]["tree"]
    assert tree["sire"]["sire"]["id"] == "B9" and tree["dam"]["dam"]["id"] == "R1"


def test_pedigree_by_another_key_column(tables, spark):
    t = tables(horses=[{"ketto_toroku_bango": "K1", "ketto_joho_01a": "K2"}, {"ketto_toroku_bango": "K2", "bamei": "Sire"}])
    t = RaceTables(t.races, t.runners, t.horses.withColumnRenamed("ketto_toroku_bango", "hanshoku"))
    rows = pedigree.pedigree_rows(t, spark.createDataFrame([("K1",)], "horse_id string"), depth=2, key="hanshoku").collect()
    assert [(r["position"], r["horse_id"]) for r in rows] == [("1", "K1"), ("11", "K2"), ("12", "D1")]


def test_stock_is_in_the_fixture(spark):
    t, stock = fixture_tables(spark, SF_SMALL), breeding_stock(spark, SF_SMALL)
    resolved = breeding.resolved_horses(t.horses, stock)
    assert resolved.count() == resolved.select("ketto_toroku_bango").distinct().count() > t.horses.count()


def test_payouts_are_stored_with_the_other_tables(spark, tmp_path):
    from furlong.plans.inspect import scans
    from furlong.sources.tables import read_race_tables, write_race_tables

    t = fixture_tables(spark, SF_SMALL)
    write_race_tables(t, f"file://{tmp_path}/db")
    stored = read_race_tables(spark, f"file://{tmp_path}/db", payouts=True)
    got = payouts.jockey_payout_roi(stored, since_year=1999, min_bets=5)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, payouts.jockey_payout_roi(t, since_year=1999, min_bets=5).collect()))
    pruned = [s for s in scans(got) if "kaisai_nen" in s.get("PartitionFilters", "")]
    assert {s["Location"].rstrip("]").split("/")[-1] for s in pruned} == {"jvd_ra", "jvd_se", "jvd_hr"}
    assert read_race_tables(spark, f"file://{tmp_path}/db").payouts is None

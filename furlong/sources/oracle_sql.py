"""Independent SQL (DuckDB dialect) for every registered query.

Each text starts with the fixture mapping of :mod:`furlong.sources.fixtures`
as CTEs over the benchmark views (orders, lineitem, part), then states the
query directly in SQL.  Odds in the fixtures are integer tenths, so rounded
rates are computed with exact integer arithmetic (``//``), the same
half-up-to-hundredths rule the Spark side uses on decimals.
"""

from __future__ import annotations

# The class labels are the fixed values of furlong.functions.buckets.
from furlong.functions.buckets import (
    COURSE_NAMES, DIRT, FAVOURITE, GOING_NAMES, LONG, LONGSHOT, MIDDLE, MIDFIELD,
    OTHER_TRACK, SHORT, TURF, UNKNOWN_GOING,
)



def _pad(text: str, n: int) -> str:
    """Zero-padded; longer text stays whole (``lpad`` alone would cut it)."""
    return f"CASE WHEN length({text}) < {n} THEN lpad({text}, {n}, '0') ELSE {text} END"


FIXTURES = f"""
all_ra AS (
  SELECT o_orderkey,
    CAST(year(o_orderdate) AS VARCHAR) AS kaisai_nen,
    {_pad("CAST(month(o_orderdate) * 100 + day(o_orderdate) AS VARCHAR)", 4)} AS kaisai_tsukihi,
    {_pad("CAST(o_custkey % 12 + 1 AS VARCHAR)", 2)} AS keibajo_code,
    {_pad("CAST(o_orderkey AS VARCHAR)", 8)} AS race_bango,
    CASE o_orderkey % 5 WHEN 0 THEN '11' WHEN 1 THEN '17' WHEN 2 THEN '23'
                        WHEN 3 THEN '24' ELSE '51' END AS track_code,
    CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_custkey % 5 AS VARCHAR) END AS babajotai_code_shiba,
    CASE WHEN o_orderkey % 19 <> 0 THEN CAST((o_custkey + 2) % 5 AS VARCHAR) END AS babajotai_code_dirt,
    CASE WHEN o_orderkey % 29 = 0 THEN NULL
         ELSE {_pad("CAST(1000 + 100 * (o_orderkey % 27) AS VARCHAR)", 4)} END AS kyori
  FROM orders
),
jvd_ra AS (
  SELECT a.* EXCLUDE (o_orderkey) FROM all_ra a WHERE o_orderkey % 97 <> 0
  UNION ALL
  SELECT a.* EXCLUDE (o_orderkey) FROM all_ra a WHERE o_orderkey % 97 <> 0 AND o_orderkey % 101 = 0
),
jvd_se_src AS (
  SELECT r.kaisai_nen, r.kaisai_tsukihi, r.keibajo_code, r.race_bango,
    l.l_partkey, l.l_suppkey, l.l_quantity, l.l_returnflag, l.l_linenumber,
    (l.l_orderkey * 31 + l.l_linenumber * 17 + l.l_partkey) % 24 AS h,
    l.l_orderkey * 13 + l.l_linenumber * 101 + l.l_partkey * 7 + l.l_suppkey AS g
  FROM lineitem l
  JOIN all_ra r ON r.o_orderkey = l.l_orderkey
),
jvd_se AS (
  SELECT kaisai_nen, kaisai_tsukihi, keibajo_code, race_bango,
    {_pad("CAST(l_partkey + 1 AS VARCHAR)", 10)} AS ketto_toroku_bango,
    {_pad("CAST(l_suppkey % 8 AS VARCHAR)", 5)} AS kishu_code,
    CASE WHEN l_suppkey % 8 = 7 AND kaisai_nen >= '2001' THEN ' JOCKEY 7B '
         ELSE ' JOCKEY ' || CAST(l_suppkey % 8 AS VARCHAR) || '  ' END AS kishumei_ryakusho,
    CASE WHEN h <= 17 THEN {_pad("CAST(h + 1 AS VARCHAR)", 2)}
         WHEN h = 18 THEN '1' WHEN h = 19 THEN '00' WHEN h = 20 THEN '99'
         WHEN h = 21 THEN 'DNF' WHEN h = 22 THEN '' ELSE NULL END AS kakutei_chakujun,
    CASE WHEN g % 31 = 0 THEN NULL
         ELSE {_pad("CAST(10 + g % 990 AS VARCHAR)", 4)} END AS tansho_odds,
    CASE WHEN g % 37 = 0 THEN NULL
         ELSE {_pad("CAST(g % 19 AS VARCHAR)", 2)} END AS tansho_ninkijun,
    CASE WHEN g % 41 <> 0 THEN CAST(330 + CAST(l_quantity AS BIGINT) AS VARCHAR) END AS closing_time,
    l_returnflag AS run_flag,
    CASE WHEN g % 43 <> 0 THEN CAST(g % 101 AS VARCHAR) END AS run_score,
    {_pad("CAST(l_linenumber AS VARCHAR)", 2)} AS umaban
  FROM jvd_se_src
),
hr_winners AS (
  SELECT kaisai_nen, kaisai_tsukihi, keibajo_code, race_bango,
    list(CAST(umaban AS BIGINT) ORDER BY umaban) FILTER (WHERE kakutei_chakujun = '01') AS no,
    list(COALESCE(CAST(tansho_odds AS BIGINT), 10) ORDER BY umaban) FILTER (WHERE kakutei_chakujun = '01') AS tenths,
    list(CAST(umaban AS BIGINT)) FILTER (WHERE kakutei_chakujun = '00') AS gone
  FROM jvd_se WHERE CAST(race_bango AS BIGINT) % 23 <> 0
  GROUP BY kaisai_nen, kaisai_tsukihi, keibajo_code, race_bango
),
jvd_um AS (
  SELECT
    {_pad("CAST(p_partkey + 1 AS VARCHAR)", 10)} AS ketto_toroku_bango,
    p_name || '  ' AS bamei,
    {_pad("CAST(CAST(floor(p_partkey / 40) AS BIGINT) AS VARCHAR)", 10)} AS ketto_joho_01a,
    'SIRE ' || CAST(CAST(floor(p_partkey / 40) AS BIGINT) AS VARCHAR) || ' ' AS ketto_joho_01b,
    CASE WHEN p_partkey % 11 = 0 THEN NULL
         WHEN p_partkey % 13 = 0 THEN {_pad("CAST(9000000000 + p_partkey AS VARCHAR)", 10)}
         ELSE {_pad("CAST(CAST(floor(p_partkey / 7) AS BIGINT) AS VARCHAR)", 10)} END AS ketto_joho_02a,
    'DAM ' || CAST(CAST(floor(p_partkey / 7) AS BIGINT) AS VARCHAR) AS ketto_joho_02b
  FROM part
  WHERE p_partkey % 50 <> 49
)"""


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_COURSE = ("CASE r.keibajo_code "
           + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in COURSE_NAMES.items())
           + " ELSE r.keibajo_code END")
_SURF = "substring(r.track_code, 1, 1)"
_TRACK = (f"CASE WHEN {_SURF} = '1' THEN {_q(TURF)} WHEN {_SURF} = '2' THEN {_q(DIRT)} "
          f"ELSE {_q(OTHER_TRACK)} END")
_GOING_CODE = (f"CASE WHEN {_SURF} = '1' THEN r.babajotai_code_shiba "
               f"WHEN {_SURF} = '2' THEN r.babajotai_code_dirt END")
_CONDITION_CODE = (f"CASE WHEN {_SURF} = '1' THEN r.babajotai_code_shiba "
                   f"WHEN {_SURF} = '2' THEN r.babajotai_code_dirt ELSE '0' END")
_GOING = ("CASE " + _GOING_CODE + " "
          + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in GOING_NAMES.items())
          + f" ELSE {_q(UNKNOWN_GOING)} END")
_DIST = (f"CASE WHEN CAST(r.kyori AS INTEGER) <= 1400 THEN {_q(SHORT)} "
         f"WHEN CAST(r.kyori AS INTEGER) <= 2000 THEN {_q(MIDDLE)} ELSE {_q(LONG)} END")
_POPCAT = (f"CASE WHEN CAST(s.tansho_ninkijun AS INTEGER) BETWEEN 1 AND 3 THEN {_q(FAVOURITE)} "
           f"WHEN CAST(s.tansho_ninkijun AS INTEGER) BETWEEN 4 AND 8 THEN {_q(MIDFIELD)} "
           f"ELSE {_q(LONGSHOT)} END")
_RATED_WHERE = ("regexp_full_match(s.kakutei_chakujun, '[0-9]+') "
                "AND s.kakutei_chakujun NOT IN ('00', '99') "
                "AND s.tansho_odds IS NOT NULL")
_RACE_JOIN = ("JOIN jvd_ra r ON s.kaisai_nen = r.kaisai_nen AND s.kaisai_tsukihi = r.kaisai_tsukihi "
              "AND s.keibajo_code = r.keibajo_code AND s.race_bango = r.race_bango")


def _rated(with_sire: bool) -> str:
    """Rated runners; odds kept as integer tenths (``odds10``)."""
    sire_cols = (",\n    u.ketto_joho_01a AS sire_id, trim(u.ketto_joho_01b) AS sire_name"
                 if with_sire else "")
    sire_join = ("\n  JOIN jvd_um u ON s.ketto_toroku_bango = u.ketto_toroku_bango"
                 if with_sire else "")
    name = "rated_sire" if with_sire else "rated"
    return f"""
{name} AS (
  SELECT s.kaisai_nen, s.kaisai_tsukihi, s.keibajo_code, s.race_bango,
    s.ketto_toroku_bango AS horse_id,
    s.kishu_code AS jockey_id, trim(s.kishumei_ryakusho) AS jockey_name,
    {_COURSE} AS course_name,
    {_TRACK} AS track_type,
    {_CONDITION_CODE} AS condition_code,
    {_GOING} AS track_condition,
    {_DIST} AS distance_category,
    {_POPCAT} AS popularity_category,
    s.kakutei_chakujun AS finish_pos,
    CAST(s.tansho_odds AS BIGINT) AS odds10,
    CAST(s.tansho_ninkijun AS INTEGER) AS popularity{sire_cols}
  FROM jvd_se s
  {_RACE_JOIN}{sire_join}
  WHERE {_RATED_WHERE}
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join([FIXTURES, *ctes])


def _h(num: str, den: str, factor: int) -> str:
    """round(num / den * factor, 2) in hundredths, integer half-up."""
    return f"(({200 * factor} * ({num}) + ({den})) // NULLIF(2 * ({den}), 0))"


def _d(h: str) -> str:
    return f"CAST({h} AS DOUBLE) / 100"


_WIN = "finish_pos = '01'"
_TOP3 = "finish_pos IN ('01', '02', '03')"
_N = "COUNT(*)"
_WINS = f"COUNT(*) FILTER (WHERE {_WIN})"
_TOP3_N = f"COUNT(*) FILTER (WHERE {_TOP3})"
_ODDS10_SUM = f"SUM(CASE WHEN {_WIN} THEN odds10 ELSE 0 END)"

# Odds are tenths: a percentage of odds is hundredths of (tenths * 10 / n),
# an average of odds is hundredths of (tenths / 10 / n).
METRICS = {
    "total_races": _N,
    "wins": _WINS,
    "top3_finishes": _TOP3_N,
    "win_rate": _d(_h(_WINS, _N, 100)),
    "top3_rate": _d(_h(_TOP3_N, _N, 100)),
    "roi_percentage": _d(_h(_ODDS10_SUM, _N, 10)),
    "avg_win_odds": _d(f"((20 * {_ODDS10_SUM} + {_WINS}) // NULLIF(2 * {_WINS}, 0))"),
    "avg_popularity": _d(_h("SUM(popularity)", "COUNT(popularity)", 1)),
    "middle_odds_wins": f"COUNT(*) FILTER (WHERE popularity BETWEEN 4 AND 8 AND {_WIN})",
    "longshot_wins": f"COUNT(*) FILTER (WHERE popularity >= 9 AND {_WIN})",
    "non_favorite_wins": f"COUNT(*) FILTER (WHERE popularity >= 4 AND {_WIN})",
}


def _report(source: str, keys: list[str], metrics: tuple[str, ...], where: str,
            min_races: int) -> str:
    cols = ",\n  ".join([*keys, *[f"{METRICS[m]} AS {m}" for m in metrics]])
    return (f"SELECT\n  {cols}\nFROM {source}\nWHERE {where}\n"
            f"GROUP BY {', '.join(keys)}\nHAVING COUNT(*) >= {min_races}")


# --- reports ---------------------------------------------------------------

def sire_track_condition_roi(since_year: int = 2000, min_races: int = 20) -> str:
    return _with(_rated(True)) + "\n" + _report(
        "rated_sire", ["sire_id", "sire_name", "track_type", "track_condition"],
        ("total_races", "wins", "win_rate", "roi_percentage", "avg_win_odds",
         "avg_popularity", "longshot_wins"),
        f"kaisai_nen >= '{since_year}' AND sire_id <> '0000000000'", min_races)


def jockey_course_roi(since_year: int = 2000, min_races: int = 20) -> str:
    return _with(_rated(False)) + "\n" + _report(
        "rated", ["jockey_id", "jockey_name", "course_name", "track_type", "distance_category"],
        ("total_races", "wins", "top3_finishes", "win_rate", "top3_rate", "roi_percentage",
         "avg_win_odds", "avg_popularity", "middle_odds_wins", "longshot_wins"),
        f"kaisai_nen >= '{since_year}'", min_races)


def jockey_popularity_roi(since_year: int = 2000, min_races: int = 20) -> str:
    return _with(_rated(False)) + "\n" + _report(
        "rated", ["jockey_id", "jockey_name", "popularity_category"],
        ("total_races", "wins", "top3_finishes", "win_rate", "top3_rate", "roi_percentage",
         "avg_win_odds"),
        f"kaisai_nen >= '{since_year}' AND popularity IS NOT NULL", min_races)


def jockey_surface_condition_roi(since_year: int = 2000, min_races: int = 20) -> str:
    return _with(_rated(False)) + "\n" + _report(
        "(SELECT *, track_condition AS surface_condition FROM rated) t",
        ["jockey_id", "jockey_name", "track_type", "surface_condition"],
        ("total_races", "wins", "top3_finishes", "win_rate", "top3_rate", "roi_percentage",
         "avg_win_odds", "avg_popularity", "non_favorite_wins"),
        f"kaisai_nen >= '{since_year}'", min_races)


def rated_runners() -> str:
    """All rated runners (no year filter), odds as decimal odds."""
    return _with(_rated(False)) + """
SELECT kaisai_nen, kaisai_tsukihi, keibajo_code, race_bango, horse_id, jockey_id,
  jockey_name, course_name, track_type, condition_code, track_condition,
  distance_category, popularity_category, finish_pos,
  CAST(odds10 AS DOUBLE) / 10 AS win_odds, odds10 * 100 AS odds_milli, popularity
FROM rated"""


# --- lookups ---------------------------------------------------------------

_RUNS = f"""
runs AS (
  SELECT s.kishu_code, s.ketto_toroku_bango, r.keibajo_code,
    {_COURSE} AS course_name, {_TRACK} AS track_type, {_GOING} AS track_condition,
    {_DIST} AS distance_category
  FROM jvd_se s
  {_RACE_JOIN}
)"""

_SIRE_TOTALS = """
tot AS (
  SELECT sire_id, track_type, track_condition, COUNT(*) AS n,
    COUNT(*) FILTER (WHERE finish_pos = '01') AS w,
    SUM(CASE WHEN finish_pos = '01' THEN odds10 ELSE 0 END) AS s10
  FROM rated_sire
  GROUP BY sire_id, track_type, track_condition
),
rk AS (
  SELECT sire_id, track_type, track_condition,
    ROW_NUMBER() OVER (PARTITION BY track_type, track_condition
                       ORDER BY CAST(s10 AS DECIMAL(18, 0)) * 1000000000000 // n DESC, sire_id ASC NULLS LAST) AS rnk
  FROM tot
  WHERE n >= 20
)"""


def sire_track_roi_rank() -> str:
    return _with(_rated(True), _SIRE_TOTALS) + f"""
SELECT tot.sire_id, tot.track_type, tot.track_condition, n AS total_races,
  {_d(_h('s10', 'n', 10))} AS roi_percentage,
  CAST(rnk AS BIGINT) AS roi_rank
FROM tot JOIN rk USING (sire_id, track_type, track_condition)"""


def horse_sire_track_roi_feature() -> str:
    other, firm = _q(OTHER_TRACK), _q(GOING_NAMES["1"])
    return _with(_rated(True), _SIRE_TOTALS, _RUNS) + f""",
req AS (
  SELECT DISTINCT * FROM (
    SELECT ketto_toroku_bango AS horse_id, track_type, track_condition FROM runs
    UNION ALL
    SELECT ketto_toroku_bango, {other}, {firm} FROM jvd_se)
),
hs AS (
  SELECT hid, sire_id, sire_name FROM (
    SELECT ketto_toroku_bango AS hid, ketto_joho_01a AS sire_id,
      trim(ketto_joho_01b) AS sire_name,
      ROW_NUMBER() OVER (PARTITION BY ketto_toroku_bango
                         ORDER BY ketto_joho_01a NULLS FIRST,
                                  trim(ketto_joho_01b) NULLS FIRST) AS k
    FROM jvd_um)
  WHERE k = 1
)
SELECT q.horse_id, q.track_type, q.track_condition, hs.sire_name,
  COALESCE({_d(_h('tot.s10', 'tot.n', 10))}, 0.0) AS sire_track_roi,
  COALESCE({_d(_h('tot.w', 'tot.n', 100))}, 0.0) AS sire_track_win_rate,
  COALESCE(tot.n, 0) AS sire_track_races,
  COALESCE(CAST(rk.rnk AS BIGINT), 0) AS sire_track_roi_rank
FROM req q
LEFT JOIN hs ON hs.hid = q.horse_id
LEFT JOIN tot ON tot.sire_id = hs.sire_id AND tot.track_type = q.track_type
             AND tot.track_condition = q.track_condition
LEFT JOIN rk ON rk.sire_id = hs.sire_id AND rk.track_type = q.track_type
            AND rk.track_condition = q.track_condition"""


def jockey_course_feature() -> str:
    code_of = ("CASE course_name "
               + " ".join(f"WHEN {_q(v)} THEN {_q(k)}" for k, v in COURSE_NAMES.items())
               + " ELSE course_name END")
    cond_metrics = ",\n    ".join(
        f"{METRICS[m]} AS {m}" for m in
        ("total_races", "wins", "top3_finishes", "win_rate", "top3_rate", "roi_percentage",
         "avg_win_odds", "avg_popularity", "middle_odds_wins", "longshot_wins"))
    keys = "q.jockey_id, q.course_name, q.track_type, q.distance_category"
    found = "b.rn IS NOT NULL"
    return _with(_rated(False), _RUNS) + f""",
req AS (
  SELECT DISTINCT * FROM (
    SELECT kishu_code AS jockey_id, course_name, track_type, distance_category FROM runs
    UNION ALL
    SELECT kishu_code, keibajo_code, track_type, distance_category FROM runs
    UNION ALL
    SELECT 'X' || kishu_code, course_name, track_type, distance_category FROM runs)
),
cond AS (
  SELECT jockey_id, jockey_name, keibajo_code, track_type, distance_category,
    {cond_metrics},
    {_h(_ODDS10_SUM, _N, 10)} AS roi_h,
    {_h(_WINS, _N, 100)} AS win_h
  FROM rated
  GROUP BY jockey_id, jockey_name, keibajo_code, track_type, distance_category
),
overall AS (
  SELECT s.kishu_code AS jockey_id, trim(s.kishumei_ryakusho) AS all_name,
    COUNT(*) AS all_total_races,
    {_h("COUNT(*) FILTER (WHERE s.kakutei_chakujun = '01')", _N, 100)} AS all_win_h,
    {_h("SUM(CASE WHEN s.kakutei_chakujun = '01' THEN CAST(s.tansho_odds AS BIGINT) ELSE 0 END)", _N, 10)} AS all_roi_h
  FROM jvd_se s
  WHERE {_RATED_WHERE}
  GROUP BY s.kishu_code, trim(s.kishumei_ryakusho)
),
cand AS (
  SELECT {keys}, c.*, o.all_name, o.all_total_races, o.all_win_h, o.all_roi_h,
    ROW_NUMBER() OVER (PARTITION BY {keys}
      ORDER BY c.total_races DESC, c.jockey_name, o.all_total_races DESC, o.all_name) AS rn
  FROM (SELECT *, {code_of} AS code FROM req) q
  JOIN cond c ON c.jockey_id = q.jockey_id AND c.keibajo_code = q.code
             AND c.track_type = q.track_type AND c.distance_category = q.distance_category
  JOIN overall o ON o.jockey_id = c.jockey_id
),
best AS (SELECT * FROM cand WHERE rn = 1)
SELECT {keys},
  CASE WHEN {found} THEN b.jockey_name ELSE '' END AS jockey_name,
  CASE WHEN {found} THEN b.total_races ELSE 0 END AS total_races,
  CASE WHEN {found} THEN b.wins ELSE 0 END AS wins,
  b.top3_finishes,
  CASE WHEN {found} THEN b.win_rate ELSE 0.0 END AS win_rate,
  b.top3_rate,
  CASE WHEN {found} THEN b.roi_percentage ELSE 0.0 END AS roi_percentage,
  CASE WHEN {found} THEN b.avg_win_odds ELSE 0.0 END AS avg_win_odds,
  b.avg_popularity, b.middle_odds_wins, b.longshot_wins, b.all_total_races,
  {_d('b.all_win_h')} AS all_win_rate,
  {_d('b.all_roi_h')} AS all_roi_percentage,
  CASE WHEN {found} THEN {_d(_h('b.roi_h', 'b.all_roi_h', 1))} ELSE 0.0 END AS course_aptitude_index,
  CASE WHEN {found} THEN {_d(_h('b.win_h', 'b.all_win_h', 1))} ELSE 0.0 END AS win_rate_ratio
FROM req q
LEFT JOIN best b ON b.jockey_id = q.jockey_id AND b.course_name = q.course_name
                AND b.track_type = q.track_type AND b.distance_category = q.distance_category"""


# --- pedigree --------------------------------------------------------------

def _pedigree(roots_sql: str) -> str:
    steps = []
    for g in (2, 3):
        prev = f"g{g - 1}"
        steps.append(f"""
e{g} AS (
  SELECT root_id, position, '1' AS side, sire_id AS pid, sire_name AS pname FROM {prev}
  UNION ALL
  SELECT root_id, position, '2', dam_id, dam_name FROM {prev}
),
g{g} AS (
  SELECT e.root_id, e.pid AS horse_id, e.pname AS horse_name, u.sire_id, u.sire_name,
    u.dam_id, u.dam_name, {g} AS generation, e.position || e.side AS position
  FROM e{g} e LEFT JOIN um u ON u.id = e.pid
  WHERE e.pid <> '0000000000'
)""")
    return f"""
um AS (
  SELECT ketto_toroku_bango AS id, trim(bamei) AS name,
    ketto_joho_01a AS sire_id, trim(ketto_joho_01b) AS sire_name,
    ketto_joho_02a AS dam_id, trim(ketto_joho_02b) AS dam_name
  FROM jvd_um
),
roots AS ({roots_sql}),
g1 AS (
  SELECT ro.root_id, u.id AS horse_id, u.name AS horse_name, u.sire_id, u.sire_name,
    u.dam_id, u.dam_name, 1 AS generation, '1' AS position
  FROM roots ro JOIN um u ON u.id = ro.root_id
),""" + ",".join(steps) + """,
pedigree AS (
  SELECT * FROM g1 UNION ALL SELECT * FROM g2 UNION ALL SELECT * FROM g3
)"""


def pedigree_rows() -> str:
    return _with(_pedigree("SELECT ketto_toroku_bango AS root_id FROM jvd_um")) + """
SELECT root_id, horse_id, horse_name, sire_id, sire_name, dam_id, dam_name,
  generation, position
FROM pedigree"""


def pedigree_tree() -> str:
    def at(pos: str, col: str, alias: str) -> str:
        return f"max(CASE WHEN position = '{pos}' THEN {col} END) AS {alias}"

    slots = ",\n    ".join([
        at("1", "horse_id", "id"), at("1", "horse_name", "name"),
        at("1", "sire_id", "s_id"), at("1", "sire_name", "s_name"),
        at("1", "dam_id", "d_id"), at("1", "dam_name", "d_name"),
        at("11", "sire_id", "ss_id"), at("11", "sire_name", "ss_name"),
        at("11", "dam_id", "sd_id"), at("11", "dam_name", "sd_name"),
        at("12", "sire_id", "ds_id"), at("12", "sire_name", "ds_name"),
        at("12", "dam_id", "dd_id"), at("12", "dam_name", "dd_name"),
    ])
    return _with(_pedigree("SELECT DISTINCT ketto_toroku_bango AS root_id FROM jvd_se")) + f"""
SELECT ro.root_id, t.* EXCLUDE (root_id)
FROM roots ro
LEFT JOIN (
  SELECT root_id,
    {slots}
  FROM pedigree
  GROUP BY root_id
) t ON t.root_id = ro.root_id"""


# --- extensions --------------------------------------------------------------

def broodmare_sire_track_roi(since_year: int = 2000, min_races: int = 20) -> str:
    bms = """
bms AS (
  SELECT f.ketto_toroku_bango AS hid, d.ketto_joho_01a AS bms_id,
    trim(d.ketto_joho_01b) AS bms_name
  FROM jvd_um f JOIN jvd_um d ON d.ketto_toroku_bango = f.ketto_joho_02a
)"""
    return _with(_rated(False), bms) + "\n" + _report(
        "rated JOIN bms ON bms.hid = rated.horse_id",
        ["bms_id", "bms_name", "track_type", "track_condition"],
        ("total_races", "wins", "win_rate", "roi_percentage", "avg_win_odds",
         "avg_popularity", "longshot_wins"),
        f"kaisai_nen >= '{since_year}' AND bms_id <> '0000000000'", min_races)


def horse_course_roi(since_year: int = 2000, min_races: int = 1) -> str:
    return _with(_rated(False)) + "\n" + _report(
        "rated", ["horse_id", "course_name"],
        ("total_races", "wins", "top3_finishes", "win_rate", "top3_rate", "roi_percentage",
         "avg_win_odds"),
        f"kaisai_nen >= '{since_year}'", min_races)


def closing_rank_roi(since_year: int = 2000, min_races: int = 1) -> str:
    ranked = """
jvd_se_ranked AS (
  SELECT *, CASE WHEN closing_time IS NOT NULL THEN
      rank() OVER (PARTITION BY kaisai_nen, kaisai_tsukihi, keibajo_code, race_bango
                   ORDER BY CAST(closing_time AS INTEGER) NULLS LAST) END AS closing_rank
  FROM jvd_se
)"""
    rated = _rated(False).replace("FROM jvd_se s", "FROM jvd_se_ranked s").replace(
        "AS popularity\n", "AS popularity, CAST(s.closing_rank AS INTEGER) AS closing_rank\n")
    return _with(ranked, rated) + "\n" + _report(
        "rated", ["closing_rank"], ("total_races", "wins", "win_rate", "roi_percentage", "avg_win_odds"),
        f"kaisai_nen >= '{since_year}' AND closing_rank IS NOT NULL", min_races)


def next_run_roi(min_races: int = 1) -> str:
    runs = """
jvd_se_runs AS (
  SELECT *, lag(run_flag) OVER (
      PARTITION BY ketto_toroku_bango
      ORDER BY kaisai_nen NULLS FIRST, kaisai_tsukihi NULLS FIRST, keibajo_code NULLS FIRST,
               race_bango NULLS FIRST, kakutei_chakujun NULLS FIRST, run_flag NULLS FIRST,
               tansho_odds NULLS FIRST, tansho_ninkijun NULLS FIRST) AS previous_flag
  FROM jvd_se
  WHERE ketto_toroku_bango <> '0000000000'
)"""
    rated = _rated(False).replace("FROM jvd_se s", "FROM jvd_se_runs s").replace(
        "AS popularity\n", "AS popularity, s.previous_flag\n")
    return _with(runs, rated) + "\n" + _report(
        "rated", ["previous_flag"], ("total_races", "wins", "win_rate", "roi_percentage", "avg_win_odds"),
        "TRUE", min_races)


# --- point in time -----------------------------------------------------------

_DAY = "CAST(try_strptime(kaisai_nen || kaisai_tsukihi, '%Y%m%d') AS DATE)"
_SUMS = ("COUNT(*) AS n, COUNT(*) FILTER (WHERE finish_pos = '01') AS w, "
         "COUNT(*) FILTER (WHERE finish_pos IN ('01', '02', '03')) AS t3, "
         "SUM(CASE WHEN finish_pos = '01' THEN odds10 ELSE 0 END) AS s10, SUM(popularity) AS ps, COUNT(popularity) AS pn, "
         "COUNT(*) FILTER (WHERE popularity BETWEEN 4 AND 8 AND finish_pos = '01') AS mid, "
         "COUNT(*) FILTER (WHERE popularity >= 9 AND finish_pos = '01') AS long")
_BEFORE = ("COALESCE(SUM(n), 0) AS n, COALESCE(SUM(w), 0) AS w, COALESCE(SUM(t3), 0) AS t3, COALESCE(SUM(s10), 0) AS s10, "
           "COALESCE(SUM(ps), 0) AS ps, COALESCE(SUM(pn), 0) AS pn, COALESCE(SUM(mid), 0) AS mid, COALESCE(SUM(long), 0) AS long")


def jockey_course_record_as_of() -> str:
    keys = "jockey_id, keibajo_code, track_type, distance_category"
    same = " AND ".join(f"d.{k} = q.{k}" for k in keys.split(", "))
    runs = _RUNS.replace("SELECT s.kishu_code", f"SELECT {_DAY.replace('kaisai', 's.kaisai')} AS day, s.kishu_code")
    return _with(_rated(False), runs) + f""",
real AS (
  SELECT DISTINCT kishu_code AS jockey_id, course_name, keibajo_code, track_type, distance_category, day AS as_of FROM runs
),
req AS (
  SELECT * FROM real
  UNION ALL
  SELECT DISTINCT 'X' || jockey_id, course_name, keibajo_code, track_type, distance_category, CAST(NULL AS DATE) FROM real
),
dc AS (SELECT {keys}, {_DAY} AS day, {_SUMS} FROM rated GROUP BY ALL),
dj AS (
  SELECT s.kishu_code AS jockey_id, {_DAY} AS day, COUNT(*) AS n, COUNT(*) FILTER (WHERE kakutei_chakujun = '01') AS w,
    SUM(CASE WHEN kakutei_chakujun = '01' THEN CAST(tansho_odds AS BIGINT) ELSE 0 END) AS s10
  FROM jvd_se s WHERE {_RATED_WHERE} GROUP BY ALL
),
c AS (
  SELECT q.*, b.* FROM req q LEFT JOIN LATERAL (SELECT {_BEFORE} FROM dc d WHERE {same} AND d.day < q.as_of) b ON TRUE
),
days AS (SELECT DISTINCT jockey_id, as_of FROM req),
o AS (
  SELECT q.jockey_id, q.as_of, COALESCE(SUM(d.n), 0) AS all_n, COALESCE(SUM(d.w), 0) AS all_w, COALESCE(SUM(d.s10), 0) AS all_s10
  FROM days q LEFT JOIN dj d ON d.jockey_id = q.jockey_id AND d.day < q.as_of GROUP BY q.jockey_id, q.as_of
),
h AS (
  SELECT c.*, o.all_n, {_h('c.s10', 'c.n', 10)} AS roi_h, {_h('c.w', 'c.n', 100)} AS win_h,
    {_h('o.all_s10', 'o.all_n', 10)} AS all_roi_h, {_h('o.all_w', 'o.all_n', 100)} AS all_win_h
  FROM c JOIN o ON o.jockey_id = c.jockey_id AND o.as_of IS NOT DISTINCT FROM c.as_of
)
SELECT jockey_id, course_name, track_type, distance_category, CAST(as_of AS VARCHAR) AS as_of,
  CAST(n AS BIGINT) AS total_races, CAST(w AS BIGINT) AS wins, CAST(t3 AS BIGINT) AS top3_finishes,
  {_d('win_h')} AS win_rate, {_d(_h('t3', 'n', 100))} AS top3_rate, {_d('roi_h')} AS roi_percentage,
  {_d('((20 * s10 + w) // NULLIF(2 * w, 0))')} AS avg_win_odds, {_d(_h('ps', 'pn', 1))} AS avg_popularity,
  CAST(mid AS BIGINT) AS middle_odds_wins, CAST(long AS BIGINT) AS longshot_wins,
  CAST(all_n AS BIGINT) AS all_total_races, {_d('all_win_h')} AS all_win_rate, {_d('all_roi_h')} AS all_roi_percentage,
  {_d(_h('roi_h', 'all_roi_h', 1))} AS course_aptitude_index, {_d(_h('win_h', 'all_win_h', 1))} AS win_rate_ratio
FROM h"""


def sire_track_record_as_of() -> str:
    runs = _RUNS.replace("SELECT s.kishu_code", f"SELECT {_DAY.replace('kaisai', 's.kaisai')} AS day, s.kishu_code")
    return _with(_rated(True), runs) + f""",
hs AS (
  SELECT hid, sire_id, sire_name FROM (
    SELECT ketto_toroku_bango AS hid, ketto_joho_01a AS sire_id, trim(ketto_joho_01b) AS sire_name,
      ROW_NUMBER() OVER (PARTITION BY ketto_toroku_bango ORDER BY ketto_joho_01a NULLS FIRST, trim(ketto_joho_01b) NULLS FIRST) AS k
    FROM jvd_um)
  WHERE k = 1
),
req AS (
  SELECT q.*, hs.sire_id, hs.sire_name FROM (
    SELECT DISTINCT ketto_toroku_bango AS horse_id, track_type, track_condition, day AS as_of FROM runs) q
  LEFT JOIN hs ON hs.hid = q.horse_id
),
ds AS (SELECT sire_id, track_type, track_condition, {_DAY} AS day, {_SUMS} FROM rated_sire GROUP BY ALL),
asked AS (SELECT DISTINCT sire_id, track_type, track_condition, as_of FROM req),
b AS (
  SELECT q.sire_id, q.track_type, q.track_condition, q.as_of, {_BEFORE.replace('SUM(', 'SUM(d.')}
  FROM asked q JOIN ds d ON d.sire_id = q.sire_id AND d.track_type = q.track_type
    AND d.track_condition = q.track_condition AND d.day < q.as_of GROUP BY ALL
)
SELECT q.horse_id, q.track_type, q.track_condition, CAST(q.as_of AS VARCHAR) AS as_of, q.sire_id, q.sire_name,
  CAST(COALESCE(n, 0) AS BIGINT) AS sire_track_total_races, CAST(COALESCE(w, 0) AS BIGINT) AS sire_track_wins,
  {_d(_h('w', 'n', 100))} AS sire_track_win_rate, {_d(_h('s10', 'n', 10))} AS sire_track_roi_percentage,
  {_d('((20 * s10 + w) // NULLIF(2 * w, 0))')} AS sire_track_avg_win_odds
FROM req q LEFT JOIN b ON b.sire_id = q.sire_id AND b.track_type = q.track_type
  AND b.track_condition = q.track_condition AND b.as_of = q.as_of"""


# --- payouts -----------------------------------------------------------------

def _slot(k: int) -> str:
    amount = f"CAST(GREATEST(100, ((tenths[{k}] * 10 - 4) // (len(no) * 10)) * 10) AS VARCHAR)"
    return (f"CASE WHEN no[{k}] IS NULL THEN '00' ELSE lpad(CAST(no[{k}] AS VARCHAR), 2, '0') END AS haraimodoshi_tansho_{k}a, "
            f"CASE WHEN no[{k}] IS NULL THEN '' ELSE lpad({amount}, 7, '0') END AS haraimodoshi_tansho_{k}b")


_PAYOUTS = f"""
jvd_hr AS (
  SELECT kaisai_nen, kaisai_tsukihi, keibajo_code, race_bango,
    {', '.join(_slot(k) for k in (1, 2, 3))},
    {' || '.join(f"CASE WHEN list_contains(gone, {n}) THEN '1' ELSE '0' END" for n in range(1, 9))} AS henkan_umaban
  FROM hr_winners
),
slots AS (
  SELECT kaisai_nen, kaisai_tsukihi, keibajo_code, race_bango, no, SUM(amount) AS amount FROM (
    {' UNION ALL '.join(f"SELECT kaisai_nen, kaisai_tsukihi, keibajo_code, race_bango, CAST(haraimodoshi_tansho_{k}a AS BIGINT) AS no, "
                        f"TRY_CAST(haraimodoshi_tansho_{k}b AS BIGINT) AS amount FROM jvd_hr" for k in (1, 2, 3))})
  WHERE no > 0 AND amount > 0 GROUP BY ALL
)"""


def jockey_payout_roi(since_year: int = 2000, min_bets: int = 20) -> str:
    key = "kaisai_nen, kaisai_tsukihi, keibajo_code, race_bango"
    win = "rated AND finish = '01'"
    return _with(_PAYOUTS) + f""",
b AS (
  SELECT s.kishu_code AS jockey_id, trim(s.kishumei_ryakusho) AS jockey_name, {_COURSE} AS course_name,
    COALESCE({_RATED_WHERE}, FALSE) AS rated, s.kakutei_chakujun AS finish,
    CAST(s.tansho_odds AS BIGINT) AS odds10, p.henkan_umaban IS NOT NULL AS settled,
    COALESCE(substring(p.henkan_umaban, CAST(s.umaban AS INTEGER), 1) = '1', FALSE) AS refunded, w.amount
  FROM jvd_se s JOIN jvd_ra r USING ({key}) LEFT JOIN jvd_hr p USING ({key})
  LEFT JOIN slots w ON w.kaisai_nen = s.kaisai_nen AND w.kaisai_tsukihi = s.kaisai_tsukihi
    AND w.keibajo_code = s.keibajo_code AND w.race_bango = s.race_bango AND w.no = CAST(s.umaban AS BIGINT)
  WHERE s.kaisai_nen >= '{since_year}'
),
g AS (
  SELECT jockey_id, jockey_name, course_name, COUNT(*) FILTER (WHERE rated) AS n, COUNT(*) FILTER (WHERE {win}) AS w,
    SUM(CASE WHEN {win} THEN odds10 ELSE 0 END) AS s10, COUNT(*) FILTER (WHERE settled AND NOT refunded) AS bets,
    COUNT(*) FILTER (WHERE settled AND refunded) AS refunds,
    COUNT(*) FILTER (WHERE settled AND NOT refunded AND amount > 0) AS paid_bets,
    COALESCE(SUM(amount) FILTER (WHERE settled AND NOT refunded), 0) AS paid
  FROM b GROUP BY jockey_id, jockey_name, course_name
)
SELECT jockey_id, jockey_name, course_name, n AS total_races, w AS wins, {_d(_h('s10', 'n', 10))} AS roi_percentage,
  bets, refunds, paid_bets, {_d(_h('paid', 'bets * 100', 100))} AS payout_roi_percentage
FROM g WHERE bets >= {min_bets}"""


# --- names, careers, stamina -------------------------------------------------

def jockey_names_on() -> str:
    return _with() + f""",
days AS (
  SELECT kishu_code AS jockey_id, {_DAY} AS day,
    arg_max(trim(kishumei_ryakusho), keibajo_code || race_bango || trim(kishumei_ryakusho)) AS name
  FROM jvd_se GROUP BY ALL
),
starts AS (
  SELECT * FROM (SELECT *, lag(name) OVER (PARTITION BY jockey_id ORDER BY day) AS before FROM days)
  WHERE name IS DISTINCT FROM before
),
v AS (SELECT jockey_id, name, day AS valid_from, lead(day) OVER (PARTITION BY jockey_id ORDER BY day) AS valid_to FROM starts),
req AS (
  SELECT jockey_id, day AS as_of FROM days UNION SELECT jockey_id, CAST(day + INTERVAL 40 DAY AS DATE) FROM days
)
SELECT q.jockey_id, CAST(q.as_of AS VARCHAR) AS as_of, v.name AS jockey_name, CAST(v.valid_from AS VARCHAR) AS valid_from,
  CAST(v.valid_to AS VARCHAR) AS valid_to
FROM req q LEFT JOIN v ON v.jockey_id = q.jockey_id AND v.valid_from <= q.as_of AND (v.valid_to IS NULL OR q.as_of < v.valid_to)"""


def losing_streak_roi(longest: int = 10) -> str:
    order = ("kaisai_nen NULLS FIRST, kaisai_tsukihi NULLS FIRST, keibajo_code NULLS FIRST, race_bango NULLS FIRST, "
             "kakutei_chakujun NULLS FIRST, tansho_odds NULLS FIRST, tansho_ninkijun NULLS FIRST")
    runs = f"""
islands AS (
  SELECT *, {_DAY} AS day, COUNT(*) FILTER (WHERE kakutei_chakujun = '01') OVER (
      PARTITION BY ketto_toroku_bango ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS island
  FROM jvd_se s WHERE {_RATED_WHERE} AND ketto_toroku_bango <> '0000000000'
),
jvd_se_runs AS (
  SELECT *, row_number() OVER (PARTITION BY ketto_toroku_bango, island ORDER BY {order}) - 1 AS streak,
    day - first_value(day) OVER (PARTITION BY ketto_toroku_bango, island ORDER BY {order}) AS streak_days
  FROM islands
)"""
    rated = _rated(False).replace("FROM jvd_se s", "FROM jvd_se_runs s").replace(
        "AS popularity\n", f"AS popularity, CAST(least(s.streak, {longest}) AS INTEGER) AS streak, "
                           "CASE WHEN s.streak > 0 THEN s.streak_days END AS streak_days\n")
    return _with(runs, rated) + f"""
SELECT streak, {', '.join(f"{METRICS[m]} AS {m}" for m in ("total_races", "wins", "win_rate", "roi_percentage", "avg_win_odds"))},
  {_d(_h('SUM(streak_days)', 'COUNT(streak_days)', 1))} AS avg_streak_days
FROM rated GROUP BY streak"""


def stamina_index(prior: int = 10) -> str:
    def slope(p: str) -> str:
        spread = f"({p}n * {p}xx - {p}x * {p}x)"
        return f"CASE WHEN {spread} <> 0 THEN CAST({p}n * {p}xy - {p}x * {p}y AS DOUBLE) / CAST({spread} AS DOUBLE) END"

    rated = _rated(False).replace("AS popularity\n", "AS popularity, CAST(r.kyori AS HUGEINT) // 100 AS x, CAST(s.run_score AS HUGEINT) AS y\n")
    both = "x IS NOT NULL AND y IS NOT NULL"
    sums = ", ".join(f"COALESCE(SUM({e}) FILTER (WHERE {both}), 0)::HUGEINT AS {c}" for c, e in
                     (("n", "1"), ("x", "x"), ("y", "y"), ("xy", "x * y"), ("xx", "x * x")))
    return _with(rated) + f""",
hs AS (
  SELECT ketto_toroku_bango AS hid, min(ketto_joho_01a) AS sire_id FROM jvd_um GROUP BY ALL
),
h AS (SELECT horse_id, {sums} FROM rated GROUP BY horse_id),
hh AS (SELECT h.*, hs.sire_id FROM h LEFT JOIN hs ON hs.hid = h.horse_id),
s AS (
  SELECT sire_id, SUM(n)::HUGEINT AS s_n, SUM(x)::HUGEINT AS s_x, SUM(y)::HUGEINT AS s_y, SUM(xy)::HUGEINT AS s_xy, SUM(xx)::HUGEINT AS s_xx
  FROM hh WHERE sire_id IS NOT NULL GROUP BY sire_id
),
m AS (
  SELECT horse_id, hh.sire_id, n, s_n, {slope('')} AS slope, {slope('s_')} AS sire_slope FROM hh LEFT JOIN s ON s.sire_id = hh.sire_id
)
SELECT horse_id, sire_id, CAST(n AS BIGINT) AS runs, slope, CAST(s_n AS BIGINT) AS sire_runs, sire_slope,
  COALESCE((CAST(n AS DOUBLE) * slope + {prior}.0::DOUBLE * sire_slope) / (CAST(n AS DOUBLE) + {prior}.0::DOUBLE), slope, sire_slope) AS stamina_index
FROM m"""


# --- quarantine --------------------------------------------------------------

def rejected_runners() -> str:
    """The fixture tables with bad texts put in (see registry), and which rated
    runners they spoil."""
    rated = _rated(False).replace("FROM jvd_se s", "FROM bad_se s").replace("JOIN jvd_ra r", "JOIN bad_ra r")
    where = rated[rated.index("FROM bad_se"):rated.rindex(")")]
    return _with() + f""",
bad_se AS (
  SELECT * REPLACE (
    CASE WHEN race_bango LIKE '%7' AND umaban = '02' THEN '****' WHEN race_bango LIKE '%8' AND umaban = '03' THEN '12.345'
         ELSE tansho_odds END AS tansho_odds,
    CASE WHEN race_bango LIKE '%7' AND umaban IN ('01', '02') THEN '--' ELSE tansho_ninkijun END AS tansho_ninkijun)
  FROM jvd_se
),
bad_ra AS (SELECT * REPLACE (CASE WHEN race_bango LIKE '%13' THEN '1,600' ELSE kyori END AS kyori) FROM jvd_ra),
x AS (
  SELECT s.kaisai_nen, s.kaisai_tsukihi, s.keibajo_code, s.race_bango, s.ketto_toroku_bango, s.kishu_code, s.kakutei_chakujun,
    s.tansho_odds, s.tansho_ninkijun, r.kyori,
    concat_ws('; ', CASE WHEN s.tansho_odds = '****' THEN 'odds are no number' END,
      CASE WHEN s.tansho_odds = '12.345' THEN 'odds are finer than hundredths' END,
      CASE WHEN s.tansho_ninkijun = '--' THEN 'betting rank is no number' END,
      CASE WHEN r.kyori = '1,600' THEN 'distance is no number' END) AS reasons
  {where}
)
SELECT * FROM x WHERE reasons <> ''"""


# --- pedigree paths and breeding stock ---------------------------------------

_ANCESTORS = """
anc AS (
  SELECT root_id, pos, id FROM (
    SELECT root_id, position || '1' AS pos, sire_id AS id FROM pedigree
    UNION ALL SELECT root_id, position || '2', dam_id FROM pedigree)
  WHERE id IS NOT NULL AND id <> '0000000000'
)"""


def pedigree_inbreeding() -> str:
    return _with(_pedigree("SELECT DISTINCT ketto_toroku_bango AS root_id FROM jvd_um"), _ANCESTORS) + """,
ways AS (
  SELECT a.root_id, a.pos, a.id, length(a.pos) - 2 AS steps, list(b.id) FILTER (WHERE b.id IS NOT NULL) AS way
  FROM anc a LEFT JOIN anc b ON b.root_id = a.root_id AND length(b.pos) < length(a.pos) AND starts_with(a.pos, b.pos)
  GROUP BY a.root_id, a.pos, a.id
),
met AS (
  SELECT s.root_id, s.id, s.steps + d.steps AS steps FROM ways s JOIN ways d ON d.root_id = s.root_id AND d.id = s.id
  WHERE starts_with(s.pos, '11') AND starts_with(d.pos, '12') AND NOT list_has_any(COALESCE(s.way, []), COALESCE(d.way, []))
),
m AS (
  SELECT root_id, count(DISTINCT id) AS common_ancestors, count(*) AS path_pairs, sum(16 >> steps)::BIGINT AS f FROM met GROUP BY root_id
),
l AS (
  SELECT root_id, arg_max(id, length(pos)) FILTER (WHERE pos IN ('11', '111', '1111')) AS sire_line_id,
    arg_max(id, length(pos)) FILTER (WHERE pos IN ('12', '122', '1222')) AS dam_line_id
  FROM anc GROUP BY root_id
)
SELECT g1.root_id AS horse_id, COALESCE(common_ancestors, 0) AS common_ancestors, COALESCE(path_pairs, 0) AS path_pairs,
  COALESCE(f, 0) AS inbreeding_32nds, COALESCE(f, 0) / 32.0::DOUBLE AS inbreeding, sire_line_id, dam_line_id
FROM (SELECT DISTINCT root_id FROM g1) g1 LEFT JOIN m ON m.root_id = g1.root_id LEFT JOIN l ON l.root_id = g1.root_id"""


def line_cross_roi(since_year: int = 2000, min_races: int = 20) -> str:
    crosses = """
crosses AS (
  SELECT a.root_id, a.id AS sire_sire_id, b.id AS dam_sire_id FROM anc a JOIN anc b ON b.root_id = a.root_id
  WHERE a.pos = '111' AND b.pos = '121'
)"""
    return _with(_rated(False), _pedigree("SELECT DISTINCT ketto_toroku_bango AS root_id FROM jvd_um"), _ANCESTORS, crosses) + "\n" + _report(
        "rated JOIN crosses ON crosses.root_id = rated.horse_id", ["sire_sire_id", "dam_sire_id"],
        ("total_races", "wins", "win_rate", "roi_percentage", "avg_win_odds"), f"kaisai_nen >= '{since_year}'", min_races)


def pedigree_rows_with_stock() -> str:
    stock = f"""
jvd_hn AS (
  SELECT {_pad("CAST(9000000000 + p_partkey AS VARCHAR)", 10)} AS no,
    CASE WHEN p_partkey % 26 = 0 THEN {_pad("CAST(p_partkey // 5 + 1 AS VARCHAR)", 10)} END AS reg, 'STOCK ' || p_partkey AS bamei,
    CASE WHEN p_partkey % 3 <> 0 THEN {_pad("CAST(p_partkey // 39 * 13 + 9000000000 AS VARCHAR)", 10)}
         ELSE {_pad("CAST(p_partkey // 39 + 1 AS VARCHAR)", 10)} END AS sire_no,
    CASE WHEN p_partkey % 4 <> 0 THEN {_pad("CAST(p_partkey // 39 * 26 + 9000000000 AS VARCHAR)", 10)} END AS dam_no
  FROM part WHERE p_partkey % 13 = 0
),
ids AS (SELECT no, COALESCE(reg, no) AS id FROM jvd_hn),
stock AS (
  SELECT i.id, min(h.bamei) AS name,
    min(CASE WHEN COALESCE(s.id, h.sire_no) NOT IN ('0000000000', i.id) THEN COALESCE(s.id, h.sire_no) END) AS sire_id,
    min(CASE WHEN COALESCE(d.id, h.dam_no) NOT IN ('0000000000', i.id) THEN COALESCE(d.id, h.dam_no) END) AS dam_id
  FROM jvd_hn h JOIN ids i ON i.no = h.no LEFT JOIN ids s ON s.no = h.sire_no LEFT JOIN ids d ON d.no = h.dam_no GROUP BY i.id
),
named AS (SELECT id, name FROM stock),
own AS (
  SELECT u.ketto_toroku_bango AS id, trim(u.bamei) AS name,
    CASE WHEN COALESCE(s.id, ketto_joho_01a) NOT IN ('0000000000', u.ketto_toroku_bango) THEN COALESCE(s.id, ketto_joho_01a) END AS sire_id,
    trim(ketto_joho_01b) AS sire_name,
    CASE WHEN COALESCE(d.id, ketto_joho_02a) NOT IN ('0000000000', u.ketto_toroku_bango) THEN COALESCE(d.id, ketto_joho_02a) END AS dam_id,
    trim(ketto_joho_02b) AS dam_name
  FROM jvd_um u LEFT JOIN ids s ON s.no = u.ketto_joho_01a LEFT JOIN ids d ON d.no = u.ketto_joho_02a
),
um AS (
  SELECT COALESCE(o.id, k.id) AS id, COALESCE(o.name, k.name) AS name, COALESCE(o.sire_id, k.sire_id) AS sire_id,
    CASE WHEN o.sire_id IS NOT NULL THEN o.sire_name ELSE ns.name END AS sire_name,
    COALESCE(o.dam_id, k.dam_id) AS dam_id, CASE WHEN o.dam_id IS NOT NULL THEN o.dam_name ELSE nd.name END AS dam_name
  FROM own o FULL JOIN stock k ON k.id = o.id
  LEFT JOIN named ns ON ns.id = COALESCE(o.sire_id, k.sire_id) LEFT JOIN named nd ON nd.id = COALESCE(o.dam_id, k.dam_id)
)"""
    steps = _pedigree("SELECT id AS root_id FROM um")
    steps = steps[steps.index("roots AS"):]
    return _with(stock, "\n" + steps) + """
SELECT root_id, horse_id, horse_name, sire_id, sire_name, dam_id, dam_name, generation, position
FROM pedigree"""

"""Column rules that turn raw race codes into the classes reports group by.

Every rule is a built-in ``CASE WHEN`` expression, so it stays inside
whole-stage codegen and Catalyst can push it around like any other column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
# Codes and labels of the race data; they must stay exactly as written
# (labels are Japanese text, the popularity labels use full-width brackets).
COURSE_NAMES = {
    "01": "札幌",
    "02": "函館",
    "03": "福島",
    "04": "新潟",
    "05": "東京",
    "06": "中山",
    "07": "中京",
    "08": "京都",
    "09": "阪神",
    "10": "小倉",
}
TURF = "芝"
DIRT = "ダート"
OTHER_TRACK = "その他"
TURF_PREFIX = "1"
DIRT_PREFIX = "2"
GOING_NAMES = {"1": "良", "2": "稍重", "3": "重", "4": "不良"}
UNKNOWN_GOING = "不明"
NO_GOING_CODE = "0"
SHORT = "短距離"
MIDDLE = "中距離"
LONG = "長距離"
SHORT_MAX_METRES = 1400
MIDDLE_MAX_METRES = 2000
FAVOURITE = "人気（1-3位）"
MIDFIELD = "中穴（4-8位）"
LONGSHOT = "大穴（9位-）"
# ----------------------------------------------------------------------------


def _lookup(code: Column, table: dict[str, str], default: Column) -> Column:
    expr = None
    for key, label in table.items():
        expr = (F.when(code == key, label) if expr is None
                else expr.when(code == key, label))
    return expr.otherwise(default)


def course_name(keibajo_code: Column) -> Column:
    """Course code to course name; an unknown code stays as it is."""
    return _lookup(keibajo_code, COURSE_NAMES, keibajo_code)


def course_code(name: Column) -> Column:
    """Inverse of :func:`course_name` for requests: a name that is not a
    known course is taken as the code itself (so raw codes work too)."""
    return _lookup(name, {v: k for k, v in COURSE_NAMES.items()}, name)


def _surface(track_code: Column) -> Column:
    return F.substring(track_code, 1, 1)


def track_type(track_code: Column) -> Column:
    """First character of the track code: turf, dirt, or other (incl. NULL)."""
    s = _surface(track_code)
    return (F.when(s == TURF_PREFIX, TURF)
            .when(s == DIRT_PREFIX, DIRT)
            .otherwise(OTHER_TRACK))


def _going_code(track_code: Column, shiba: Column, dirt: Column) -> Column:
    s = _surface(track_code)
    return F.when(s == TURF_PREFIX, shiba).when(s == DIRT_PREFIX, dirt)


def condition_code(track_code: Column, shiba: Column, dirt: Column) -> Column:
    """Raw going code of the surface raced on (NULL stays NULL), '0' on other
    tracks."""
    s = _surface(track_code)
    return (F.when(s == TURF_PREFIX, shiba).when(s == DIRT_PREFIX, dirt)
            .otherwise(F.lit(NO_GOING_CODE)))


def track_condition(track_code: Column, shiba: Column, dirt: Column) -> Column:
    """Going label of the surface raced on; unknown for other tracks, other
    codes and NULL."""
    return _lookup(_going_code(track_code, shiba, dirt), GOING_NAMES,
                   F.lit(UNKNOWN_GOING))


def distance_category(distance_m: Column) -> Column:
    """Short up to 1400 m, middle up to 2000 m, long otherwise (incl. NULL)."""
    return (F.when(distance_m <= SHORT_MAX_METRES, SHORT)
            .when(distance_m <= MIDDLE_MAX_METRES, MIDDLE)
            .otherwise(LONG))


def popularity_category(popularity: Column) -> Column:
    """Betting rank 1-3, 4-8, anything else (incl. NULL and 0)."""
    return (F.when(popularity.between(1, 3), FAVOURITE)
            .when(popularity.between(4, 8), MIDFIELD)
            .otherwise(LONGSHOT))

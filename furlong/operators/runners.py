"""Rated runners: the one table every report is computed from.

runner ⋈ race (4-column race key) [⋈ horse], restricted to runners that
count for ROI, with the class columns the reports group by.

Plan shape: the runner filter and the optional year filter sit directly on
the scans (the year filter is applied to both tables, so a table stored
partitioned by ``kaisai_nen`` is pruned on both sides); the race table is
the small side of an N:1 equi-join and is broadcast by adaptive execution
only when its measured size is under the broadcast threshold, otherwise both
sides are shuffled on the race key (a race has at most a few dozen runners,
so the key cannot be hot).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.functions import buckets as B
from furlong.functions.filters import is_rated, known_parent, since_year as year_filter
from furlong.schema import RACE_KEY, RaceTables

ODDS_TYPE = "decimal(12,2)"

BAD_VALUES = ("fail", "null")


def _ten() -> Column:
    return F.lit(Decimal("10.0"))


#: Odds text with a digit beyond the hundredths, which ODDS_TYPE cannot keep.
_TOO_FINE = r"\.[0-9]{2}[0-9]*[1-9]"


def _caster(bad_values: str):
    """``(text, type) -> value``.  Text that is not such a number raises
    ('fail') or gives NULL ('null'), whatever the session's ANSI setting."""
    if bad_values not in BAD_VALUES:
        raise ValueError(f"bad_values must be one of {BAD_VALUES}")

    def cast(text: Column, kind: str) -> Column:
        value = text.try_cast(kind)
        if kind == ODDS_TYPE:
            value = F.when(~text.rlike(_TOO_FINE), value)
        if bad_values == "null":
            return value
        bad = F.raise_error(F.concat(F.lit(f"not a {kind}: "), text)).cast(kind)
        return F.when(text.isNotNull() & value.isNull(), bad).otherwise(value)

    return cast


def runner_columns(bad_values: str = "fail") -> list[Column]:
    """The runner-side columns of rated runners (need no race)."""
    cast = _caster(bad_values)
    odds = cast(F.col("tansho_odds"), ODDS_TYPE)
    return [
        F.col("ketto_toroku_bango").alias("horse_id"),
        F.col("kishu_code").alias("jockey_id"),
        F.trim("kishumei_ryakusho").alias("jockey_name"),
        F.col("kakutei_chakujun").alias("finish_pos"),
        (odds / _ten()).alias("win_odds"),
        # Same odds as an exact long in thousandths (what the metrics sum).
        (odds * F.lit(Decimal(100))).cast("long").alias("odds_milli"),
        cast(F.col("tansho_ninkijun"), "int").alias("popularity"),
    ]


def rated_runners(
    t: RaceTables,
    since_year: int | None = None,
    with_sire: bool = False,
    exclude_unknown_sire: bool = False,
    bad_values: str = "fail",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Rated runner rows with their race classes (Q10).

    ``bad_values='fail'`` raises on text of a rated runner that is not a
    number (odds, rank, distance) or has odds finer than hundredths;
    ``'null'`` turns it into NULL.  ``with_sire`` adds the horse's sire
    (runners of unknown horses drop).  ``carry`` names further runner columns
    to pass through unchanged.
    """
    cast = _caster(bad_values)
    rated = is_rated(F.col("kakutei_chakujun"), F.col("tansho_odds"))
    yf = year_filter(F.col("kaisai_nen"), since_year)
    if yf is not None:
        rated &= yf
    if t.runs is not None:
        df = t.runs.where(rated)
    else:
        races = t.races if yf is None else t.races.where(yf)
        df = t.runners.where(rated).join(races, list(RACE_KEY), "inner")

    sire_cols: list[Column] = []
    if with_sire:
        horses = t.horses.select(
            "ketto_toroku_bango",
            F.col("ketto_joho_01a").alias("sire_id"),
            F.trim("ketto_joho_01b").alias("sire_name"),
        )
        if exclude_unknown_sire:
            horses = horses.where(known_parent(F.col("sire_id")))
        df = df.join(horses, "ketto_toroku_bango", "inner")
        sire_cols = [F.col("sire_id"), F.col("sire_name")]

    # Race-side casts are pinned above the join by referencing a runner
    # column: a predicate on a derived class (e.g. from a request join) can
    # then not be pushed to the race scan and cast races no rated runner
    # ran in.
    on_rated_row = F.col("tansho_odds").isNotNull()
    distance = F.when(on_rated_row, cast(F.col("kyori"), "int"))
    horse, jockey, name, finish, win_odds, odds_milli, popularity = runner_columns(bad_values)
    track = F.col("track_code")
    shiba, dirt = F.col("babajotai_code_shiba"), F.col("babajotai_code_dirt")
    return df.select(
        *[F.col(k) for k in RACE_KEY],
        horse,
        jockey,
        name,
        B.course_name(F.col("keibajo_code")).alias("course_name"),
        B.track_type(track).alias("track_type"),
        B.condition_code(track, shiba, dirt).alias("condition_code"),
        B.track_condition(track, shiba, dirt).alias("track_condition"),
        B.distance_category(distance).alias("distance_category"),
        B.popularity_category(cast(F.col("tansho_ninkijun"), "int")).alias("popularity_category"),
        finish,
        win_odds,
        odds_milli,
        popularity,
        *sire_cols,
        *[F.col(c) for c in carry],
    )

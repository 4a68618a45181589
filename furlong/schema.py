"""Input table schemas and the holder that passes them around.

The three source tables carry every column as text, as the race database
they come from does: numbers are cast where they are used, codes are
compared with quoted literals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType


def _text_schema(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# Race key shared by races and runners.
RACE_KEY = ("kaisai_nen", "kaisai_tsukihi", "keibajo_code", "race_bango")

RACES_SCHEMA = _text_schema(
    *RACE_KEY,
    "track_code",
    "babajotai_code_shiba",
    "babajotai_code_dirt",
    "kyori",
)

RUNNERS_SCHEMA = _text_schema(
    *RACE_KEY,
    "ketto_toroku_bango",
    "kishu_code",
    "kishumei_ryakusho",
    "kakutei_chakujun",
    "tansho_odds",
    "tansho_ninkijun",
    "umaban",
)

HORSES_SCHEMA = _text_schema(
    "ketto_toroku_bango",
    "bamei",
    "ketto_joho_01a",
    "ketto_joho_01b",
    "ketto_joho_02a",
    "ketto_joho_02b",
)


# --- Fixed values -----------------------------------------------------------
# Columns of the payout table: winning slots (horse number, amount per 100) and
# the refund marks (one character per horse number, '1' where refunded).
WIN_SLOTS = (
    ("haraimodoshi_tansho_1a", "haraimodoshi_tansho_1b"),
    ("haraimodoshi_tansho_2a", "haraimodoshi_tansho_2b"),
    ("haraimodoshi_tansho_3a", "haraimodoshi_tansho_3b"),
)
REFUND_MARKS = "henkan_umaban"
# ----------------------------------------------------------------------------

PAYOUTS_SCHEMA = _text_schema(*RACE_KEY, *[c for slot in WIN_SLOTS for c in slot], REFUND_MARKS)


@dataclass(frozen=True)
class RaceTables:
    """Races (one row per race), runners (one row per starter) and horses
    (one row per registered horse, with sire and dam); and, for the operators
    that settle bets, payouts (one row per settled race), which name runners by
    their horse number (``umaban``).  ``runs``, where given, are the runners joined
    with their races (see :func:`furlong.sources.tables.with_runs`): operators read
    them instead of joining again."""

    races: DataFrame
    runners: DataFrame
    horses: DataFrame
    payouts: DataFrame | None = None
    runs: DataFrame | None = None

    def joined_runs(self) -> DataFrame:
        """Every runner with its race."""
        return self.runners.join(self.races, list(RACE_KEY), "inner") if self.runs is None else self.runs

    def select_known(self) -> "RaceTables":
        """Keep only the declared columns (extra source columns are dropped)."""
        return RaceTables(
            self.races.select(*RACES_SCHEMA.fieldNames()),
            self.runners.select(*RUNNERS_SCHEMA.fieldNames()),
            self.horses.select(*HORSES_SCHEMA.fieldNames()),
            None if self.payouts is None else self.payouts.select(*PAYOUTS_SCHEMA.fieldNames()),
        )

from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from furlong.plans.session import ensure_checkpoint_dir, local_session  # noqa: E402
from pyspark.sql.types import StringType, StructField, StructType  # noqa: E402

from furlong.schema import HORSES_SCHEMA, PAYOUTS_SCHEMA, RACES_SCHEMA, RUNNERS_SCHEMA, RaceTables  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app_name="furlong-tests")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="furlong-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="furlong-test-")


def _frame(spark, schema, rows, defaults):
    names = schema.fieldNames()
    data = [tuple({**defaults, **r}.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, schema)


RACE_DEFAULTS = {"kaisai_nen": "2005", "kaisai_tsukihi": "0101", "keibajo_code": "05",
                 "race_bango": "01", "track_code": "11", "babajotai_code_shiba": "1",
                 "babajotai_code_dirt": "1", "kyori": "1600"}
RUNNER_DEFAULTS = {"kaisai_nen": "2005", "kaisai_tsukihi": "0101", "keibajo_code": "05",
                   "race_bango": "01", "ketto_toroku_bango": "H1", "kishu_code": "J1",
                   "kishumei_ryakusho": "Jockey One", "kakutei_chakujun": "02",
                   "tansho_odds": "0100", "tansho_ninkijun": "01"}
HORSE_DEFAULTS = {"ketto_toroku_bango": "H1", "bamei": "Horse One", "ketto_joho_01a": "S1",
                  "ketto_joho_01b": "Sire One", "ketto_joho_02a": "D1",
                  "ketto_joho_02b": "Dam One"}


@pytest.fixture
def tables(spark):
    """Build RaceTables from lists of partial row dicts (defaults fill the rest)."""
    def build(races=(), runners=(), horses=(), payouts=None, extra=()) -> RaceTables:
        """``extra``: names of further runner columns."""
        of_runner = StructType([*RUNNERS_SCHEMA.fields, *[StructField(c, StringType()) for c in extra]])
        return RaceTables(
            _frame(spark, RACES_SCHEMA, list(races) or [{}], RACE_DEFAULTS),
            _frame(spark, of_runner, list(runners), RUNNER_DEFAULTS),
            _frame(spark, HORSES_SCHEMA, list(horses), HORSE_DEFAULTS),
            None if payouts is None else _frame(spark, PAYOUTS_SCHEMA, list(payouts), RACE_DEFAULTS),
        )
    return build

"""Settlement from the payout table: ROI of what was paid, next to ROI of odds.

A payout record has one row per race with repeated slots: for the win bet up
to three (horse number, amount per 100 staked), since a dead heat has several
winners, each with an amount of its own; and for every horse number a mark if
its bets were refunded (a horse that did not start).

One unit is bet to win on every runner of a settled race:

* a runner whose number is in a winning slot is paid its amount / 100;
* a refunded runner's bet is returned: neither stake nor payout;
* any other bet is lost, whatever the finish text says;
* races without a payout record are not settled: their runners count for the
  quoted-odds figures only.

Quoted-odds ROI pays the odds of every runner with finish 01.  The two differ
where a dead heat splits the pool, where odds moved, or where a winner is
missing from the record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.functions.filters import is_rated, since_year as year_filter
from furlong.functions.metrics import N, metric_columns, total_columns
from furlong.functions.rounding import percent2
from furlong.functions import buckets as B
from furlong.operators.runners import runner_columns
from furlong.schema import RACE_KEY, REFUND_MARKS, RaceTables, WIN_SLOTS

STAKE = 100  # an amount is paid per this stake


def _number(text: Column) -> Column:
    """A horse number or amount: digits, not all zero; else NULL."""
    value = F.when(text.rlike(r"\A[0-9]+\z"), text.try_cast("bigint"))
    return F.when(value > 0, value)


def win_payouts(payouts: DataFrame) -> DataFrame:
    """The filled winning slots as rows: race key, ``horse_number``, ``amount``.
    A slot without a horse number or without an amount is empty; a number that
    several slots name is paid their sum."""
    slots = F.array(*[F.struct(_number(F.col(a)).alias("horse_number"), _number(F.col(b)).alias("amount")) for a, b in WIN_SLOTS])
    rows = payouts.select(*RACE_KEY, F.explode(slots).alias("s")).select(*RACE_KEY, "s.horse_number", "s.amount")
    return rows.where("horse_number IS NOT NULL AND amount IS NOT NULL").groupBy(*RACE_KEY, "horse_number").agg(
        F.sum("amount").alias("amount"))


def settled_runners(t: RaceTables, since_year: int | None = None, bad_values: str = "fail") -> DataFrame:
    """Every runner of a known race: the columns of the rated runners the reports
    group by, ``rated`` (counts for quoted odds), ``settled`` (its race has a
    payout record), ``refunded``, ``stake`` (0 or 1) and ``paid`` (per 100).

    The slots of a race (three) and its refund marks ride along the join of
    runners with races, and are looked up per runner: settlement adds one join,
    on the race key, and no row is copied.  Of several records of a race the
    one with the largest slots counts."""
    if t.payouts is None:
        raise ValueError("these race tables have no payouts")
    runners, races = t.runners, t.races
    slots = F.array(*[F.struct(_number(F.col(a)).alias("no"), _number(F.col(b)).alias("amount")) for a, b in WIN_SLOTS])
    records = t.payouts.groupBy(*RACE_KEY).agg(
        F.max(F.struct(slots.alias("slots"), F.coalesce(REFUND_MARKS, F.lit("")).alias("marks"))).alias("_record"))
    wanted = year_filter(F.col("kaisai_nen"), since_year)
    if wanted is not None:
        runners, races, records = runners.where(wanted), races.where(wanted), records.where(wanted)
    met = runners.join(races, list(RACE_KEY)).join(records, list(RACE_KEY), "left")

    rated = is_rated(F.col("kakutei_chakujun"), F.col("tansho_odds"))
    number = _number(F.col("umaban"))
    mine = F.filter(F.col("_record.slots"), lambda s: s["no"] == number)
    paid = F.aggregate(mine, F.lit(0).cast("long"), lambda x, s: x + F.coalesce(s["amount"], F.lit(0).cast("long")))
    refunded = F.substring(F.col("_record.marks"), number.cast("int"), F.lit(1)) == "1"
    met = met.withColumns({
        "settled": F.col("_record").isNotNull(),
        "rated": F.coalesce(rated, F.lit(False)),
        "refunded": F.coalesce(refunded, F.lit(False)),
        "_paid": F.coalesce(paid, F.lit(0).cast("long")),
    })
    bet = F.col("settled") & ~F.col("refunded")
    guarded = [F.when(F.col("rated"), c).alias(n) for c, n in zip(
        runner_columns(bad_values)[3:], ("finish_pos", "win_odds", "odds_milli", "popularity"), strict=True)]
    return met.select(
        *RACE_KEY, "umaban",
        F.col("ketto_toroku_bango").alias("horse_id"), F.col("kishu_code").alias("jockey_id"),
        F.trim("kishumei_ryakusho").alias("jockey_name"),
        B.course_name(F.col("keibajo_code")).alias("course_name"), B.track_type(F.col("track_code")).alias("track_type"),
        *guarded, "rated", "settled", "refunded",
        bet.cast("long").alias("stake"),
        F.when(bet, F.col("_paid")).otherwise(F.lit(0).cast("long")).alias("paid"),
    )


def jockey_payout_roi(t: RaceTables, since_year: int | None = 2000, min_bets: int = 20, bad_values: str = "fail") -> DataFrame:
    """Per jockey × course: the quoted-odds record of the rated runners
    (``total_races``, ``wins``, ``roi_percentage``) next to the settled bets:
    ``bets``, ``refunds``, ``paid_bets`` (bets that were paid something) and
    ``payout_roi_percentage``; groups with at least ``min_bets`` bets."""
    keys = ("jockey_id", "jockey_name", "course_name")
    runs = settled_runners(t, since_year, bad_values)
    # finish, odds and rank are NULL where a runner is not rated, so the totals
    # but the plain count leave it out
    totals = [F.count(F.when(F.col("rated"), 1)).alias(N), *total_columns()[1:]]
    out = runs.groupBy(*keys).agg(
        *totals, F.sum("stake").alias("bets"), F.count(F.when(F.col("settled") & F.col("refunded"), 1)).alias("refunds"),
        F.count(F.when(F.col("paid") > 0, 1)).alias("paid_bets"), F.sum("paid").alias("_paid"))
    return out.where(F.col("bets") >= min_bets).select(
        *keys, *metric_columns(["total_races", "wins", "roi_percentage"]), "bets", "refunds", "paid_bets",
        percent2(F.col("_paid"), F.col("bets") * F.lit(STAKE)).alias("payout_roi_percentage"))

"""Race tables derived from the generic benchmark tables (orders, lineitem,
part), so every query's work grows with the input scale.

    races   = one row per order
    runners = one row per line item, in the race of its order
    horses  = one row per part (every 50th part is left out, so some
              runners have no horse row)

Codes are spread over the value space so that every class, sentinel and
bad-value branch of the reports occurs (empty / NULL / non-numeric
finishes, NULL odds, unknown sires, missing dams, a renamed jockey ...).
The same mapping is written as SQL in :mod:`furlong.sources.oracle_sql`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.schema import HORSES_SCHEMA, PAYOUTS_SCHEMA, RACES_SCHEMA, REFUND_MARKS, RUNNERS_SCHEMA, WIN_SLOTS, RaceTables


#: Runner columns beyond the declared ones, for the features that name a
#: closing time, a flag or a score.
EXTRA_RUNNER_COLUMNS = ("closing_time", "run_flag", "run_score")


def _pad(c: Column, n: int) -> Column:
    """Zero-padded to ``n`` characters; longer text stays whole (``lpad``
    alone would cut it)."""
    text = c.cast("string")
    return F.when(F.length(text) < n, F.lpad(text, n, "0")).otherwise(text)


def _pad_short(c: Column, n: int) -> Column:
    """The same for numbers of at most ``n`` digits.  The number occurs once in
    the expression: padded columns are built from long ones, and the optimizer
    writes those out wherever a filter or projection names them."""
    return F.lpad(c.cast("string"), n, "0")


def _races_with_order_key(orders: DataFrame) -> DataFrame:
    k, cust, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    track = (F.when(k % 5 == 0, "11").when(k % 5 == 1, "17").when(k % 5 == 2, "23")
             .when(k % 5 == 3, "24").otherwise("51"))
    return orders.select(
        k.alias("_order_key"),
        F.year(d).cast("string").alias("kaisai_nen"),
        _pad_short(F.month(d) * 100 + F.dayofmonth(d), 4).alias("kaisai_tsukihi"),
        _pad_short(cust % 12 + 1, 2).alias("keibajo_code"),
        _pad(k, 8).alias("race_bango"),
        track.alias("track_code"),
        F.when(k % 17 != 0, (cust % 5).cast("string")).alias("babajotai_code_shiba"),
        F.when(k % 19 != 0, ((cust + 2) % 5).cast("string")).alias("babajotai_code_dirt"),
        F.when(k % 29 != 0, _pad_short(F.lit(1000) + (k % 27) * 100, 4)).alias("kyori"),
    )


def _runners(lineitem: DataFrame, races: DataFrame) -> DataFrame:
    # The race number is the zero-padded order key, so joining on the
    # numeric key is the same join as on the text race number.
    li = lineitem.join(races, lineitem["l_orderkey"] == races["_order_key"], "inner")
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    ln = F.col("l_linenumber").cast("long")
    h = (ok * 31 + ln * 17 + pk) % 24
    g = ok * 13 + ln * 101 + pk * 7 + sk
    jockey = sk % 8
    finish = (F.when(h <= 17, _pad_short(h + 1, 2)).when(h == 18, "1").when(h == 19, "00")
              .when(h == 20, "99").when(h == 21, "DNF").when(h == 22, ""))
    name = (F.when((jockey == 7) & (F.col("kaisai_nen") >= "2001"), " JOCKEY 7B ")
            .otherwise(F.concat(F.lit(" JOCKEY "), jockey.cast("string"), F.lit("  "))))
    return li.select(
        "kaisai_nen", "kaisai_tsukihi", "keibajo_code", "race_bango",
        _pad(pk + 1, 10).alias("ketto_toroku_bango"),
        _pad_short(jockey, 5).alias("kishu_code"),
        name.alias("kishumei_ryakusho"),
        finish.alias("kakutei_chakujun"),
        F.when(g % 31 != 0, _pad_short(g % 990 + 10, 4)).alias("tansho_odds"),
        F.when(g % 37 != 0, _pad_short(g % 19, 2)).alias("tansho_ninkijun"),
        F.when(g % 41 != 0, (F.lit(330) + F.col("l_quantity").cast("long")).cast("string")).alias("closing_time"),
        F.col("l_returnflag").alias("run_flag"),
        F.when(g % 43 != 0, (g % 101).cast("string")).alias("run_score"),
        _pad_short(ln, 2).alias("umaban"),
    )


def _payouts(runners: DataFrame) -> DataFrame:
    """One record per settled race (one race number in 23 has none).  Its slots
    are the first three runners with finish 01, by horse number, with amounts
    near their odds, split where there are several winners; scratched runners
    (finish 00) are refunded.  A race has at most seven runners here."""
    number = F.col("umaban").cast("int")
    tenths = F.coalesce(F.col("tansho_odds").cast("long"), F.lit(10))
    winner = F.when(F.col("kakutei_chakujun") == "01", F.struct(number.alias("no"), tenths.alias("tenths")))
    of_race = runners.groupBy(*PAYOUTS_SCHEMA.fieldNames()[:4]).agg(
        F.array_sort(F.collect_list(winner)).alias("w"),
        F.array_sort(F.collect_list(F.when(F.col("kakutei_chakujun") == "00", number))).alias("gone"))
    of_race = of_race.where(F.col("race_bango").cast("long") % 23 != 0)
    columns = []
    for k, (a, b) in enumerate(WIN_SLOTS):
        w = F.get("w", F.lit(k))
        # what the pool pays per 100, in steps of ten, 100 at least
        amount = F.greatest(F.lit(100).cast("long"), F.call_function("div", w["tenths"] * 10 - 4, F.size("w") * 10) * 10)
        columns += [F.when(w.isNotNull(), _pad_short(w["no"], 2)).otherwise("00").alias(a),
                    F.when(w.isNotNull(), F.lpad(amount.cast("string"), 7, "0")).otherwise("").alias(b)]
    marks = F.concat(*[F.when(F.array_contains("gone", n), "1").otherwise("0") for n in range(1, 9)])
    return of_race.select(*PAYOUTS_SCHEMA.fieldNames()[:4], *columns, marks.alias(REFUND_MARKS))


def _horses(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    sire = F.floor(p / 40).cast("long")
    dam = F.floor(p / 7).cast("long")
    dam_id = (F.when(p % 11 == 0, F.lit(None).cast("string"))
              .when(p % 13 == 0, _pad(p + 9000000000, 10))
              .otherwise(_pad(dam, 10)))
    return part.where(p % 50 != 49).select(
        _pad(p + 1, 10).alias("ketto_toroku_bango"),
        F.concat(F.col("p_name"), F.lit("  ")).alias("bamei"),
        _pad(sire, 10).alias("ketto_joho_01a"),
        F.concat(F.lit("SIRE "), sire.cast("string"), F.lit(" ")).alias("ketto_joho_01b"),
        dam_id.alias("ketto_joho_02a"),
        F.concat(F.lit("DAM "), dam.cast("string")).alias("ketto_joho_02b"),
    )


def breeding_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A breeding-stock table: the dams that are named by numbers over nine
    billion.  Every other one maps to a registered horse, the rest have no
    registration; parents are other numbers of the table, or a registered id."""
    p = F.col("p_partkey")
    part = _read(spark, sf_dir, "part").where(p % 13 == 0)
    older = F.floor(p / 39).cast("long")
    return part.select(
        _pad(p + 9000000000, 10).alias("hanshoku_toroku_bango"),
        F.when(p % 26 == 0, _pad(F.floor(p / 5).cast("long") + 1, 10)).alias("ketto_toroku_bango"),
        F.concat(F.lit("STOCK "), p.cast("string")).alias("bamei"),
        F.when(p % 3 != 0, _pad(older * 13 + 9000000000, 10)).otherwise(_pad(older + 1, 10)).alias("fuba_hanshoku_bango"),
        F.when(p % 4 != 0, _pad(older * 26 + 9000000000, 10)).alias("boba_hanshoku_bango"),
    )


# Columns read from the benchmark tables, with their declared types (no
# schema inference job; only these columns are read).
SOURCE_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_returnflag STRING",
    "part": "p_partkey BIGINT, p_name STRING",
}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def fixture_tables(spark: SparkSession, sf_dir: str) -> RaceTables:
    """Races, runners and horses derived from ``sf_dir``'s parquet tables.

    Line items are always hash-partitioned by their order (the key of the
    join with the races), whatever the number of input splits.  A few orders
    have no race row (runners of unknown races), a few have two."""
    orders = _read(spark, sf_dir, "orders")
    lineitem = _read(spark, sf_dir, "lineitem").repartition("l_orderkey")
    part = _read(spark, sf_dir, "part")
    races_k = _races_with_order_key(orders)
    key = F.col("_order_key")
    copies = F.when(key % 97 == 0, F.array().cast("array<int>")).when(
        key % 101 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    races = races_k.withColumn("_copy", F.explode(copies))
    runners = _runners(lineitem, races_k)
    return RaceTables(
        races=races.select(*RACES_SCHEMA.fieldNames()),
        runners=runners.select(*RUNNERS_SCHEMA.fieldNames(), *EXTRA_RUNNER_COLUMNS),
        horses=_horses(part).select(*HORSES_SCHEMA.fieldNames()),
        payouts=_payouts(runners),
    )

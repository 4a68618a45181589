"""Horses and breeding stock as one parent table.

Horses are registered under one id; breeding stock has a number of its own,
under which horses name their parents, and the breeding-stock table maps it to
a registration, where there is one.  ``resolved_horses`` gives a horse table in
one id space, so that the pedigree operators work on it unchanged:

* a breeding number that maps to a registration is that registration;
* one that maps to none stays, as a node of its own with the stock's parents;
* a parent id that is no breeding number stays as it is;
* where an id has a horse row and a stock row, the horse row comes first:
  its name and each known parent hold, and the stock fills what is unknown;
* a horse that would be its own parent has that parent unknown; longer loops
  end with the pedigree's depth.

Plan: the map is unique per breeding number; both parents of all rows are
looked up by one left join (rows are split into their two sides), and come
back together by an aggregate on the node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.functions.filters import known_parent
from furlong.schema import HORSES_SCHEMA

# --- Fixed values: columns of the breeding-stock table as read here -----------
STOCK_KEY = "hanshoku_toroku_bango"
STOCK_COLUMNS = (STOCK_KEY, "ketto_toroku_bango", "bamei", "fuba_hanshoku_bango", "boba_hanshoku_bango")
# ----------------------------------------------------------------------------


def stock_ids(stock: DataFrame) -> DataFrame:
    """``number, id``: every breeding number with the id it stands for (the
    smallest registration that it maps to, or itself)."""
    known = F.when(known_parent(F.col("ketto_toroku_bango")), F.col("ketto_toroku_bango"))
    return stock.where(F.col(STOCK_KEY).isNotNull()).groupBy(F.col(STOCK_KEY).alias("number")).agg(
        F.min(known).alias("_id")).select("number", F.coalesce("_id", "number").alias("id"))


def resolved_horses(horses: DataFrame, stock: DataFrame) -> DataFrame:
    """A horse table over both: ids resolved, one row per id, the columns of
    :data:`HORSES_SCHEMA`."""
    ids = stock_ids(stock)
    side = F.struct(F.lit(0).alias("place"), F.col("bamei").alias("name"))
    own = horses.where(F.col("ketto_toroku_bango").isNotNull()).select(
        F.col("ketto_toroku_bango").alias("id"), side.alias("from"),
        F.struct(F.col("ketto_joho_01a").alias("no"), F.col("ketto_joho_01b").alias("name")).alias("sire"),
        F.struct(F.col("ketto_joho_02a").alias("no"), F.col("ketto_joho_02b").alias("name")).alias("dam"))
    nameless = F.lit(None).cast("string")
    theirs = stock.join(ids, F.col(STOCK_KEY) == F.col("number")).select(
        "id", F.struct(F.lit(1).alias("place"), F.col("bamei").alias("name")).alias("from"),
        F.struct(F.col("fuba_hanshoku_bango").alias("no"), nameless.alias("name")).alias("sire"),
        F.struct(F.col("boba_hanshoku_bango").alias("no"), nameless.alias("name")).alias("dam"))
    # one row per node and parent; a parent's name is taken from its own row below
    parents = F.array(F.struct(F.lit("sire").alias("side"), F.col("sire").alias("p")), F.struct(F.lit("dam").alias("side"), F.col("dam").alias("p")))
    rows = own.unionByName(theirs).select("id", "from", F.explode(parents).alias("x")).select(
        "id", "from", "x.side", F.when(known_parent(F.col("x.p.no")), F.col("x.p.no")).alias("no"), F.col("x.p.name").alias("pname"))
    # unknown parents get lookup keys of their own, so that they are not one task
    look = F.coalesce("no", F.concat(F.lit("?"), F.col("id")))
    parent_ids = ids.select(F.col("number").alias("_number"), F.col("id").alias("_parent"))
    rows = rows.withColumn("_look", look).join(parent_ids, F.col("_look") == F.col("_number"), "left")
    rows = rows.withColumn("parent", F.when(F.col("no").isNotNull(), F.coalesce("_parent", "no")))
    rows = rows.withColumn("parent", F.when(F.col("parent") != F.col("id"), F.col("parent")))

    def first(which: str):
        # a horse row's known parent before the stock's; then the smallest
        found = F.when((F.col("side") == which) & F.col("parent").isNotNull(), F.struct("from.place", "parent", "pname"))
        return F.min(found)

    nodes = rows.groupBy("id").agg(F.min("from").alias("from"), first("sire").alias("s"), first("dam").alias("d"))
    named = stock.join(ids, F.col(STOCK_KEY) == F.col("number")).groupBy(F.col("id").alias("_nid")).agg(F.min("bamei").alias("_stock_name"))

    def with_name(df: DataFrame, which: str) -> DataFrame:
        look = F.coalesce(F.col(f"{which}.parent"), F.concat(F.lit("?"), F.col("id")))
        return df.withColumn("_look", look).join(named, F.col("_look") == F.col("_nid"), "left").withColumn(
            f"{which}_name", F.coalesce(F.col(f"{which}.pname"), F.col("_stock_name"))).drop("_look", "_nid", "_stock_name")

    nodes = with_name(with_name(nodes, "s"), "d")
    return nodes.select(
        F.col("id").alias("ketto_toroku_bango"), F.col("from.name").alias("bamei"),
        F.col("s.parent").alias("ketto_joho_01a"), F.col("s_name").alias("ketto_joho_01b"),
        F.col("d.parent").alias("ketto_joho_02a"), F.col("d_name").alias("ketto_joho_02b"),
    ).select(*HORSES_SCHEMA.fieldNames())

"""Pedigree expansion (Q8) and the nested pedigree tree (Q9).

Rows: generation 1 is the horse itself (position '1'); each further
generation appends '1' for the sire side and '2' for the dam side to the
child's position.  A parent that is NULL or the 'unknown' sentinel gets no
row; a parent id missing from the horse table gets a row with its id and
name (from the child) and NULL parents.  Depth is capped at 3, so there are
at most 1 + 2 + 4 rows per horse.

Plan: one left join per generation and no union.  Every row so far is
carried through the next join beside the parents it has (three rows from a
row of the last generation, one from an older row), so no generation is
computed twice.  Carried rows have join keys of their own that match
nothing, which spreads them over the tasks.  A popular sire is a hot join
key; adaptive execution splits an oversized join partition of that side and
broadcasts the horse table when it measures small.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.functions.filters import known_parent
from furlong.schema import RaceTables

MAX_DEPTH = 3
HORSE_KEY = "ketto_toroku_bango"  # the column that parent ids are looked up in
SIRE_SIDE = "1"
DAM_SIDE = "2"


def _horse_parents(t: RaceTables, key: str = HORSE_KEY) -> DataFrame:
    return t.horses.select(
        F.col(key).alias("_id"),
        F.trim("bamei").alias("_name"),
        F.col("ketto_joho_01a").alias("sire_id"),
        F.trim("ketto_joho_01b").alias("sire_name"),
        F.col("ketto_joho_02a").alias("dam_id"),
        F.trim("ketto_joho_02b").alias("dam_name"),
    )


def clamp_depth(depth: int) -> int:
    """At most three generations, as in the source; more are warned about."""
    if depth > MAX_DEPTH:
        warnings.warn(f"pedigree depth {depth} is over {MAX_DEPTH}; using {MAX_DEPTH}", stacklevel=3)
    return min(depth, MAX_DEPTH)


def pedigree_rows(t: RaceTables, horses: DataFrame, depth: int = MAX_DEPTH, key: str = HORSE_KEY) -> DataFrame:
    """Ancestor rows of every ``horses.horse_id`` to ``depth`` generations, by
    horse, generation and position.  ``key`` names the horse table's column that
    requested and parent ids are looked up in.  A depth over three is warned
    about and taken as three."""
    return _expand(t, horses, clamp_depth(depth), keep_unknown=False, key=key).orderBy("root_id", "generation", "position")


_OWN = ("horse_id", "horse_name", "sire_id", "sire_name", "dam_id", "dam_name")


def _expand(t: RaceTables, horses: DataFrame, depth: int, keep_unknown: bool, key: str = HORSE_KEY) -> DataFrame:
    """Pedigree rows; with ``keep_unknown`` a requested id missing from the
    horse table keeps one generation-1 row with a NULL ``horse_id``, so the
    tree needs no second pass over the requests."""
    parents = _horse_parents(t, key)
    roots = horses.select(F.col("horse_id").alias("root_id"))
    rows = roots.join(parents, F.col("root_id") == F.col("_id"),
                      "left" if keep_unknown else "inner").select(
        "root_id",
        F.col("_id").alias("horse_id"),
        F.col("_name").alias("horse_name"),
        "sire_id", "sire_name", "dam_id", "dam_name",
        F.lit(1).alias("generation"),
        F.lit(SIRE_SIDE).alias("position"),
    )
    known = parents.select("_id", *[F.col(c).alias(f"_{c}") for c in _OWN[2:]])
    for generation in range(2, depth + 1):
        def child(side: str, parent: str) -> Column:
            return F.struct(F.lit(side).alias("side"), F.col(f"{parent}_id").alias("pid"),
                            F.col(f"{parent}_name").alias("pname"))

        carried = F.struct(F.lit(None).cast("string").alias("side"),
                           F.concat(F.lit("="), F.col("root_id"), F.col("position")).alias("pid"),
                           F.lit(None).cast("string").alias("pname"))
        last = F.col("generation") == generation - 1
        step = rows.withColumn("p", F.explode(F.when(
            last, F.array(carried, child(SIRE_SIDE, "sire"), child(DAM_SIDE, "dam"))).otherwise(F.array(carried))))
        step = step.where(F.col("p.side").isNull() | known_parent(F.col("p.pid")))
        met = step.join(known, F.col("p.pid") == F.col("_id"), "left")
        new = F.col("p.side").isNotNull()
        fresh = {"horse_id": F.col("p.pid"), "horse_name": F.col("p.pname"),
                 **{c: F.col(f"_{c}") for c in _OWN[2:]},
                 "generation": F.lit(generation), "position": F.concat("position", "p.side")}
        rows = met.select("root_id", *[F.when(new, x).otherwise(F.col(c)).alias(c) for c, x in fresh.items()])
    return rows


# Node positions that the tree needs rows of: the horse and its parents.
POSITIONS = ("1", "11", "12")
_SIDE_CODE = {"sire": SIRE_SIDE, "dam": DAM_SIDE}


def _leaf(id_: Column, name: Column) -> Column:
    return F.struct(id_.alias("id"), name.alias("name"))


def _null_leaf() -> Column:
    return F.lit(None).cast("struct<id:string,name:string>")


def _mid(id_: Column, name: Column, sire: Column, dam: Column) -> Column:
    return F.struct(id_.alias("id"), name.alias("name"), sire.alias("sire"), dam.alias("dam"))


def pedigree_tree(t: RaceTables, horses: DataFrame, depth: int = MAX_DEPTH, key: str = HORSE_KEY) -> DataFrame:
    """One row per requested horse id: ``root_id`` and ``tree``, a nested
    struct {id, name, sire {id, name, sire {id, name}, dam {..}}, dam {..}}
    (Q9).

    A node's parent slots hold the id and name recorded on the node's own row;
    these are also the id and name of the parent's own node, so the last
    generation needs no rows.  Slots of the parents' parents are there from
    depth 3 on.  Absent slots are NULL, and so is the tree of an unknown
    horse.  Of several rows of one horse the smallest counts (as in the sire
    lookup).  Rows are grouped per horse (at most three), so the assembly is a
    bounded per-key aggregate; requests are read once (an unknown horse is
    carried by a left join in the first generation).  A depth over three is
    warned about and taken as three.
    """
    depth = clamp_depth(depth)
    roots = horses.select(F.col("horse_id")).distinct()
    rows = _expand(t, roots, max(1, depth - 1), keep_unknown=True, key=key)
    node = F.struct(*_OWN)
    slots = rows.groupBy("root_id").agg(*[
        F.min(F.when(F.col("position") == pos, node)).alias(f"n{pos}") for pos in POSITIONS
    ])

    def recorded(pos: str, side: str) -> tuple[Column, Column]:
        return F.col(f"n{pos}.{side}_id"), F.col(f"n{pos}.{side}_name")

    def parent(side: str) -> Column:
        pos = SIRE_SIDE + _SIDE_CODE[side]
        below = [F.when(F.col(f"n{pos}").isNotNull(), _leaf(*recorded(pos, s))) if depth > 2 else _null_leaf()
                 for s in ("sire", "dam")]
        return _mid(*recorded(SIRE_SIDE, side), *below)

    tree = F.struct(
        F.col("n1.horse_id").alias("id"),
        F.col("n1.horse_name").alias("name"),
        parent("sire").alias("sire"),
        parent("dam").alias("dam"),
    )
    # an unknown horse has only its request row (NULL horse id): NULL tree
    return slots.select("root_id", F.when(F.col("n1.horse_id").isNotNull(), tree).alias("tree"))


def flatten_tree(trees: DataFrame) -> DataFrame:
    """Tree slots as flat columns (id/name per slot), for comparisons."""
    prefixes = {(): "", ("sire",): "s_", ("dam",): "d_", ("sire", "sire"): "ss_",
                ("sire", "dam"): "sd_", ("dam", "sire"): "ds_", ("dam", "dam"): "dd_"}
    cols = [F.col("root_id")]
    for path, prefix in prefixes.items():
        base = ".".join(("tree",) + path)
        cols.append(F.col(f"{base}.id").alias(f"{prefix}id"))
        cols.append(F.col(f"{base}.name").alias(f"{prefix}name"))
    return trees.select(*cols)

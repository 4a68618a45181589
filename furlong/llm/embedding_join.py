"""Near-duplicate embeddings by a subspace pigeonhole join.

Cosine >= c of unit vectors is squared distance <= 2 - 2c.  All vectors are
turned by one fixed random rotation and split into blocks of ``BLOCK``
dimensions; a block of ``w`` of ``D`` dimensions has the proportional
squared-distance budget ``(2 - 2c) * w / D``.  A linked pair keeps to the
budget in at least one block.  Each block is range-joined: its first
coordinate is cut into cells as wide as the budget's root, and only equal
and adjacent cells meet.  Candidates (within the block's budget) are
verified by their exact cosine in double precision; a pair is counted in the
first block that finds it, so the union has no duplicates.

Scale: exact copies are one vector with a weight.  A cell with more than
``TILE`` vectors, such as that of a hot vector's near copies, is split into
tiles, and a task holds two tiles.  Tasks give back link counts per vector
and a spanning forest of the tile's links, never the pairs.

Defined results: vectors that are null, empty or zero, or hold null or
non-finite components, link with nothing; vectors of different lengths do
not link; repeated rows link with each other like any equal vectors; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import discard, staged
from furlong.llm.components import components

BLOCK = 16
TILE = 8192
STRIP = 64  # rows of a tile compared at once
SLACK = 1e-9  # of a block's budget, so that rounding loses no pair in all blocks
ROUNDING = 1e-5  # of single precision
PAIRS = 50_000  # candidates verified at once


def usable(embedding: str) -> Column:
    e = F.col(embedding)
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(e.isNotNull() & fine & F.exists(e, lambda x: x != 0), F.lit(False))


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    """The rotation of vectors with ``dim`` components, the same everywhere."""
    return np.linalg.qr(np.random.default_rng(seed + dim).normal(size=(dim, dim)))[0]


def blocks(dim: int) -> list[slice]:
    return [slice(k, min(k + BLOCK, dim)) for k in range(0, dim, BLOCK)]


def unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _celled(vectors: DataFrame, budget: float, kind: type) -> DataFrame:
    """One row per vector and block: ``gid, weight, dim, block, cell, vec``
    (components as bytes of numbers of ``kind``, the precision they came in)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = {}
        for b in batches:
            lists = b.column(2)
            sizes = np.diff(np.asarray(lists.offsets))
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            gid, weight = b.column(0).to_numpy(), b.column(1).to_numpy()
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                raw = flat[(at[rows][:, None] + np.arange(dim))]
                if dim not in turns:
                    turns[dim] = rotation(int(dim))
                x = unit(raw) @ turns[dim]
                vec = pa.array([r.tobytes() for r in raw.astype(kind)], pa.binary())
                for k, s in enumerate(blocks(int(dim))):
                    wide = np.sqrt(budget * (s.stop - s.start) / dim)
                    cell = np.floor(x[:, s.start] / wide).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gid[rows]), pa.array(weight[rows]), pa.array(np.full(len(rows), dim, np.int32)),
                         pa.array(np.full(len(rows), k, np.int32)), pa.array(cell), vec],
                        names=["gid", "weight", "dim", "block", "cell", "vec"])

    return vectors.select("gid", "weight", "vector").mapInArrow(
        run, "gid bigint, weight bigint, dim int, block int, cell bigint, vec binary")


def forest(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links ``near`` (left x right), as pairs of ids."""
    out = []
    todo = near.any(1)
    free = near.any(0)
    while todo.any():
        a = int(np.argmax(todo))
        todo[a] = False
        front = near[a] & free
        free &= ~front
        root = left[a]
        out += [(root, x) for x in right[front]]
        while front.any():  # breadth first, each row and column once
            rows = todo & near[:, front].any(1)
            todo &= ~rows
            out += [(root, x) for x in left[rows]]
            front = near[rows].any(0) & free if rows.any() else np.zeros_like(free)
            free &= ~front
            out += [(root, x) for x in right[front]]
    return [(a, b) for a, b in out if a != b]


def _compared(pdf: pd.DataFrame, cosine: float, kind: type) -> pd.DataFrame:
    """Links between the two sides of one tile pair: rows ``a`` (vector) with
    ``n`` (links, counting weights) and rows ``a``, ``b`` of the forest."""
    dim, block = int(pdf["dim"].iloc[0]), int(pdf["block"].iloc[0])
    same = bool(pdf["same"].iloc[0])
    budget = 2 - 2 * cosine
    sides = []
    for side in (0,) if same else (0, 1):
        part = pdf[pdf["side"] == side]
        raw = np.frombuffer(b"".join(part["vec"]), kind).reshape(-1, dim)
        x = unit(raw)
        sides.append((part["gid"].to_numpy(), part["weight"].to_numpy(), x, x @ rotation(dim)))
    if same:
        sides *= 2
    (ga, wa, ua, xa), (gb, wb, ub, xb) = sides
    near = np.zeros((len(ga), len(gb)), bool)
    limits = [budget * (s.stop - s.start) / dim + SLACK for s in blocks(dim)]
    own = blocks(dim)[block]
    # |a - b|^2 <= limit, as one product of vectors with two more components, in
    # single precision with room for its rounding: candidates
    a, b = xa[:, own], xb[:, own]
    one_a, one_b = np.ones((len(a), 1)), np.ones((len(b), 1))
    left = np.hstack([a, -(a * a).sum(1, keepdims=True) / 2, one_a]).astype(np.float32)
    right = np.hstack([b, one_b, -(b * b).sum(1, keepdims=True) / 2]).astype(np.float32).T.copy()
    floor = np.float32(-limits[block] / 2 - ROUNDING)
    na, nb = np.zeros(len(ga), np.int64), np.zeros(len(gb), np.int64)
    product = np.empty((STRIP, len(gb)), np.float32)
    close = np.empty((STRIP, len(gb)), bool)
    for k in range(0, len(ga), STRIP):
        rows = min(STRIP, len(ga) - k)
        np.matmul(left[k:k + rows], right, out=product[:rows])
        np.greater_equal(product[:rows], floor, out=close[:rows])
        i, j = np.divmod(np.flatnonzero(close[:rows]), len(gb))
        i += k
        for c in range(0, len(i), PAIRS):
            p, q = i[c:c + PAIRS], j[c:c + PAIRS]
            # exactly: linked, within this block's budget, and in no earlier one's
            fine = np.einsum("ij,ij->i", ua[p], ub[q]) >= cosine
            if same:
                fine &= p != q
            p, q = p[fine], q[fine]
            for n, s in enumerate(blocks(dim)[:block + 1]):
                gap = xa[p, s] - xb[q, s]
                keep = (np.einsum("ij,ij->i", gap, gap) <= limits[n]) == (n == block)
                p, q = p[keep], q[keep]
            near[p, q] = True
            # every pair comes once, so links are counted as they are found
            na += np.bincount(p, wb[q], len(ga)).astype(np.int64)
            nb += np.bincount(q, wa[p], len(gb)).astype(np.int64)
    counts = [(ga, na)] if same else [(ga, na), (gb, nb)]
    gid = np.concatenate([g[n > 0] for g, n in counts])
    tree = np.array(forest(near, ga, gb), np.int64).reshape(-1, 2)
    return pd.DataFrame({
        "a": np.concatenate([gid, tree[:, 0]]),
        "b": pd.array(np.concatenate([np.zeros(len(gid), np.int64), tree[:, 1]]), "Int64"),
        "n": np.concatenate([*[n[n > 0] for _, n in counts], np.full(len(tree), -1)]).astype(np.int64)})


def near_duplicates(table: DataFrame, cosine: float = 0.9, vec_id: str = "vec_id",
                    embedding: str = "embedding") -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (other vectors with at least
    this cosine), ``component_id`` (smallest vec_id that links reach) and
    ``kept`` (vec_id = component_id).  Runs jobs."""
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vector"))
    good = rows.where(usable("vector") & F.col("vec_id").isNotNull())
    reps = staged(good.groupBy("vector").agg(F.min("vec_id").alias("gid"), F.count(F.lit(1)).alias("weight")), "vectors")
    kind = np.float32 if dict(rows.dtypes)["vector"] == "array<float>" else np.float64
    celled = staged(_celled(reps, 2 - 2 * cosine, kind), "cells")
    # at most 2 / cell width cells per block: unit vectors; so this table is small
    sizes = celled.groupBy("dim", "block", "cell").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    sizes = staged(sizes.coalesce(1), "cell-sizes")
    # tile pairs: a cell with itself (each two tiles once) and with the next cell
    other = sizes.select(F.col("dim").alias("_d"), F.col("block").alias("_b"), F.col("cell").alias("cell_b"),
                         F.col("tiles").alias("tiles_b"))
    pairs = (sizes.withColumn("cell_b", F.explode(F.array(F.col("cell"), F.col("cell") + 1)))
             .join(other.withColumnRenamed("cell_b", "_c"),
                   (F.col("dim") == F.col("_d")) & (F.col("block") == F.col("_b")) & (F.col("cell_b") == F.col("_c")))
             .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .withColumn("tile_b", F.explode(F.sequence(F.lit(0), F.col("tiles_b") - 1)))
             .where("cell_b > cell OR tile_b >= tile")
             .withColumn("same", (F.col("cell") == F.col("cell_b")) & (F.col("tile") == F.col("tile_b")))
             .select("dim", "block", "cell", "tile", "cell_b", "tile_b", "same"))
    name = F.xxhash64("dim", "block", "cell", "tile", "cell_b", "tile_b").alias("pair")
    sides = pairs.select("dim", "block", "cell", "tile", name, "same", F.lit(0).alias("side")).unionByName(
        pairs.where("NOT same").select("dim", "block", F.col("cell_b").alias("cell"), F.col("tile_b").alias("tile"),
                                       name, "same", F.lit(1).alias("side")))
    cut = celled.join(sizes, ["dim", "block", "cell"]).withColumn(
        "tile", F.pmod(F.xxhash64("gid"), F.col("tiles")).cast("int")).drop("tiles")
    dealt = cut.join(sides, ["dim", "block", "cell", "tile"])
    found = staged(dealt.groupBy("pair").applyInPandas(lambda pdf: _compared(pdf, cosine, kind), "a bigint, b bigint, n bigint"),
                   "vector-links")
    discard(celled, sizes)
    counts = found.where("n > 0").groupBy(F.col("a").alias("gid")).agg(F.sum("n").alias("_n"))
    comps = components(found.where("n < 0").select("a", "b"))
    classes = (reps.join(counts, "gid", "left")
               .join(comps.withColumnRenamed("node", "gid"), "gid", "left")
               .select("vector", (F.coalesce("_n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                       F.coalesce("component", "gid").alias("component_id")))
    linked = good.join(classes, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable("vector") | F.col("vec_id").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

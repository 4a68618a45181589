"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key ``-ln(u) / w`` (``u`` from a hash of
its id, ``w`` its quality weight), so a source's documents sorted by key are
a weighted random order without replacement.  A source with size ``S`` and
target ``T`` is read in ``floor(T / S)`` complete epochs; the rest of the
target is filled in key order by prefix sums of the sizes.

Scale: the prefix sum of a source is cut into buckets of the key's
logarithm (more buckets for larger sources), so that a source with a third
of all rows is many window groups; bucket totals are summed first and give
each bucket its offset.  Only per-source and per-bucket totals meet in one
task.

Defined results: null text has size 0; a null source is a source of its
own, last in order; size-0 documents take nothing; an empty table gives an
empty result; repeated rows are separate documents (equal rows are
interchangeable); rows without a doc_id draw their keys by their texts.
Columns named like a result column are replaced.

The texts are never shuffled: a source's selection is every document up to
one cut in key order, so :func:`mixed_documents` finds the cuts on narrow rows
and then filters the texts as they are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furlong.llm.common import SPACE, discard, staged, text_or_empty, unused_prefix, words

RESULT = ("size", "source_size", "target", "epochs", "taken")
ROWS_PER_BUCKET = 2_000
BROADCAST_SOURCES = 100_000  # rows of the plan (one a source) up to which it is broadcast


def quality_weight(text: str = "text") -> Column:
    """Default quality weight in [1/16, 1]: falls by one half for each 5 % of
    symbol characters in the text."""
    t = text_or_empty(text)
    n = F.length(t)
    symbols = n - F.length(F.translate(t, "#*$%&|<>", ""))
    steps = F.least(F.lit(4), F.floor(symbols * 20 / F.greatest(n, F.lit(1))).cast("int"))
    return F.lit(1.0) / F.pow(F.lit(2.0), steps)


def uniform(seed: int, doc_id: str = "doc_id", text: str = "text") -> Column:
    """A number in (0, 1] from the id alone (without one: from the text), the
    same in every run."""
    own = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("null:"), F.md5(text_or_empty(text))))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), own))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 1.0) / float(2 ** 48)


def source_targets(sizes: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """``sizes`` (one row per ``source`` with ``source_size``, ``n``) with
    ``target``.  Sources in code-point order (null last) weigh ``weights``,
    repeating.  A target is ``min(cap * size, level * weight)`` with one level
    for all sources such that the targets add up to all sizes: the fixed point
    of resharing what capped sources cannot take.  One row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumn("_w", w).withColumn("_cap", F.col("source_size") * cap)
    # in order of cap per weight, the first sources are the capped ones
    fill = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    t = t.withColumns({
        "_left": F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0)),
        "_rest": F.sum("_w").over(rest)})
    # capped while the level of the remaining sources would lift it over its cap
    t = t.withColumn("_capped", F.col("_left") * F.col("_w") > F.col("_cap") * F.col("_rest"))
    first = F.min(F.when(~F.col("_capped"), F.struct(F.col("_cap") / F.col("_w"), F.col("source").isNull(),
                                                     "source", "_left", "_rest"))).over(whole)
    level = t.withColumn("_first", first)
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(
        (F.col("_w") * F.col("_first._left")).cast("double") / F.col("_first._rest"))
    return level.withColumn("target", target).select("source", "source_size", "n", "target")


def _key(seed: int, quality: Column | None) -> Column:
    return -F.log(uniform(seed)) / (quality if quality is not None else quality_weight())


def _tie() -> Column:
    return F.xxhash64(text_or_empty("text"))


def _narrow(docs: DataFrame, seed: int, quality: Column | None) -> DataFrame:
    """``doc_id``, ``source``, ``size`` and the key of every row, staged."""
    return staged(docs.select("doc_id", "source", F.size(words("text")).cast("long").alias("size"),
                              _tie().alias("_mx_tie"), _key(seed, quality).alias("_mx_key")), "mix")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: int = 7,
        quality: Column | None = None) -> DataFrame:
    """``doc_id``, ``source``, and: ``size`` (words), ``source_size``, ``target``
    (of the source), ``epochs`` (whole passes plus one if the document is in
    the fractional selection), ``taken`` (words the mix takes, ``epochs *
    size``; at most ``cap * size``).

    The document at which the prefix sum passes the rest of the target is
    selected if at least half of it fits, so a source misses its target by at
    most half a document.  Writes one staged table without the texts (an
    action)."""
    return _selected(_narrow(docs, seed, quality), weights, cap).select(
        "doc_id", "source", *RESULT[:-1], (F.col("epochs") * F.col("size")).alias("taken"))


def _selected(base: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """The rows of ``base`` with ``source_size``, ``target``, ``epochs`` and the
    whole passes of their source."""
    plan = source_targets(base.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                     F.count(F.lit(1)).alias("n")), weights, cap)
    plan = plan.select(
        F.col("source").alias("_mx_source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).cast("long").alias("_mx_whole"),
        F.ceil(F.col("n") / ROWS_PER_BUCKET).cast("int").alias("_mx_cut"))
    rows = base.join(plan, base["source"].eqNullSafe(plan["_mx_source"]), "left").drop("_mx_source")
    # u = 1 gives key 0, which has no logarithm: it sorts before all others
    bucket = F.when(F.col("_mx_key") > 0,
                    F.floor(F.log2("_mx_key") * 8 * F.col("_mx_cut")).cast("long")).otherwise(-(1 << 60))
    rows = rows.withColumn("_mx_bucket", bucket)
    totals = rows.groupBy(F.col("source").alias("_mx_source"), F.col("_mx_bucket").alias("_mx_at")).agg(
        F.sum("size").alias("_mx_sum"))
    ahead = Window.partitionBy("_mx_source").orderBy("_mx_at").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_mx_ahead", F.coalesce(F.sum("_mx_sum").over(ahead), F.lit(0))).drop("_mx_sum")
    rows = rows.join(totals, rows["source"].eqNullSafe(totals["_mx_source"])
                     & (rows["_mx_bucket"] == totals["_mx_at"]), "left")
    inside = (Window.partitionBy("source", "_mx_bucket")
              .orderBy("_mx_key", "doc_id", "_mx_tie").rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("_mx_ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    rest = F.col("target") - F.col("_mx_whole") * F.col("source_size")
    rows = rows.withColumn("_mx_start", start).withColumn(
        "epochs", F.col("_mx_whole") + ((F.col("size") > 0) & (
            F.col("_mx_start") + F.col("size") / F.lit(2.0) <= rest)).cast("long"))
    return rows.select(*base.columns, "source_size", "target", "epochs", "_mx_whole")


def cuts(selected: DataFrame) -> DataFrame:
    """One row per source: ``source``, ``whole`` (complete passes), ``cut`` (the
    last place in key order that the fractional selection takes; null: none),
    and how many rows stand there (``at_cut``) and are taken (``taken``)."""
    place = F.struct(F.col("_mx_key").alias("key"), F.col("doc_id").alias("id"), F.col("_mx_tie").alias("tie"))
    places = selected.where("size > 0").groupBy("source", place.alias("place")).agg(
        F.first("_mx_whole").alias("whole"), F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("epochs") > F.col("_mx_whole"), 1)).alias("taken"))
    last = F.max(F.when(F.col("taken") > 0, F.struct("place", "n", "taken")))
    return places.groupBy("source").agg(F.max("whole").alias("whole"), last.alias("last")).select(
        "source", "whole", F.col("last.place").alias("cut"), F.col("last.n").alias("at_cut"),
        F.col("last.taken").alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: int = 7,
                    quality: Column | None = None) -> DataFrame:
    """The mix itself: the rows of ``docs`` (all columns unchanged), each as
    often as the mix takes it; rows without words as often as their source has
    complete passes.  Runs jobs over narrow rows; the texts are read once more
    and filtered against their source's cut, without a shuffle.  (Only where a
    cut falls between equal rows are these, and no others, numbered.)"""
    base = _narrow(docs, seed, quality)
    picks = staged(_selected(base, weights, cap), "picks")
    plan = staged(cuts(picks).coalesce(1), "mix-plan")
    discard(base, picks)
    n, split = plan.agg(F.count(F.lit(1)), F.count(F.when(F.col("taken") < F.col("at_cut"), 1))).first()
    own = unused_prefix(docs, "_mx_")
    names = {c: f"{own}{c}" for c in plan.columns}
    side = plan.select(*[F.col(c).alias(x) for c, x in names.items()])
    met = docs.join(F.broadcast(side) if n <= BROADCAST_SOURCES else side,
                    docs["source"].eqNullSafe(side[names["source"]]))
    place = F.struct(_key(seed, quality).alias("key"), F.col("doc_id").alias("id"), _tie().alias("tie"))
    cut, at, taken = F.col(names["cut"]), F.col(names["at_cut"]), F.col(names["taken"])
    has_words = F.btrim(text_or_empty("text"), F.lit(SPACE)) != ""
    inside = F.coalesce(has_words & ((place < cut) | ((place == cut) & (taken == at))), F.lit(False))
    copies = F.col(names["whole"]) + inside.cast("long")

    def repeated(rows: DataFrame, times: Column) -> DataFrame:
        times = F.when(times > 0, F.sequence(F.lit(1), times.cast("int"))).otherwise(F.array().cast("array<int>"))
        return rows.withColumn(f"{own}copy", F.explode(times)).select(*docs.columns)

    out = repeated(met, copies)
    if split:
        equal = Window.partitionBy(names["source"]).orderBy(F.xxhash64(*[c for c, t in docs.dtypes if "map<" not in t]))
        some = met.where(has_words & (place == cut) & (taken < at)).withColumn(f"{own}no", F.row_number().over(equal))
        out = out.unionByName(repeated(some.where(F.col(f"{own}no") <= taken), F.lit(1)))
    return out

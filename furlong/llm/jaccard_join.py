"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its distinct shingles (runs of words, 64-bit hashes,
A-Z folded).  Tokens have one global order: rare ones first, then frequent
ones, by hash within a class; tokens whose frequency was not counted come
last.  A document's prefix is extended along that order until

    (single tokens) + sum over groups of (frequent tokens in group - 1)

exceeds the number of tokens that a similar document may lack.  Then two
similar documents share a single rare token of their prefixes, or a pair of
frequent tokens of one group: these are the index keys.  (Groups bound the
pairs per document; they depend on the size band, so a document is indexed
in its own band and the next.)

Sets that share single tokens are paired where the number of shared ones
can make up the overlap; the sets of a combination hang together.  Clusters
of such candidates are verified exactly, in tiles against a size window; tasks return a spanning forest of
the links, from which the components come.

Scale: one pass over the texts makes the fingerprint of each set and its
lowest-hashed tokens; frequencies, keys and candidates come from these.
Only candidates' texts are read again.  Equal sets are one node.  A token is
frequent from ``FREQUENT`` sets on, whatever the size of the corpus, so the
lists of single tokens stay that short.  Which tokens are frequent is
broadcast as a bitmap of ``BITS`` bits, of one size for any corpus: a bit
stands for all tokens that hash to it, and all of them are called frequent if
one is.  That loses nothing, since all sets call a token alike; it only
costs longer prefixes once a corpus has many more frequent tokens than
``BITS``.  A cluster of any size is cut into tiles of about
``TILE_MAX`` sets and ``TILE_TOKENS`` tokens at most; a set stays whole.

Defined results: null and empty texts have no shingles and link with
nothing; texts of fewer words than a shingle have one, the whole sequence;
repeated rows link like any equal sets; rows without a doc_id link with
nothing and have no component; an empty table gives an empty result; other
columns are ignored.  A set's fingerprint and its tokens are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import discard, staged
from furlong.llm.components import components
from furlong.llm.flat_text import chunks, mix64, word_hashes

FREQUENT = 32  # sets from which a token is frequent
BITS = 1 << 26  # of the bitmap of frequent tokens: 8 MB
GROUP = 4  # frequent tokens of a prefix that fall into one group, about
TILE_MIN, TILE_MAX, TILES = 128, 2048, 20
TILE_TOKENS = 4 << 20  # tokens of a tile, about (a set is whole)
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Rule:
    """Words in a shingle, and the similarity in percent from which sets link."""

    width: int = 3
    percent: int = 90

    @property
    def known(self) -> int:
        """Tokens below this hash have their frequency counted: somewhat more
        than a prefix needs."""
        return 2 ** 63 * min((100 - self.percent) * 15, 240) // 800

    def may_lack(self, n: int) -> int:
        """Tokens of a set of ``n`` that a similar set may lack."""
        return n - -(-n * self.percent // 100)


def shingle_sets(texts: pa.StringArray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles as 63-bit numbers) of every text."""
    for c in chunks(texts, lower=True, whole=True):
        h = word_hashes(c)
        s = np.zeros(len(h), np.uint64)
        three = np.uint64(3)
        for k in range(width):
            s[:len(h) - k] = mix64(s[:len(h) - k] * three + h[k:])
        for part, row in enumerate(c.row):
            n, at = int(c.n_words[part]), int(c.first_word[part])
            if n >= width:
                yield int(row), np.unique(s[at:at + n - width + 1] >> np.uint64(1)).astype(np.int64)
            elif n:  # the whole sequence, told apart from full shingles by its own start
                x = np.full(1, n, np.uint64)
                for k in range(n):
                    x = mix64(x * three + h[at + k:at + k + 1] + np.uint64(1))
                yield int(row), (x >> np.uint64(1)).astype(np.int64)
            else:
                yield int(row), np.zeros(0, np.int64)


def _fingerprint(tokens: np.ndarray) -> int:
    x = np.add.reduce(mix64(tokens.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))) + np.uint64(len(tokens))
    return int((mix64(np.array([x]))[0] >> np.uint64(1)).astype(np.int64))


SKETCH = "doc_id bigint, n bigint, node bigint, low array<bigint>"


def sketches(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id``, ``n`` (shingles), ``node`` (fingerprint of the set; null
    without shingles) and ``low``: all tokens below ``rule.known`` and as many more
    as a prefix can need, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            rows, n, node, low = [], [], [], []
            for row, tokens in shingle_sets(b.column(1), rule.width):
                rows.append(row)
                n.append(len(tokens))
                node.append(_fingerprint(tokens) if len(tokens) else None)
                low.append(tokens[:int(np.searchsorted(tokens, rule.known)) + rule.may_lack(len(tokens)) + 1])
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                 pa.array(low, pa.list_(pa.int64()))], names=["doc_id", "n", "node", "low"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, SKETCH)


def prefix_keys(low: np.ndarray, n: int, frequent: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray, int]:
    """Single-token keys and combination keys of one set, and the number of its
    tokens behind its prefix (-1 if the single rare tokens did not suffice).
    ``frequent``: frequent tokens, in order; those of this set suffice."""
    need = rule.may_lack(n) + 1
    known = low[:int(np.searchsorted(low, rule.known))]
    if len(frequent) and len(known):
        at = np.minimum(np.searchsorted(frequent, known), len(frequent) - 1)
        often = frequent[at] == known
    else:
        often = np.zeros(len(known), bool)
    rare, common, rest = known[~often], known[often], low[len(known):]
    missing = need - len(rare)
    if missing <= 0:
        return rare[:need], rare[:0], n - need
    band = int(np.floor(np.log(n) / -np.log(rule.percent / 100)))
    keys, singles = [], 0
    for b in (band, band + 1):
        # groups of the band: about GROUP of its sets' known tokens each
        groups = max(1, int((100 / rule.percent) ** b * rule.known / 2 ** 63 / GROUP))
        kind = (common >> 7) % groups
        order = np.argsort(kind, kind="stable")
        place = np.empty(len(common), np.int64)
        place[order] = np.arange(len(common)) - np.searchsorted(kind[order], kind[order])
        gain = np.cumsum(place > 0)  # all but the first of a group count
        stop = int(np.searchsorted(gain, missing)) + 1
        tokens, kind = common[:stop].astype(np.uint64), kind[:stop]
        for g in np.unique(kind):
            t = tokens[kind == g]
            i, j = np.triu_indices(len(t), 1)
            keys.append(mix64(mix64(t[i]) + t[j] * np.uint64(3) + np.uint64(b)))
        singles = max(singles, missing - (int(gain[-1]) if len(gain) else 0))
    keys.append(rest[:max(0, singles)].astype(np.uint64))
    return rare, np.unique(np.concatenate(keys)).view(np.int64), -1


def frequent_bitmap(tokens: DataFrame, bits: int) -> np.ndarray:
    """The bitmap (64-bit words) of the column ``t``: at most ``bits / 64`` rows
    reach the driver."""
    place = F.shiftright("t", 20).bitwiseAND(F.lit(bits - 1))
    table = tokens.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("mask")).toArrow()
    out = np.zeros(max(1, bits // 64), np.int64)
    out[table["word"].to_numpy()] = table["mask"].to_numpy()
    return out.view(np.uint64)


def called_frequent(bitmap: np.ndarray, tokens: np.ndarray, bits: int) -> np.ndarray:
    place = (tokens >> 20) & (bits - 1)
    return (bitmap[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0


def _keys(sketch: DataFrame, bitmap: np.ndarray, rule: Rule) -> DataFrame:
    """``key, node, n, behind, single``, one row per index key of each set."""
    sent, bits = sketch.sparkSession.sparkContext.broadcast(bitmap), BITS

    def keys_of(low: np.ndarray, n: int, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        known = low[:int(np.searchsorted(low, rule.known))]
        return prefix_keys(low, n, known[called_frequent(often, known, bits)], rule)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = sent.value
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                n, node = b.column(0).to_numpy(), b.column(1).to_numpy()
                found = [keys_of(x.values.to_numpy(zero_copy_only=False), int(m), often)
                         for x, m in zip(b.column(2), n, strict=True)]
                size = [len(x) + len(y) for x, y, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([z for x, y, _ in found for z in (x, y)])),
                     pa.array(np.repeat(node, size)), pa.array(np.repeat(n, size).astype(np.int32)),
                     pa.array(np.repeat([x[2] for x in found], size).astype(np.int32)),
                     pa.array(np.concatenate([np.arange(len(x) + len(y)) < len(x) for x, y, _ in found]))],
                    names=["key", "node", "n", "behind", "single"])

    return sketch.where("n > 1").select("n", "node", "low").mapInArrow(
        run, "key bigint, node bigint, n int, behind int, single boolean")


def _listed(keys: DataFrame) -> DataFrame:
    """The keys that two sets have, with the smallest set of each."""
    shared = keys.groupBy(F.col("key").alias("_k"), F.col("single").alias("_s")).agg(
        F.min("node").alias("_low"), F.max("node").alias("_high")).where("_low < _high")
    return keys.join(shared, (keys["key"] == shared["_k"]) & (keys["single"] == shared["_s"])).select(
        "key", "node", "n", "behind", "single", "_low").distinct()


def _candidates(listed: DataFrame, percent: int) -> DataFrame:
    """Links between sets that may be similar (``a, b``).

    Sets that share single rare tokens (lists of less than ``FREQUENT`` rows, or
    few more where rows have equal sets) are paired if their sizes fit and the shared tokens plus
    the tokens behind the prefix can make up the wanted overlap: of the two,
    the set whose prefix ends first has every shared token in both prefixes or
    behind its own.  The sets of a combination key hang on the smallest one."""
    left = listed.where("single").select("key", "node", "n", "behind")
    right = left.select(*[F.col(c).alias(f"{c}2") for c in left.columns])
    pairs = left.join(right, (F.col("key") == F.col("key2")) & (F.col("node") < F.col("node2"))
                      & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")))
    pairs = pairs.groupBy(F.col("node").alias("a"), F.col("node2").alias("b"), "n", "n2", "behind", "behind2").agg(
        F.count(F.lit(1)).alias("shared"))
    able = (F.col("shared") + F.greatest("behind", "behind2")) * (100 + percent) >= percent * (F.col("n") + F.col("n2"))
    pairs = pairs.where(able | ((F.col("behind") < 0) & (F.col("behind2") < 0))).select("a", "b")
    star = listed.where("NOT single AND node != _low").select(F.col("node").alias("a"), F.col("_low").alias("b"))
    return pairs.unionByName(star)


def _verified(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A spanning forest of the links between the sets of one tile pair."""
    pdf = pdf.sort_values(["n", "node"])
    node, n, side = pdf["node"].to_numpy(), pdf["n"].to_numpy(), pdf["side"].to_numpy()
    both = bool(pdf["same"].iloc[0])
    flat = np.unique(np.frombuffer(b"".join(pdf["tokens"]), np.int64), return_inverse=True)[1]
    at = np.concatenate(([0], np.cumsum(n)))
    mark = np.zeros(int(flat.max()) + 1, np.int32)
    label = np.arange(len(node))
    out = []
    for i in range(len(node) - 1):
        # sizes in order: a similar set has at most n / similarity tokens
        to = int(np.searchsorted(n, n[i] * 100 // percent, "right"))
        if to <= i + 1 or (label[i + 1:to] == label[i]).all():
            continue
        mine = flat[at[i]:at[i + 1]]
        mark[mine] = 1
        shared = np.add.reduceat(mark[flat[at[i + 1]:at[to]]], at[i + 1:to] - at[i + 1])
        mark[mine] = 0
        near = 100 * shared >= percent * (n[i] + n[i + 1:to] - shared)
        near &= label[i + 1:to] != label[i]
        if not both:
            near &= side[i + 1:to] != side[i]
        for j in np.flatnonzero(near) + i + 1:
            if label[j] != label[i]:
                out.append((node[i], node[j]))
                label[label == label[j]] = label[i]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _sets(docs: DataFrame, ids: DataFrame, rule: Rule) -> DataFrame:
    """``node, n, tokens, cluster`` of the documents of ``ids`` (doc_id, node, cluster)."""
    small = ids.count() <= BROADCAST_IDS
    side = ids.withColumnRenamed("doc_id", "_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(side) if small else side, F.col("doc_id") == F.col("_id")).select("node", "cluster", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, cluster = b.column(0).to_numpy(), b.column(1).to_numpy()
            found = [(r, t) for r, t in shingle_sets(b.column(2), rule.width) if len(t) and _fingerprint(t) == node[r]]
            at = np.array([r for r, _ in found], np.int64)
            for k in range(0, len(found), 500):
                part = found[k:k + 500]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[at[k:k + 500]]), pa.array(cluster[at[k:k + 500]]),
                     pa.array([len(t) for _, t in part], pa.int64()),
                     pa.array([t.tobytes() for _, t in part], pa.binary())],
                    names=["node", "cluster", "n", "tokens"])

    # an id that several rows share: the row whose set has the node's fingerprint, once
    out = rows.mapInArrow(run, "node bigint, cluster bigint, n bigint, tokens binary")
    return out.dropDuplicates(["node"])


def _dealt(sets: DataFrame) -> DataFrame:
    """Every set once for each pair of tiles (``pair``) that it is in."""
    size = sets.groupBy(F.col("cluster").alias("_c")).agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("_tokens")).withColumn(
        "tiles", F.greatest(F.least(F.ceil(F.col("m") / TILE_MIN), F.lit(TILES)), F.ceil(F.col("m") / TILE_MAX),
                            F.ceil(F.col("_tokens") / TILE_TOKENS)).cast("int"))
    cut = sets.join(size, sets["cluster"] == size["_c"]).withColumn(
        "tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    # a set goes to the pairs of its tile with every tile
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    lo, hi = F.least("tile", "other"), F.greatest("tile", "other")
    # one key, and not (cluster, lo, hi): rows that a join has put together by
    # cluster would count as dealt by those three, and a cluster stay in one task
    return cut.select("node", "n", "tokens", F.concat_ws("/", "cluster", lo, hi).alias("pair"),
                      (F.col("tile") > F.col("other")).alias("side"), (F.col("tile") == F.col("other")).alias("same"))


def links(docs: DataFrame, sketch: DataFrame, rule: Rule) -> DataFrame:
    """``node, component``: sets that are linked with another set."""
    tokens = sketch.select(F.explode(F.filter("low", lambda x: x < rule.known)).alias("t")).groupBy("t").agg(
        F.count(F.lit(1)).alias("df")).where(F.col("df") >= FREQUENT)
    tokens = staged(tokens.select("t"), "tokens")
    keys = staged(_keys(sketch, frequent_bitmap(tokens, BITS), rule), "keys")
    listed = staged(_listed(keys), "lists")
    hung = components(_candidates(listed, rule.percent))
    clusters = staged(hung.withColumnRenamed("component", "cluster"), "clusters")
    discard(tokens, keys, listed, hung)
    ids = (sketch.where("doc_id IS NOT NULL").select("doc_id", "node").join(clusters, "node")
           .groupBy("node", "cluster").agg(F.min("doc_id").alias("doc_id")))
    ids = staged(ids, "candidates")
    sets = staged(_sets(docs, ids, rule), "sets")
    found = staged(_dealt(sets).groupBy("pair").applyInPandas(
        lambda pdf: _verified(pdf, rule.percent), "a bigint, b bigint"), "set-links")
    discard(clusters, ids, sets)
    out = components(found)
    discard(found)
    return out


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` and ``component_id``
    (smallest doc_id that links reach, itself included).  Two documents link
    when ``100 * intersection >= rule.percent * union``.  Runs jobs."""
    sketch = staged(sketches(docs, rule), "sketches")
    of = links(docs, sketch, rule)
    rows = sketch.select("doc_id", F.col("n").alias("n_shingles"), "node")
    rows = rows.join(of, "node", "left").withColumn("root", F.coalesce("component", "node"))
    first = (rows.where("root IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("root").alias("_r"))
             .agg(F.min("doc_id").alias("_first")))
    return rows.join(first, rows["root"] == first["_r"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("_first", "doc_id")).alias("component_id"))

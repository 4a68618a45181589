"""Source divergence audit: how the sources of a language differ in their words.

A translate table lowers A-Z and blanks every separator byte in one pass,
``bytes.split`` gives the terms of a document and a ``Counter`` its
frequencies.  Tasks add up the Counters by language and source before
anything is shuffled; what leaves them is one row per group and term, with
the term's occurrences and documents.

With ``p = 1 + SCALE * (count + 2) div (N + 2 V)`` over the ``V`` terms a
language keeps (those of ``min_docs`` of its documents), two distributions
differ at a term by ``f = (p - q)^2 div (p + q)``.

* Part ``pair``: the sum of ``f`` over all kept terms, for every two sources of
  a language.  It is summed sparsely: with ``p0`` of the count 0, all terms
  that neither source has give ``f(p0, q0)`` each; a term's deviation from that
  is a part of one source, summed by its *counts* (``f(p, q0) - f(p0, q0)``
  depends on nothing else), and for terms that both sources have the rest,
  ``f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)``.
* Part ``term``: the ``top`` terms that a group has more of than its language.

Scale: rows are dealt by (language, term), so a language or source with a
third of all rows is spread over all tasks; the table of groups is broadcast
only where it has been counted; the top terms are found per task before they
meet.  The pairs of sources are the result itself: their number does not
depend on the rows.  All arithmetic is on integers.

Defined results: null text, lang and source are ''; a group whose documents
have no terms is there, with counts of 0; repeated rows are documents of
their own; a language without kept terms has pairs with value 0; a source
that is alone in its language has no pairs; an empty table gives an empty
result; other columns are ignored.  Texts are read in parts of about ``PART``
bytes, cut at separators.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furlong.llm.common import discard, staged

SCALE = 1_000_000_000
MIN_DOCS, TOP = 10, 10
PART = 1 << 20  # bytes of a text that are split at once
HELD = 400_000  # terms that a task adds up before it sends them
BROADCAST_GROUPS = 100_000  # groups up to which their table is broadcast

# Letters stay, A-Z are lowered, every other ASCII byte separates; bytes of
# characters beyond ASCII stay.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SEPARATOR = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")


def frequencies(text: bytes, part: int = PART) -> Counter:
    """The terms of one document with their occurrences."""
    if len(text) <= part:
        return Counter(text.translate(TABLE).split())
    out: Counter = Counter()
    at = 0
    while at < len(text):
        cut = _SEPARATOR.search(text, at + part) if at + part < len(text) else None
        to = cut.start() if cut else len(text)
        out.update(text[at:to].translate(TABLE).split())
        at = to
    return out


COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of every term
    of a group, not yet added up over tasks; a null term stands for the group."""
    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs_of) in held.items():
            terms = [None, *n]
            for k in range(0, len(terms), 50_000):
                part = terms[k:k + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                     pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] for t in part], pa.int64()),
                     pa.array([docs_of[t] for t in part], pa.int64())], names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                n, docs_of = held.setdefault((lang, source), (Counter(), Counter()))
                found = frequencies(text.as_py())
                size -= len(n)
                n.update(found)
                docs_of.update(found.keys())
                size += len(n)
                if size > HELD:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    empty = F.lit("")
    return docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"),
                       F.coalesce("text", empty).cast("binary").alias("text")).mapInArrow(run, COUNTS)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + SCALE * (n + 2) div (total + 2 * terms)``, exact; null without terms."""
    wide = "decimal(38,0)"
    return F.lit(1).cast("long") + _div((n.cast("decimal(20,0)") + F.lit(2)) * F.lit(SCALE),
                                        F.nullif(total.cast(wide) + F.lit(2) * terms.cast("decimal(20,0)"), F.lit(0).cast(wide))).cast("long")


def difference(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _kept(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """Staged: ``lang, source, term, n, all_n`` (of the language) of kept terms,
    and the groups with their sums."""
    counts = staged(term_counts(docs).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    whole = Window.partitionBy("lang", "term")
    kept = counts.where("term IS NOT NULL").select(
        "lang", "source", "term", "n", F.sum("docs").over(whole).alias("in_docs"), F.sum("n").over(whole).alias("all_n"),
        (F.row_number().over(whole.orderBy("source")) == 1).alias("first"))
    kept = staged(kept.where(F.col("in_docs") >= min_docs).drop("in_docs"), "terms")
    of_lang = kept.groupBy(F.col("lang").alias("_l")).agg(
        F.sum("n").alias("lang_n"), F.count(F.when(F.col("first"), 1)).alias("terms"))
    of_group = kept.groupBy(F.col("lang").alias("_gl"), F.col("source").alias("_gs")).agg(F.sum("n").alias("group_n"))
    groups = counts.where("term IS NULL").select("lang", "source")
    groups = groups.join(of_group, (F.col("lang") == F.col("_gl")) & (F.col("source") == F.col("_gs")), "left").join(
        of_lang, F.col("lang") == F.col("_l"), "left")
    none = F.lit(0).cast("long")
    sums = {c: F.coalesce(c, none) for c in ("group_n", "lang_n", "terms")}
    groups = groups.select("lang", "source", *[v.alias(c) for c, v in sums.items()],
                           share(none, sums["group_n"], sums["terms"]).alias("p0"))
    groups = staged(groups.coalesce(1), "groups")
    discard(counts)
    return kept, groups


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: for every occurring group, part
    ``pair`` (the other sources of its language) and part ``term`` (its ``top``
    terms over the language's share), ranked by value, then item.  Runs jobs."""
    kept, groups = _kept(docs, min_docs)
    small = F.broadcast if groups.count() <= BROADCAST_GROUPS else (lambda side: side)
    side = groups.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "group_n", "lang_n", "terms", "p0")
    rows = kept.join(small(side), (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s"))).select(
        "lang", "source", "term", "n", "p0", share(F.col("n"), F.col("group_n"), F.col("terms")).alias("p"),
        share(F.col("all_n"), F.col("lang_n"), F.col("terms")).alias("lang_p"))

    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = rows.where("p > lang_p").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                       difference(F.col("p"), F.col("lang_p")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    pairs = _pairs(rows, groups, small).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    return pairs.unionByName(terms)


def _pairs(rows: DataFrame, groups: DataFrame, small) -> DataFrame:
    """``lang, source, other, value`` for every two sources of a language."""
    f = difference
    one = groups.select("lang", "source", "terms", "p0")
    two = groups.select(F.col("lang").alias("_lang"), F.col("source").alias("other"), F.col("p0").alias("q0"))
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    # as if no source had any term
    floor = one.join(small(two), (F.col("lang") == F.col("_lang")) & (F.col("source") != F.col("other"))).select(
        "lang", "source", "other", F.coalesce(F.col("terms") * f(p0, q0), F.lit(0).cast("long")).alias("value"))
    # terms of one source, whatever the other has: by their counts
    by_count = rows.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("m"))
    own = by_count.join(small(two), (F.col("lang") == F.col("_lang")) & (F.col("source") != F.col("other"))).groupBy(
        "lang", "source", "other").agg(F.sum(F.col("m") * (f(p, q0) - f(p0, q0))).alias("value"))
    # terms of both
    right = rows.select(F.col("lang").alias("_lang"), F.col("term").alias("_term"), F.col("source").alias("other"),
                        F.col("p").alias("q"), F.col("p0").alias("q0"))
    both = rows.join(right, (F.col("lang") == F.col("_lang")) & (F.col("term") == F.col("_term"))
                     & (F.col("source") < F.col("other"))).groupBy("lang", "source", "other").agg(
        F.sum(f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)).alias("value"))

    def turned(d: DataFrame) -> DataFrame:
        return d.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value")

    parts = [floor, own, turned(own), both, turned(both)]
    total = parts[0]
    for x in parts[1:]:
        total = total.unionByName(x)
    return total.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))

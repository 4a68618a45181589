"""The corpus pipeline: stages over ``documents``, each a thin call of one
operator of ``furlong.llm``.  Every stage works on all that its predecessor
kept; all but the last return the columns of ``documents``.

A stage's result is written before the next stage is called.  So a stage
begins by deleting the tables that the stage before had staged for itself."""

from __future__ import annotations

import functools
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.llm import bpe, jaccard_join, mixing, quality_classifier, substring_dedup
from furlong.llm.common import collecting, discard, read, remove, staged
from furlong.llm.labels import fold

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left_over: ContextVar[tuple[str, ...]] = ContextVar("left_over", default=())


def _after_the_last(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, *_left_over.get())
        with collecting() as made:
            out = stage(spark, docs, sf_dir)
        _left_over.set(tuple(made))
        return out

    return run_stage


@_after_the_last
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    model = quality_classifier.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"),
                                     fold("doc_id", 3) != 1)
    return quality_classifier.score(docs, model, keep=COLUMNS).where(
        "predicted = 1").select(*COLUMNS)


@_after_the_last
def keep_one_of_a_kind(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near
    duplicates (five-word shingles, similarity 0.8 or more); of rows that share
    that id all stay."""
    groups = jaccard_join.near_duplicates(docs, jaccard_join.Rule(width=5, percent=80))
    gone = groups.where("doc_id != component_id").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti").select(*COLUMNS)


@_after_the_last
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the words of 13-word windows that an earlier document has; texts
    that lose nothing stay as they are, and texts that lose all words go."""
    out = substring_dedup.deduplicated(docs.select(*COLUMNS)).where("n_removed = 0 OR n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return out.withColumn("text", text).withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


@_after_the_last
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that the sources meet their targets."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


@_after_the_last
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                          with_ids=True)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_a_kind),
    ("substring dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

# The first stage trains a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written before the next reads it."""
    docs, last = read(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline")
        discard(*last)
        last = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)

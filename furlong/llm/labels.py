"""Bounded training samples of labelled documents, and folds."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def training_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` (0 or 1) of the rows with the
    ``per_class`` labelled ids of each class whose hashes are smallest (see
    :func:`bounded` for ids that several rows have).  ``train`` says which rows
    of ``labels`` may be learnt from; a label that is given twice counts once.
    The sampled ids are at most ``2 * per_class`` rows, so they are broadcast."""
    known = labels.where(train & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("label")).distinct()
    ids = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    picked = ids[0].unionByName(ids[1]).withColumnRenamed("doc_id", "_id")
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(picked), F.col("doc_id") == F.col("_id"), "inner").select("doc_id", "text", "label"))


def bounded(rows: DataFrame, per_class: int) -> list[Row]:
    """At most ``per_class`` rows of each class of a training sample, by the hash
    of ``doc_id`` and then of the other columns: also where one id has any
    number of rows.  The only thing that the driver holds of the sample."""
    order = [F.xxhash64("doc_id"), F.xxhash64(*rows.columns)]
    return [r for c in (0, 1) for r in rows.where(F.col("label") == c).orderBy(*order).limit(per_class).collect()]


def warn_unused(labels: DataFrame, label: str, train: Column, used: Iterable[int]) -> None:
    """Warns of a class that has labels but no training rows."""
    for c in {0, 1} - set(used):
        if labels.where(train & (F.col(label) == c)).limit(1).count():
            warnings.warn(f"no training document has {label} = {c}, though there are such labels", stacklevel=3)

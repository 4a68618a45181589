"""Shared column rules and the shared-folder staging used by the operators."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.plans.session import shared_checkpoint_dir

# The six ASCII white-space characters that end a word.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \\x09-\\x0D]+"

#: Spark setting: delete a query's shuffle files when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: str | Column = "text") -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none)."""
    trimmed = F.btrim(text_or_empty(text), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN))


def lower_ascii(text: str | Column = "text") -> Column:
    """The text with only A-Z lower-cased."""
    return F.translate(text_or_empty(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    base = shared_checkpoint_dir(spark)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and "
                         "all executors share")
    return f"{base.rstrip('/')}/furlong-llm/{what}-{uuid.uuid4().hex}"


_collector: ContextVar[list[str] | None] = ContextVar("staged_tables", default=None)


@contextmanager
def collecting() -> Iterator[list[str]]:
    """Lists the folders of the tables that are staged inside (in this thread)."""
    made: list[str] = []
    token = _collector.set(made)
    try:
        yield made
    finally:
        _collector.reset(token)


def remove(spark: SparkSession, *folders: str) -> None:
    """Deletes folders through the file system that holds them; a folder that
    is gone already is no error."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Deletes staged tables.  Only where everything that reads them has been
    written itself."""
    for t in tables:
        remove(t.sparkSession, t._staged_at)


def staged(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts the
    lineage, so that later stages survive lost executors without
    recomputing what came before.  This is an action.  The table stays until
    it is given to :func:`discard`, or the caller that was ``collecting``
    removes its folder."""
    spark = df.sparkSession
    path = shared_folder(spark, what)
    # the shuffle files behind the written table are of no more use
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    made = _collector.get()
    if made is not None:
        made.append(path)
    return out


def kept_by_worker(name: str, version: object, make: Callable[[], object]) -> object:
    """What ``make`` makes, kept by this Python worker for the tasks to come (the
    functions of this subpackage travel with each task, and with them their
    modules' globals).  Another ``version`` of the same name takes its place."""
    memory = sys.modules.setdefault("_furlong_worker", types.ModuleType("_furlong_worker")).__dict__
    if name not in memory or memory[name][0] != version:
        memory[name] = (version, make())
    return memory[name][1]


class Recent:
    """Values of short keys that come again: a key is kept from the second time
    on that it is met, in two generations of up to ``most / 2`` keys each, and
    goes when it has not been asked for during a whole generation.  With
    ``at_once`` it is kept from the first time on.

    ``now`` is the dict to look keys up in.  After :meth:`missing` the caller puts
    the values of the keys that it returned there; those that are not kept leave
    it with the next call."""

    _SLOTS = 1 << 22

    def __init__(self, most: int, longest: int = 64, at_once: bool = False):
        self.half, self.longest, self.at_once = most // 2, longest, at_once
        self.now, self.before, self.leaving = {}, {}, []
        self.met, self.n_met = bytearray(self._SLOTS), 0

    def missing(self, keys: Iterable) -> list:
        """The keys that are not known; the others are in ``now``."""
        for k in self.leaving:
            del self.now[k]
        if len(self.now) > self.half:
            self.now, self.before = {}, self.now
        new = set(keys).difference(self.now)
        for k in [k for k in new if k in self.before]:
            self.now[k] = self.before[k]
            new.discard(k)
        new = list(new)
        self.leaving = [k for k in new if not (len(k) <= self.longest if self.at_once else self._again(k))]
        return new

    def _again(self, key) -> bool:
        """Whether a key (or one that shares its slot) was met before."""
        slot = hash(key) & (self._SLOTS - 1)
        if self.met[slot]:
            return len(key) <= self.longest
        self.met[slot] = 1
        self.n_met += 1
        if self.n_met > self._SLOTS // 2:
            self.met, self.n_met = bytearray(self._SLOTS), 0
        return False


def unused_prefix(df: DataFrame, prefix: str) -> str:
    """``prefix``, longer by underscores until no column of ``df`` begins with it."""
    while any(c.lower().startswith(prefix.lower()) for c in df.columns):
        prefix += "_"
    return prefix


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A 64-bit key of a row's text; with the id it tells rows of one id apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))

"""Reading and writing the race tables: races, runners, horses and, where the
caller has them, payouts.

* Tables are read with their declared all-text schemas (no inference job,
  and a partition column stays text).
* Races, runners and payouts are written partitioned by ``kaisai_nen`` (race year),
  so the reports' year filter prunes whole directories of each.
* A JDBC source (the race database itself) is read through Spark's JDBC
  reader in partitions that the caller's predicates cut.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from furlong.schema import HORSES_SCHEMA, PAYOUTS_SCHEMA, RACE_KEY, RACES_SCHEMA, RUNNERS_SCHEMA, RaceTables

YEAR_PARTITION = "kaisai_nen"
TABLE_NAMES = {"races": "jvd_ra", "runners": "jvd_se", "horses": "jvd_um", "payouts": "jvd_hr"}
_SCHEMAS = {"races": RACES_SCHEMA, "runners": RUNNERS_SCHEMA, "horses": HORSES_SCHEMA, "payouts": PAYOUTS_SCHEMA}
_PARTITIONED = ("races", "runners", "payouts")


def _roles(payouts: bool) -> list[str]:
    return [r for r in TABLE_NAMES if payouts or r != "payouts"]


def read_race_tables(spark: SparkSession, base: str, fmt: str = "parquet", payouts: bool = False) -> RaceTables:
    """Read ``base/jvd_ra``, ``base/jvd_se`` and ``base/jvd_um``, and
    ``base/jvd_hr`` with ``payouts``."""
    frames = {}
    for role in _roles(payouts):
        name = TABLE_NAMES[role]
        reader = spark.read.format(fmt).schema(_SCHEMAS[role])
        if role in _PARTITIONED:
            reader = reader.option("basePath", f"{base}/{name}")
        frames[role] = reader.load(f"{base}/{name}").select(*_SCHEMAS[role].fieldNames())
    return RaceTables(**frames)


def write_race_tables(t: RaceTables, base: str, fmt: str = "parquet",
                      mode: str = "errorifexists") -> None:
    """Write the tables under ``base`` (payouts where there are any); races,
    runners and payouts partitioned by race year.  Rows are rebalanced on the year before the write: with
    adaptive execution each writer task gets one year's rows cut to the
    advisory partition size (a year holding a large share of the rows is
    split over many tasks), so each task writes one file of about that
    size into one year directory, however large the input.  Files are
    sorted by race key, so their min/max statistics let readers skip row
    groups."""
    for role in _roles(t.payouts is not None):
        name = TABLE_NAMES[role]
        df = getattr(t.select_known(), role)
        writer_df = (df.hint("rebalance", YEAR_PARTITION).sortWithinPartitions(*RACE_KEY)
                     if role in _PARTITIONED else df.hint("rebalance"))
        writer = writer_df.write.format(fmt).mode(mode)
        if role in _PARTITIONED:
            writer = writer.partitionBy(YEAR_PARTITION)
        writer.save(f"{base}/{name}")


def kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` (a new folder that all executors share) and read
    back, for callers that read it more than once.  Runs a job."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_runs(t: RaceTables, path: str) -> RaceTables:
    """The tables with ``runs``: every runner joined with its race, :func:`kept`
    under ``path``, for callers that need this join more than once.  Only the
    declared columns are kept."""
    return replace(t, runs=kept(t.select_known().joined_runs(), path))


def read_race_tables_jdbc(spark: SparkSession, url: str, properties: dict[str, str],
                          predicates: dict[str, list[str]],
                          tables: dict[str, str] | None = None, payouts: bool = False) -> RaceTables:
    """Read the tables from a database over JDBC (driver jar on the
    classpath).  ``predicates`` gives, per role (``races``, ``runners``,
    ``horses``, ``payouts``), the SQL conditions that cut the table into partitions, one
    connection and task each (see :func:`year_predicates`); together they must
    cover every row once.  All race columns are text, so bounds on a numeric
    column cannot be assumed.  The runner table is never read in one piece.
    Column selection and the year filter are pushed to the database by
    Spark's JDBC source."""
    unknown = set(predicates) - set(TABLE_NAMES)
    if unknown:
        raise ValueError(f"unknown tables {sorted(unknown)}; known: {sorted(TABLE_NAMES)}")
    if len(predicates.get("runners", ())) < 2:
        raise ValueError("the runner table needs at least two predicates (for example one per year)")
    names = {**TABLE_NAMES, **(tables or {})}
    frames = {}
    for role in _roles(payouts):
        name, cut = names[role], predicates.get(role)
        df = (spark.read.jdbc(url, name, predicates=list(cut), properties=properties) if cut
              else spark.read.jdbc(url, name, properties=properties))
        frames[role] = df.select(*_SCHEMAS[role].fieldNames())
    return RaceTables(**frames)


def year_predicates(first: int, last: int, column: str = YEAR_PARTITION) -> list[str]:
    """Conditions that cut a table by race year: one per year from ``first`` to
    ``last``, one for all years before, one for all after, one for NULL."""
    if last < first:
        raise ValueError("the last year is before the first")
    return [f"{column} < '{first}'", *[f"{column} = '{y}'" for y in range(first, last + 1)],
            f"{column} > '{last}'", f"{column} IS NULL"]


# Bucketed catalog layout.  Races and runners are bucketed and sorted on the
# whole race key, so the runner ⋈ race join of every report reads matching
# buckets and runs as a sort-merge join with no exchange on either side.
# The year is part of the bucket key rather than a directory partition:
# Spark co-partitions a join only on buckets covering all its keys
# (spark.sql.requireAllClusterKeysForCoPartition), and the race key has no
# hot value.  Files are sorted by race key (year first), so the reports'
# year filter still skips row groups from their min/max statistics.
HORSE_KEY = "ketto_toroku_bango"


def save_race_tables(t: RaceTables, database: str, buckets: int,
                     location: str | None = None, mode: str = "errorifexists") -> None:
    """Save the tables to the catalog: races, runners and payouts bucketed and
    sorted by race key into ``buckets`` buckets, horses by horse id.  Rows are
    hash-partitioned by the bucket key first, so each write task holds one
    bucket and writes one file."""
    for role in _roles(t.payouts is not None):
        name = TABLE_NAMES[role]
        df = getattr(t.select_known(), role)
        keys = RACE_KEY if role in _PARTITIONED else (HORSE_KEY,)
        writer = (df.repartition(buckets, *keys).write.format("parquet").mode(mode)
                  .bucketBy(buckets, *keys).sortBy(*keys))
        if location:
            writer = writer.option("path", f"{location}/{name}")
        writer.saveAsTable(f"{database}.{name}")


def catalog_race_tables(spark: SparkSession, database: str, payouts: bool = False) -> RaceTables:
    """The tables saved by :func:`save_race_tables` (bucketing is kept)."""
    return RaceTables(**{
        role: spark.table(f"{database}.{TABLE_NAMES[role]}").select(*_SCHEMAS[role].fieldNames())
        for role in _roles(payouts)
    })

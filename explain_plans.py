"""Write PLANS.md: the physical plan tree of every registered race query over
the tables derived from ``$BENCH_SF_DIR``, with the scans' pruning and
pushdown, for review of plan shapes."""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from furlong.plans.inspect import final_tree, scans  # noqa: E402
from furlong.plans.session import ensure_checkpoint_dir, local_session  # noqa: E402
from furlong.registry import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    out = sys.argv[1] if len(sys.argv) > 1 else "PLANS.md"
    spark = local_session(8, shuffle_partitions=16, app_name="furlong-plans")
    # shared checkpoint folder if the session names one, else a scratch one
    ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="furlong-plans-ckpt-"))
    parts = [
        "# Physical plans\n",
        f"Plans before execution (adaptive execution may still change join kinds), `{sf_dir}`, local[8], 16 shuffle "
        "partitions, tables derived from the benchmark's (generated by `explain_plans.py`).\n",
    ]
    for name, build in QUERIES.items():
        df = build(spark, sf_dir)
        parts.append(f"\n## {name}\n\n```\n{final_tree(df).strip()}\n```\n")
        lines = []
        for s in scans(df):
            table = s.get("Location", "").rstrip("]").split("/")[-1]
            keep = {k: s[k] for k in ("PartitionFilters", "PushedFilters", "ReadSchema") if k in s}
            lines.append(f"* `{table}`: " + "; ".join(f"{k} {v}" for k, v in keep.items()))
        parts.append("\n".join(lines) + "\n")
    parts.append(_at_scale(spark, sf_dir))
    with open(out, "w") as f:
        f.write("".join(parts))
    spark.stop()


def _at_scale(spark, sf_dir: str) -> str:
    """The reports and the rank as they plan when no table is small enough
    to broadcast (the target scale), over the bucketed catalog layout."""
    from furlong.operators import lookups, reports
    from furlong.sources.fixtures import fixture_tables
    from furlong.sources.tables import catalog_race_tables, save_race_tables

    base = spark.sparkContext.getCheckpointDir()
    spark.sql("CREATE DATABASE IF NOT EXISTS furlong_plans")
    save_race_tables(fixture_tables(spark, sf_dir), "furlong_plans", buckets=16,
                     location=f"{base}/furlong-plans-bucketed", mode="overwrite")
    t = catalog_race_tables(spark, "furlong_plans")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    prev = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    parts = ["\n# At scale: no broadcast, bucketed tables\n\n"
             "Both broadcast thresholds set to -1 and the tables saved with "
             "`save_race_tables` (bucketed on the race key): the runner ⋈ race join "
             "reads matching buckets with no exchange; the rank numbers sires "
             "within buckets.\n"]
    try:
        for name, df in (("jockey_course_roi", reports.jockey_course_roi(t)),
                         ("sire_track_roi_rank", lookups.sire_track_roi_rank(t))):
            parts.append(f"\n## {name}\n\n```\n{final_tree(df).strip()}\n```\n")
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
    return "".join(parts)


if __name__ == "__main__":
    main()

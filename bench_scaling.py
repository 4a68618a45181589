"""Growth check: run the runner-driven queries on the race tables derived
from ``$BENCH_SF_DIR`` replicated ×k (k in ``$SCALE_FACTORS``, default
1,4,16) and print one JSON line per k with per-query medians.

Replication is done by Spark: races, runners and horses are copied k times
under distinct race numbers, horse, parent and jockey ids, so groups, sires,
jockeys and requests grow with the data as well as the runs.  Each factor is
run over two stored layouts: year-partitioned files, and catalog tables
bucketed on the race key.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from furlong.operators import extras, lookups, pedigree, reports  # noqa: E402
from furlong.operators.runners import rated_runners  # noqa: E402
from furlong.plans.session import ensure_checkpoint_dir, local_session  # noqa: E402
from furlong.schema import RaceTables  # noqa: E402
from furlong.sources import requests as R  # noqa: E402
from furlong.sources.fixtures import fixture_tables  # noqa: E402
from furlong.sources.tables import (  # noqa: E402
    catalog_race_tables, read_race_tables, save_race_tables, write_race_tables,
)


def replicate(t: RaceTables, k: int) -> RaceTables:
    copies = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_copy")

    def grow(df, columns):
        tagged = {c: F.when(F.col("_copy") == 0, F.col(c)).otherwise(F.concat(c, F.lit("-"), F.col("_copy").cast("string")))
                  for c in columns}
        return df.select("*", copies).withColumns(tagged).drop("_copy")

    return RaceTables(grow(t.races, ["race_bango"]),
                      grow(t.runners, ["race_bango", "ketto_toroku_bango", "kishu_code"]),
                      grow(t.horses, ["ketto_toroku_bango", "ketto_joho_01a", "ketto_joho_02a"]))


QUERIES = {
    "sire_track_condition_roi": reports.sire_track_condition_roi,
    "jockey_course_roi": reports.jockey_course_roi,
    "jockey_popularity_roi": reports.jockey_popularity_roi,
    "jockey_surface_condition_roi": reports.jockey_surface_condition_roi,
    "sire_track_roi_rank": lookups.sire_track_roi_rank,
    "jockey_course_feature": lambda t: lookups.jockey_course_feature(t, R.jockey_requests(t)),
    "horse_sire_track_roi_feature":
        lambda t: lookups.horse_sire_track_roi_feature(t, R.horse_requests(t)),
    "pedigree_rows": lambda t: pedigree.pedigree_rows(t, R.registered_horses(t)),
    "pedigree_tree": lambda t: pedigree.pedigree_tree(t, R.runner_horses(t)),
    "rated_runners": rated_runners,
    "broodmare_sire_track_roi": extras.broodmare_sire_track_roi,
    "horse_course_roi": extras.horse_course_roi,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    factors = [int(x) for x in os.environ.get("SCALE_FACTORS", "1,4,16").split(",")]
    spark = local_session(cpus, shuffle_partitions=2 * cpus, app_name="furlong-scaling",
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "8g")})
    base = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="furlong-scaling-"))
    derived = fixture_tables(spark, sf_dir)
    spark.sql("CREATE DATABASE IF NOT EXISTS furlong_scaling")
    for k in factors:
        grown = replicate(derived.select_known(), k)
        path = f"{base.rstrip('/')}/furlong-scaling/{uuid.uuid4().hex[:8]}/x{k}"
        for layout in ("partitioned", "bucketed"):
            t0 = time.perf_counter()
            if layout == "partitioned":
                write_race_tables(grown, f"{path}/{layout}")
                t = read_race_tables(spark, f"{path}/{layout}")
            else:
                save_race_tables(grown, "furlong_scaling", buckets=2 * cpus, location=f"{path}/{layout}", mode="overwrite")
                t = catalog_race_tables(spark, "furlong_scaling")
            storing = time.perf_counter() - t0
            times = {}
            for name, build in QUERIES.items():
                runs = []
                for _ in range(2):
                    t1 = time.perf_counter()
                    build(t).write.format("noop").mode("overwrite").save()
                    runs.append(time.perf_counter() - t1)
                times[name] = round(min(runs), 3)
            print(json.dumps({"copies": k, "layout": layout, "runners": t.runners.count(), "storing_sec": round(storing, 2),
                              "total_sec": round(sum(times.values()), 3), "queries": times}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

"""

1. cold drain of the landed ``events`` (real evolving ingest, all collections);
2. steady-state drain: one new file per collection, same checkpoints;
3. count-only bounded drain wall clock for 4, 6, 8, 12, 16 concurrent streams, each
   against the greedy makespan projection from the per-collection durations of the
   same run.

Collections: ``events_<type>_<user_id mod 4>`` (20 children of ``events``), so the
concurrency sweep has more collections than slots. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from loamflow.operators import ownership as O  # noqa: E402
from loamflow.plans import queries as Q  # noqa: E402
from loamflow.plans.resolve import resolve  # noqa: E402
from loamflow.session import get_spark  # noqa: E402
from loamflow.streaming import measure as M  # noqa: E402
from loamflow.streaming.drain import drain, report_and_raise, specs_from_resolved  # noqa: E402


def split_frame(ev):
    base = Q.landing_frame(ev)
    return base.withColumn("collection", F.concat(F.col("collection"), F.lit("_"),
                                                  F.pmod(F.col("user_id"), F.lit(4)).cast("string")))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    spark = get_spark(cores=cpus, shuffle_partitions=cpus)
    ev = Q._table(spark, sf_dir, "events")
    out: dict = {"sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus}

    run = Q.LandedRun(spark, "measure-drains")
    t0 = time.perf_counter()
    manifest = run.land(split_frame(ev))
    out["landed_files"] = manifest.count()
    out["land_seconds"] = round(time.perf_counter() - t0, 3)
    topics = O.topics_frame(spark, [("shop.events", "high", 0)])

    t0 = time.perf_counter()
    specs = specs_from_resolved(resolve(spark, run.root, Q.DATABASE, topics))
    outcomes, _ = drain(spark, specs, run.layout)
    report_and_raise(outcomes)
    out["collections"] = len(specs)
    out["cold_drain_seconds"] = round(time.perf_counter() - t0, 3)

    extra = split_frame(ev.where(F.col("event_id") < 40)).withColumn("file_key", F.lit(10**9).cast("long"))
    run.land(extra)
    t0 = time.perf_counter()
    outcomes2, _ = drain(spark, specs, run.layout)
    report_and_raise(outcomes2)
    out["steady_state_new_files"] = outcomes2.agg(F.sum("files")).first()[0]
    out["steady_state_drain_seconds"] = round(time.perf_counter() - t0, 3)

    bare = O.topics_frame(spark, [("events", "high", 0)])
    sweep = {}
    for w in (4, 6, 8, 12, 16):
        res = M.measure(spark, run.root, Q.DATABASE, f"{run.dir}/_measurement_w{w}", bare,
                        "BOUNDED_DRAIN", max_workers=w)
        wall = res["summary"].first().full_set_wall_seconds
        proj = {r.max_workers: r.lpt_projected_full_drain_seconds for r in res["projections"].collect()}
        sweep[w] = {"wall_seconds": round(wall, 3), "lpt_projection_seconds": round(proj[w], 3)}
    out["count_only_sweep"] = sweep
    print(json.dumps(out))


if __name__ == "__main__":
    main()

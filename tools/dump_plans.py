"""Write the executed physical plans of the key operators (sf from $BENCH_SF_DIR) to stdout
as Markdown: the operator tree of the final adaptive plan, one block per operator."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loamflow.plans import queries as Q  # noqa: E402
from loamflow.session import get_spark  # noqa: E402
from loamflow.functions import schema as S  # noqa: E402
from loamflow.sources import landing as L  # noqa: E402
from loamflow.streaming import ingest as I  # noqa: E402


def tree(df, limit=60):
    df.collect()                       # runs the DataFrame's own plan, so AQE finalises it
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [ln[:150] for ln in plan.splitlines()]
    return "\n".join(lines[:limit]) + ("\n..." if len(lines) > limit else "")


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = get_spark(cores=8)
    run = Q.LandedRun(spark, "plans")
    run.land(Q.landing_frame(Q._table(spark, sf, "events")))
    files = L.list_landing(spark, run.root, Q.DATABASE)
    spec = I.CollectionSpec("events_click", "events_click", "parquet")
    batch = spark.read.format("binaryFile").load(run.layout.glob(spec)).select("path", "length")
    groups = I.probe_groups(batch, "parquet")
    frames = [I.read_group(spark, "parquet", paths, known=schema) for schema, paths in I.merge_groups(groups)]
    tracked = I.evolve_for_batch(frames, "parquet", None, True)
    ingest_batch = I.finish(S.align_and_rescue(frames[0], tracked), tracked)
    blocks = {
        "ingest micro-batch: read group, align + rescue, lineage (A7, A13, C1-C3)": ingest_batch,
        "listing statistics (A1, A4, F2)": L.listing_stats(files, L.discover_collections(files)),
        "longest-prefix ownership (E1)": Q.longest_prefix_owner(spark, sf),
        "round-robin shards (G1)": Q.shard_membership(spark, sf),
        "restart verdict (G2)": Q.restart_verdicts(spark, sf),
        "makespan projection (F8, F9)": Q.makespan_projection(spark, sf),
    }
    notes = {
        "ingest micro-batch: read group, align + rescue, lineage (A7, A13, C1-C3)":
            "one vectorised Parquet scan of the batch's files with an explicit schema (no "
            "inference job), pruned to the tracked columns plus the file-path metadata column; "
            "alignment, rescue JSON and lineage are one codegen'd projection; no shuffle.",
        "listing statistics (A1, A4, F2)":
            "the scan is of the snapshot that tasks wrote of their walk (no file status on the "
            "driver); the distinct-directory count is a two-level hash aggregate, partial before "
            "each shuffle.",
        "longest-prefix ownership (E1)":
            "prefix candidates semi-join the parents (equi-join, AQE broadcasts the side it "
            "measures small); the longest match is a hash max(length); no nested-loop join.",
        "round-robin shards (G1)":
            "distinct owners are dealt into ranges and ranked within each; only the ranges' counts "
            "(a row a range) meet in one place; rows follow through an equi-join.",
        "restart verdict (G2)":
            "one scan and no join: one exchange of the attempts by (stream, bucket) serves the windows "
            "and the aggregate to a row a bucket; a second one, of these rows, serves the rest.",
        "makespan projection (F8, F9)":
            "month sums are partially aggregated before the shuffle; collect_list per priority "
            "then folds at most one entry per month; worker counts come from explode, no join.",
    }
    print(f"# Executed plans ({os.path.basename(sf)}, local[8], AQE on)\n")
    print("Generated by `tools/dump_plans.py`; final adaptive plans after execution.\n")
    for title, df in blocks.items():
        print(f"## {title}\n\n{notes[title]}\n\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main()

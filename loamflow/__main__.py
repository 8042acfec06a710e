"""Command line: the three jobs of the system.

  python -m loamflow ingest     --source-root R --database D --raw-root W --checkpoint-root C
  python -m loamflow measure    --source-root R --database D --checkpoint-root C [--mode ...]
  python -m loamflow synthesize --source-root R --database D

Arguments are validated up front and fail loudly; the Spark session is the one the
launcher provides (spark-submit) or a local one."""

from __future__ import annotations

import argparse
import json
import re
import sys

from pyspark.sql import SparkSession

from . import config


def _positive(name):
    def parse(raw):
        try:
            v = int(str(raw).strip())
        except ValueError:
            raise argparse.ArgumentTypeError(f"{name}={raw!r} must be an integer")
        if v <= 0:
            raise argparse.ArgumentTypeError(f"{name} must be a positive integer (got {v})")
        return v
    return parse


def _nonneg(raw):
    v = int(str(raw).strip())
    if v < 0:
        raise argparse.ArgumentTypeError(f"shard_index must be >= 0 (got {v})")
    return v


def _token(raw):
    if not re.fullmatch(r"[A-Za-z0-9._-]+", raw) or ".." in raw:
        raise argparse.ArgumentTypeError(f"run_id must be one safe path token: {raw!r}")
    return raw


def _topics(spark, path):
    from .operators import ownership as O

    if not path:
        return O.topics_frame(spark)
    with open(path) as fh:
        spec = json.load(fh)          # {"high": [...], "medium": [...], "low": [...], "extra": {...}}
    rows, extra, pos = [], [], 0
    for tier in config.TIER_ORDER:
        for t in spec.get(tier, []):
            rows.append((t, tier, pos))
            pos += 1
    for tier in config.TIER_ORDER:
        for t in spec.get("extra", {}).get(tier, []):
            extra.append((t, tier, pos))
            pos += 1
    return O.topics_frame(spark, rows, extra)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="loamflow")
    sub = p.add_subparsers(dest="cmd", required=True)

    i = sub.add_parser("ingest", help="resolve collections and drain them into raw datasets")
    i.add_argument("--source-root", required=True)
    i.add_argument("--database", required=True)
    i.add_argument("--raw-root", required=True)
    i.add_argument("--checkpoint-root", required=True)
    i.add_argument("--prefix", default="")
    i.add_argument("--topics", help="JSON file of topics per tier (default: built-in parents)")
    i.add_argument("--trigger", choices=["availableNow", "continuous", "waves"], default="availableNow")
    i.add_argument("--priority", choices=["all", "high", "medium", "low"], default="all")
    i.add_argument("--max-concurrent", type=_positive("max_concurrent_streams"),
                   default=config.DEFAULT_MAX_CONCURRENT)
    i.add_argument("--waves", type=_positive("waves"), default=1)
    i.add_argument("--pause-seconds", type=_positive("pause_seconds"), default=120)
    i.add_argument("--shard-count", type=_positive("shard_count"), default=1)
    i.add_argument("--shard-index", type=_nonneg, default=0)
    i.add_argument("--schema-evolution", choices=["addNewColumns", "none"], default="addNewColumns",
                   help="none: schema frozen at first inference, new columns go to _rescued_data")

    m = sub.add_parser("measure", help="listing-only or count-only drain measurement")
    m.add_argument("--source-root", required=True)
    m.add_argument("--database", required=True)
    m.add_argument("--checkpoint-root", required=True)
    m.add_argument("--topics")
    m.add_argument("--mode", choices=["LISTING_ONLY", "BOUNDED_DRAIN"], default="LISTING_ONLY")
    m.add_argument("--max-workers", type=_positive("max_workers"), default=config.DEFAULT_MAX_CONCURRENT)
    m.add_argument("--run-id", type=_token)
    m.add_argument("--results-path", help="append typed results (Parquet) here")
    m.add_argument("--results-table", help="append typed results to this catalog table")

    s = sub.add_parser("synthesize", help="write a synthetic landing zone")
    s.add_argument("--source-root", required=True)
    s.add_argument("--database", required=True)
    s.add_argument("--num-days", type=_positive("num_days"), default=3)
    s.add_argument("--files-per-day", type=_positive("files_per_day"), default=5)
    s.add_argument("--rows-per-file", type=_positive("rows_per_file"), default=200)
    s.add_argument("--seed", type=int, default=42)

    a = p.parse_args(argv)
    if a.cmd == "ingest" and not (0 <= a.shard_index < a.shard_count):
        p.error(f"shard_index={a.shard_index} must satisfy 0 <= shard_index < shard_count")
    spark = SparkSession.builder.appName(f"loamflow-{a.cmd}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")

    if a.cmd == "ingest":
        from .plans.resolve import resolution_counts, resolve
        from .streaming.drain import drain, drain_waves, report_and_raise, row_counts, specs_from_resolved
        from .streaming.ingest import Layout

        layout = Layout(a.source_root, a.database, a.raw_root, a.checkpoint_root, a.prefix)
        resolved = resolve(spark, a.source_root, a.database, _topics(spark, a.topics), a.priority,
                           a.shard_count, a.shard_index)
        resolution_counts(resolved).show(truncate=False)
        specs = specs_from_resolved(resolved)
        evolve = a.schema_evolution == "addNewColumns"
        if a.trigger == "waves":
            outcomes, _ = drain_waves(spark, specs, layout, a.waves, a.pause_seconds,
                                      max_concurrent=a.max_concurrent, evolve=evolve)
        else:
            outcomes, _ = drain(spark, specs, layout, None, a.max_concurrent, a.trigger, evolve)
        outcomes.orderBy("collection").show(200, truncate=False)
        report_and_raise(outcomes)
        row_counts(spark, layout, specs).orderBy("collection").show(200, truncate=False)
    elif a.cmd == "measure":
        if "_measurement" not in a.checkpoint_root.lower():
            p.error("checkpoint_root must contain '_measurement' (kept apart from production)")
        from .sources.results import append_results, append_results_table
        from .streaming.measure import measure

        res = measure(spark, a.source_root, a.database, a.checkpoint_root,
                      _topics(spark, a.topics), a.mode, a.run_id, a.max_workers)
        res["summary"].show(truncate=False)
        res["projections"].show(truncate=False)
        res["measurements"].orderBy("collection").show(200, truncate=False)
        if a.results_path:
            append_results(res["measurements"], a.results_path)
        if a.results_table:
            append_results_table(spark, res["measurements"], a.results_table)
    else:
        from .session import new_run_dir
        from .sources.synth import synth_summary, synthesize

        manifest = synthesize(spark, a.source_root, a.database, f"{new_run_dir(spark, 'synth')}/manifest",
                              a.num_days, a.files_per_day, a.rows_per_file, a.seed)
        synth_summary(manifest).orderBy("collection").show(truncate=False)
        print(f"source_root = {a.source_root}")
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Drain of many collections: one stream each, at most ``max_concurrent`` running at a time.

A stream that fails doesn't stop the others, and isn't started again here: its checkpoint
stands, so the next run of the job (the scheduler's retry) goes on where it ended. What each
stream came to is one row; kind and message are column expressions over these rows."""

from __future__ import annotations

import time
import warnings
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import names as N
from .filestate import plan_files, start_planner
from .ingest import BatchHandler, CollectionSpec, Layout, ingested_files, read_raw, start_ingest

_ENDED = "run_id string, collection string, name string, error string, batches long, files long"
PROGRESS_SCHEMA = ("run_id string, collection string, batch_id long, input_files long, batch_ms long, "
                   "rows long, rescued_rows long, malformed_lines long")


def specs_from_resolved(resolved: DataFrame) -> list[CollectionSpec]:
    """Present collections (format known) as specs; one row per collection."""
    rows = (resolved.where(F.col("format").isNotNull())
            .select("collection", "name", "format", "tier", "max_files", "interval_seconds")
            .orderBy("collection").collect())
    specs = [CollectionSpec(r.collection, r.name, r.format, r.tier, int(r.max_files),
                            int(r.interval_seconds)) for r in rows]
    by_name: dict[str, list[str]] = {}
    for sp in specs:
        by_name.setdefault(sp.name, []).append(sp.collection)
    clash = {n: c for n, c in by_name.items() if len(c) > 1}
    if clash:
        raise ValueError(f"collections share a table name and checkpoint: {clash}")
    return specs


def _until_end(spark: SparkSession, handler: BatchHandler, trigger: str) -> str | None:
    """Run one stream until it ends; the text of what ended it, None for a clean end."""
    # a pool for each collection, so that under spark.scheduler.mode=FAIR a large one doesn't
    # hold back the small ones
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"raw_{handler.spec.name}")
    try:
        start_ingest(spark, handler.spec, handler.layout, trigger, handler.evolve, handler, plan=False).awaitTermination()
    except Exception as e:
        return str(e) or type(e).__name__
    return None


def _width(specs: list, max_concurrent: int, trigger: str) -> int:
    if max_concurrent <= 0:
        raise ValueError("max_concurrent must be a positive integer")
    if trigger == "continuous":  # no stream ends, so each needs a thread from the start
        if len(specs) > max_concurrent:
            warnings.warn(f"{len(specs)} continuous streams run at once; max_concurrent is {max_concurrent}")
        return max(1, len(specs))
    if max_concurrent > config.MAX_CONCURRENT_CAP:
        warnings.warn(f"max_concurrent {max_concurrent} is lowered to {config.MAX_CONCURRENT_CAP}")
    return min(max_concurrent, config.MAX_CONCURRENT_CAP)


def drain(spark: SparkSession, specs: list[CollectionSpec], layout: Layout, run_id: str | None = None,
          max_concurrent: int = config.DEFAULT_MAX_CONCURRENT, trigger: str = "availableNow",
          evolve: bool = True, files: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Drain every collection; ``files`` is the zone's listing, if there is one already. Returns (outcomes, progress): one row a collection with status,
    failure kind and message, and one row for every micro-batch that was written, with its
    files, rows, rescued rows and malformed lines (observed on the write)."""
    run_id = N.run_token(run_id)
    handlers = [BatchHandler(s, layout, evolve) for s in specs]
    width = _width(specs, max_concurrent, trigger)
    if specs:
        plan_files(spark, layout, specs, files)  # one listing for all
    planner = (start_planner(spark, layout, specs, min(s.interval_seconds for s in specs))
               if specs and trigger == "continuous" else None)
    try:
        with ThreadPoolExecutor(max_workers=width) as pool:
            errors = list(pool.map(lambda h: _until_end(spark, h, trigger), handlers))
    finally:
        if planner is not None:
            planner.stop()
    ended = spark.createDataFrame(
        [(run_id, h.spec.collection, h.spec.name, e, h.batches, h.files_seen) for h, e in zip(handlers, errors)], _ENDED)
    progress = spark.createDataFrame(
        [(run_id, h.spec.collection, *p) for h in handlers for p in h.progress], PROGRESS_SCHEMA)
    return outcomes_of(ended), progress


def outcomes_of(ended: DataFrame) -> DataFrame:
    """status 'ok' or 'failed', kind ('ok' or the failure's) and the cleaned-up message."""
    return ended.select(
        "run_id", "collection", "name", F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"),
        F.coalesce(N.failure_kind("error"), F.lit("ok")).alias("kind"), "batches", "files",
        N.clean_message("error").alias("message"))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """ok / failed counts and the sorted failed names, per run."""
    failed = F.col("status") != "ok"
    return outcomes.groupBy("run_id").agg(
        F.count_if(~failed).alias("ok"), F.count_if(failed).alias("failed"),
        F.array_sort(F.collect_list(F.when(failed, F.col("name")))).alias("failed_names"))


def report_and_raise(outcomes: DataFrame, context: str = "raw ingestion") -> None:
    """Raise when any collection failed."""
    failed = outcomes.where(F.col("status") != "ok").select("name", "message").orderBy("name").collect()
    if failed:
        raise RuntimeError(f"{context}: {len(failed)} collection(s) failed: "
                           + "; ".join(f"{r.name}: {r.message}" for r in failed))


def drain_or_raise(spark: SparkSession, specs: list[CollectionSpec], layout: Layout, **options) -> DataFrame:
    """Drain every collection and return the outcomes; raise if any failed, so that nothing is
    read that only looks complete."""
    outcomes, _ = drain(spark, specs, layout, **options)
    report_and_raise(outcomes)
    return outcomes


def raw_union(spark: SparkSession, layout: Layout, specs: list[CollectionSpec],
              columns: list[str] | None = None) -> DataFrame | None:
    """All raw datasets as one DataFrame with a ``collection`` column."""
    frames = []
    for s in specs:
        df = read_raw(spark, layout, s.name)
        if df is None:
            continue
        if columns is not None:
            df = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                             for c in columns])
        frames.append(df.withColumn("collection", F.lit(s.collection)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def row_counts(spark: SparkSession, layout: Layout, specs: list[CollectionSpec]) -> DataFrame:
    """Rows per collection's raw dataset (0 when nothing was ingested yet). No column is
    read: Parquet row counts come from the row-group metadata."""
    u = raw_union(spark, layout, specs, columns=[])
    names = spark.createDataFrame([(s.collection,) for s in specs], "collection string")
    if u is None:
        return names.withColumn("n", F.lit(0).cast("bigint"))
    counts = u.groupBy("collection").agg(F.count(F.lit(1)).alias("n"))
    return names.join(counts, "collection", "left").select(
        "collection", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def drain_waves(spark: SparkSession, specs: list[CollectionSpec], layout: Layout, waves: int,
                pause_seconds: float = 120.0, **options) -> tuple[DataFrame, DataFrame]:
    """Repeated bounded drains with a pause between; a wave with a failure is the last. Outcomes
    and progress carry the wave number."""
    if waves < 1 or pause_seconds <= 0:
        raise ValueError("waves and pause_seconds must be positive")
    done: list[tuple[DataFrame, DataFrame]] = []
    for wave in range(1, waves + 1):
        if done:
            time.sleep(pause_seconds)
        outcomes, progress = drain(spark, specs, layout, **options)
        report_and_raise(outcomes, f"drain wave {wave}")
        done.append((outcomes.withColumn("wave", F.lit(wave)), progress.withColumn("wave", F.lit(wave))))
    return tuple(reduce(DataFrame.unionByName, frames) for frames in zip(*done))


def ingested_file_table(spark: SparkSession, layout: Layout, specs: list[CollectionSpec]) -> DataFrame:
    """(collection, batch_id, path) over the file manifests of all collections."""
    empty = spark.createDataFrame([], "batch_id bigint, path string, collection string")
    return reduce(DataFrame.unionByName, [
        ingested_files(spark, layout, s.name).withColumn("collection", F.lit(s.collection)) for s in specs], empty)

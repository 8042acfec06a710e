"""Driver-contract queries: every operator family run over the given tables.

"Landed" queries write rows of ``events`` below a fresh folder of the shared work root in
the landing layout (collections ``events_<event_type>``, ``signup`` as CSV, timestamps as
epoch microseconds, at most ``ROWS_PER_FILE`` rows per file), stream them in, and query the
result; every landed query lands and drains all collections of the whole table. Each
function takes (spark, sf_dir) and returns a DataFrame; ``oracle.ORACLE_SQL`` holds the
DuckDB twin of each (same column names) except the two that carry wall-clock seconds."""

from __future__ import annotations

import gzip
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import names as N
from ..operators import ownership as O
from ..operators.projection import ceil_rounds, makespan
from ..operators.restarts import restart_verdict
from ..session import new_run_dir
from ..sources import landing as L
from ..sources import storage
from ..sources.landing_writer import block_file_key, write_landing
from ..sources.results import append_results, read_results, read_results_json, write_results_json
from ..streaming import measure as M
from ..streaming.drain import (drain, drain_waves, ingested_file_table, outcome_counts, raw_union, report_and_raise,
                               row_counts, specs_from_resolved)
from ..streaming.ingest import CollectionSpec, Layout, committed_batches, compact, raw_folders
from .resolve import resolution_counts, resolve

ROWS_PER_FILE = 2000
DATABASE = "shop"
EVENT_TOPICS = [("shop.events", "high", 0), ("shop.events_purchase", "medium", 1)]
# The measurement side keys parents on bare collection names.
BARE_TOPICS = [("events", "high", 0), ("events_purchase", "medium", 1)]

_CACHE: dict = {}


def clear_cache() -> None:
    _CACHE.clear()


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Epoch values of the landed rows are defined in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts():
    return F.col("ts").cast("timestamp")


def landing_frame(ev: DataFrame, csv_types=("signup",), extra=()) -> DataFrame:
    """events -> landing rows: one collection per event type, one file per
    (collection, day, event_id block)."""
    ts = _ts()
    return ev.select(
        F.concat(F.lit("events_"), F.col("event_type")).alias("collection"),
        F.to_date(ts).alias("day"),
        block_file_key("event_id", ROWS_PER_FILE).alias("file_key"),
        F.unix_millis(ts).alias("file_epoch_ms"),
        F.when(F.col("event_type").isin(*csv_types), "csv").otherwise("parquet").alias("_format"),
        "event_id", "user_id", F.unix_micros(ts).alias("ts_us"), "value", "props", *extra)


class LandedRun:
    """Folders of one landed run below the shared work root."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.dir = new_run_dir(spark, label)
        self.root = f"{self.dir}/landing"
        self.layout = Layout(self.root, DATABASE, f"{self.dir}/raw", f"{self.dir}/ckpt")
        self.n = 0
        self.specs: list[CollectionSpec] = []
        self.outcomes = None

    def land(self, df: DataFrame, omit_null_columns: bool = False) -> DataFrame:
        self.n += 1
        return write_landing(df, self.root, DATABASE, f"{self.dir}/_manifest_{self.n}",
                             omit_null_columns=omit_null_columns)

    def files(self) -> DataFrame:
        return L.list_landing(self.spark, self.root, DATABASE)


def _topics(spark):
    return O.topics_frame(spark, EVENT_TOPICS)


def _bare_topics(spark):
    return O.topics_frame(spark, BARE_TOPICS)


def full_drain(spark: SparkSession, sf_dir: str) -> LandedRun:
    """Land all events, resolve, drain every collection (cached per session and sf)."""
    key = ("full", spark.sparkContext.applicationId, sf_dir)
    if key in _CACHE:
        return _CACHE[key]
    run = LandedRun(spark, "full")
    run.land(landing_frame(_table(spark, sf_dir, "events")))
    files = run.files()
    run.specs = specs_from_resolved(resolve(spark, run.root, DATABASE, _topics(spark), files=files))
    run.outcomes, run.progress = drain(spark, run.specs, run.layout, files=files)
    report_and_raise(run.outcomes)
    _CACHE[key] = run
    return run


# ----------------------------------------------------------------------------------------
# queries
# ----------------------------------------------------------------------------------------

def raw_rows_by_collection(spark, sf_dir):
    run = full_drain(spark, sf_dir)
    return row_counts(spark, run.layout, run.specs)


def drain_outcomes(spark, sf_dir):
    run = full_drain(spark, sf_dir)
    return run.outcomes.select("collection", "status", "batches", "files")


def drain_outcome_counts(spark, sf_dir):
    run = full_drain(spark, sf_dir)
    return outcome_counts(run.outcomes).select("ok", "failed")


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _drain_all(spark, run: LandedRun, evolve: bool = True) -> list[CollectionSpec]:
    """Resolve and drain every landed collection (concurrently); fail on any failure."""
    files = run.files()
    specs = specs_from_resolved(resolve(spark, run.root, DATABASE, _topics(spark), files=files))
    run.outcomes, run.progress = drain(spark, specs, run.layout, evolve=evolve, files=files)
    report_and_raise(run.outcomes)
    return specs


def _raw_all(spark, run: LandedRun, specs, cols) -> DataFrame:
    return raw_union(spark, run.layout, specs, columns=cols).select("collection", *cols)


def raw_content(spark, sf_dir):
    run = full_drain(spark, sf_dir)
    cols = ["event_id", "user_id", "ts_us", "value", "props", "_file_epoch_ms"]
    return _raw_all(spark, run, run.specs, cols).withColumnRenamed("_file_epoch_ms", "file_epoch_ms")


def csv_header_drift(spark, sf_dir):
    run = LandedRun(spark, "csvdrift")
    ev = _table(spark, sf_dir, "events")
    run.land(landing_frame(ev, csv_types=EVENT_TYPES)
             .withColumn("_reverse", F.dayofmonth("day") % 2 == 0))
    specs = _drain_all(spark, run)
    return _raw_all(spark, run, specs, ["event_id", "user_id", "ts_us", "value", "props"])


def _two_waves_props(spark, sf_dir, label, evolve):
    run = LandedRun(spark, label)
    ev = _table(spark, sf_dir, "events")
    early = F.dayofmonth(_ts()) <= 15
    run.land(landing_frame(ev.where(early)).withColumn("props", F.lit(None).cast("string")),
             omit_null_columns=True)
    _drain_all(spark, run, evolve)
    run.land(landing_frame(ev.where(~early)))
    return run, _drain_all(spark, run, evolve)


def evolved_columns(spark, sf_dir):
    run, specs = _two_waves_props(spark, sf_dir, "evolve", True)
    return _raw_all(spark, run, specs, ["event_id", "value", "props"])


def frozen_schema_rescue(spark, sf_dir):
    run, specs = _two_waves_props(spark, sf_dir, "frozen", False)
    return _raw_all(spark, run, specs, ["event_id", "_rescued_data"])


def rescued_values(spark, sf_dir):
    run = LandedRun(spark, "rescue")
    ev = _table(spark, sf_dir, "events")
    odd = F.dayofmonth(_ts()) % 2 == 1
    run.land(landing_frame(ev.where(odd)))
    _drain_all(spark, run)
    text = F.concat(F.lit("n/a:"), F.round(F.col("value") * 100).cast("bigint").cast("string"))
    run.land(landing_frame(ev.where(~odd)).withColumn("value", text))
    specs = _drain_all(spark, run)
    return _raw_all(spark, run, specs, ["event_id", "value", "_rescued_data"])


def rescued_type_pairs(spark, sf_dir):
    """ts_us comes as bigint first, then as a date, a boolean, binary or (CSV) text that no cast takes."""
    run = LandedRun(spark, "pairs")
    ev = _table(spark, sf_dir, "events")
    odd = F.dayofmonth(_ts()) % 2 == 1
    run.land(landing_frame(ev.where(odd)))
    _drain_all(spark, run)
    later = landing_frame(ev.where(~odd))
    typed = {"signup": F.concat(F.lit("at "), F.col("ts_us").cast("string")), "click": F.to_date(F.timestamp_micros("ts_us")), "error": F.col("value") > 50,
             "purchase": F.col("event_id").cast("string").cast("binary"), "view": F.to_date(F.timestamp_micros("ts_us"))}
    for kind, value in typed.items():
        run.land(later.where(F.col("collection") == f"events_{kind}").withColumn("ts_us", value))
    specs = _drain_all(spark, run)
    return _raw_all(spark, run, specs, ["event_id", "ts_us", "_rescued_data"])


def lineage(spark, sf_dir):
    """Where every row came from, and that it came in this run."""
    run = full_drain(spark, sf_dir)
    raw = _raw_all(spark, run, run.specs, ["event_id", "_source_file", "_ingested_at"])
    return raw.select("event_id", F.regexp_extract("_source_file", "([^/]+)$", 1).alias("file_name"),
                      (F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("_ingested_at")) < 86400).alias("recent"))


def priority_and_shard(spark, sf_dir):
    """Collections of one tier, of one shard, and with an extra topic; one not owned by any."""
    run = LandedRun(spark, "priority")
    ev = _table(spark, sf_dir, "events")
    run.land(landing_frame(ev))
    run.land(landing_frame(ev.where("event_type = 'click'")).withColumn("collection", F.lit("audit")))
    topics = O.topics_frame(spark, EVENT_TOPICS, [("shop.events_view", "low", 0)])
    files = run.files()
    views = {"all": {}, "high": {"priority": "high"}, "low": {"priority": "low"},
             "shard": {"shard_count": 2, "shard_index": 1}}
    out = [resolve(spark, run.root, DATABASE, topics, files=files, **kw).select(
        F.lit(view).alias("view"), "collection", "owner", "tier") for view, kw in views.items()]
    return reduce(DataFrame.unionByName, out)


def measured_fallback(spark, sf_dir):
    """Nothing that landed is owned, so the parents are reported: NO_FILES, all zero."""
    run = LandedRun(spark, "fallback")
    run.land(landing_frame(_table(spark, sf_dir, "events")))
    topics = O.topics_frame(spark, [("orders", "high", 0), ("refunds", "low", 1)])
    res = M.measure(spark, run.root, DATABASE, f"{run.dir}/_measurement", topics, "BOUNDED_DRAIN")
    return res["measurements"].select("collection", "status", "file_count", "micro_batches", "rows_seen",
                                      "total_drain_wall_seconds", "batch_details_json")


def listing_tree(spark, sf_dir):
    """Bytes and folders of the listing against the manifest of what was landed."""
    run = LandedRun(spark, "tree")
    manifest = run.land(landing_frame(_table(spark, sf_dir, "events")))
    res = M.measure(spark, run.root, DATABASE, f"{run.dir}/_measurement", _bare_topics(spark))
    landed = manifest.groupBy("collection").agg(F.sum("bytes").alias("bytes"), F.sum("rows").cast("bigint").alias("rows"))
    return res["measurements"].join(landed, "collection").select(
        "collection", "year_dirs_walked", "month_dirs_walked", "day_dirs_walked", "partition_tree_depth", "rows",
        (F.col("total_bytes") == F.col("bytes")).alias("bytes_match"))


def results_append(spark, sf_dir):
    """Typed results of two runs appended to one dataset."""
    res = _measured(spark, sf_dir, "LISTING_ONLY")
    path = f"{new_run_dir(spark, 'results')}/parquet"
    for _ in range(2):
        append_results(res["measurements"], path)
    return read_results(spark, path).groupBy("collection", "status").agg(
        F.count("*").alias("runs"), F.sum("file_count").alias("files"))


def late_files(spark, sf_dir):
    run = LandedRun(spark, "late")
    ev = _table(spark, sf_dir, "events")
    early = F.dayofmonth(_ts()) <= 5
    run.land(landing_frame(ev.where(~early)))
    _drain_all(spark, run)
    old = F.unix_millis(F.current_timestamp()) - F.lit(60 * 86400 * 1000)
    # files without a modification time (0) are no older than any other to the stream
    mtime = F.when(F.dayofmonth(_ts()) <= 2, F.lit(0).cast("bigint")).otherwise(old)
    run.land(landing_frame(ev.where(early).withColumn("_late", mtime), extra=("_late",))
             .withColumnRenamed("_late", "_mtime_ms").withColumn("_batch_id", F.col("user_id") + 1))
    specs = _drain_all(spark, run)
    return _raw_all(spark, run, specs, ["event_id", "ts_us", "_batch_id"]).withColumnRenamed("_batch_id", "batch_id")


def steady_state_increment(spark, sf_dir):
    run = LandedRun(spark, "steady")
    ev = _table(spark, sf_dir, "events")
    early = F.dayofmonth(_ts()) <= 15
    run.land(landing_frame(ev.where(early)))
    pinned = "steady-probe"
    M.measure(spark, run.root, DATABASE, f"{run.dir}/_measurement", _bare_topics(spark),
              "BOUNDED_DRAIN", pinned)
    run.land(landing_frame(ev.where(~early)))
    second = M.measure(spark, run.root, DATABASE, f"{run.dir}/_measurement", _bare_topics(spark),
                       "BOUNDED_DRAIN", pinned)
    return second["measurements"].select("collection", "rows_seen")


def _measured(spark, sf_dir, mode: str, tiers_rows=None, label="measure"):
    key = (label, mode, spark.sparkContext.applicationId, sf_dir)
    if key in _CACHE:
        return _CACHE[key]
    run = LandedRun(spark, label)
    run.land(landing_frame(_table(spark, sf_dir, "events")))
    tiers = O.tiers_frame(spark, tiers_rows) if tiers_rows else None
    res = M.measure(spark, run.root, DATABASE, f"{run.dir}/_measurement", _bare_topics(spark),
                    mode, tiers=tiers)
    res["run"] = run
    _CACHE[key] = res
    return res


def rate_limited_batches(spark, sf_dir):
    res = _measured(spark, sf_dir, "BOUNDED_DRAIN",
                    [("high", 7, 90), ("medium", 7, 90), ("low", 7, 90)], "ratelimit")
    return res["measurements"].select("collection", "file_count", "micro_batches", "rows_seen")


def batch_details_json(spark, sf_dir):
    res = _measured(spark, sf_dir, "BOUNDED_DRAIN",
                    [("high", 7, 90), ("medium", 7, 90), ("low", 7, 90)], "ratelimit")
    return M.batch_details(res["batches"]).select("collection", "micro_batches", "rows_seen",
                                                  "batch_details_json")


def batch_rows_json(spark, sf_dir):
    run = LandedRun(spark, "batchrows")
    frame = landing_frame(_table(spark, sf_dir, "events"))
    # modification times fixed by (day, file key): the file stream's order, hence every
    # micro-batch's files, is reproducible
    frame = frame.withColumn("_mtime_ms", F.unix_millis(F.to_timestamp("day"))
                             + F.col("file_key") * F.lit(1000))
    run.land(frame)
    tiers = O.tiers_frame(spark, [("high", 7, 90), ("medium", 7, 90), ("low", 7, 90)])
    res = M.measure(spark, run.root, DATABASE, f"{run.dir}/_measurement", _bare_topics(spark),
                    "BOUNDED_DRAIN", tiers=tiers)
    return M.batch_details(res["batches"], with_seconds=False).select(
        "collection", "micro_batches", "rows_seen", "batch_rows_json")


def ingest_batches(spark, sf_dir):
    """Rows, rescued rows and malformed lines that each collection's batches were observed to
    write: an odd number of days as they are, the others with a value that doesn't fit."""
    run = LandedRun(spark, "observed")
    ev = _table(spark, sf_dir, "events")
    odd = F.dayofmonth(_ts()) % 2 == 1
    run.land(landing_frame(ev.where(odd)))
    _drain_all(spark, run)
    first = run.progress
    run.land(landing_frame(ev.where(~odd)).withColumn("value", F.lit("n/a")))
    _drain_all(spark, run)
    return first.unionByName(run.progress).groupBy("collection").agg(
        F.count("*").alias("batches"), F.sum("rows").alias("rows"), F.sum("rescued_rows").alias("rescued_rows"),
        F.sum("malformed_lines").alias("malformed_lines"))


def drain_wave_log(spark, sf_dir):
    """Two waves over one landing: the first takes every file, the second finds nothing new."""
    run = LandedRun(spark, "waves")
    run.land(landing_frame(_table(spark, sf_dir, "events")))
    specs = specs_from_resolved(resolve(spark, run.root, DATABASE, _topics(spark)))
    outcomes, progress = drain_waves(spark, specs, run.layout, 2, pause_seconds=0.01)
    rows = progress.groupBy("wave", "collection").agg(F.sum("rows").alias("rows"))
    return outcomes.join(rows, ["wave", "collection"], "left").select(
        "wave", "collection", "status", "kind", "batches", "files", F.coalesce("rows", F.lit(0)).alias("rows"))


def compacted_content(spark, sf_dir):
    """The raw rows of two drains' batches after these were put together, how many batches there
    were, and in how many folders they are now."""
    run = LandedRun(spark, "compact")
    ev = _table(spark, sf_dir, "events")
    for late in (False, True):
        run.land(landing_frame(ev.where((F.dayofmonth(_ts()) > 10) == late)))
        specs = _drain_all(spark, run)
    for s in specs:
        compact(spark, run.layout, s.name)
    folders = spark.createDataFrame([(s.collection, len(committed_batches(spark, run.layout, s.name)),
                                      len(raw_folders(spark, run.layout, s.name))) for s in specs],
                                    "collection string, batches long, folders long")
    return _raw_all(spark, run, specs, ["event_id", "ts_us", "value"]).join(folders, "collection")


def hostile_tree(spark, sf_dir):
    """One listing of a zone with sibling names, gzip files, both formats in one folder, files of
    neither and a collection without any that can be read: how it resolves, what is listed."""
    run = LandedRun(spark, "hostile")
    ev = _table(spark, sf_dir, "events")
    run.land(landing_frame(ev, csv_types=("signup", "view")))
    view = landing_frame(ev.where("event_type = 'view'"))
    run.land(view.withColumn("collection", F.lit("events_viewers")))  # a name that begins with another's
    run.land(landing_frame(ev.where("event_type = 'click' and user_id % 2 = 0")).withColumn("_format", F.lit("csv")))
    day = f"{run.root}/{config.LANDING_SOURCE_SEGMENT}/year=2024/month=01/day=01/database={DATABASE}"
    storage.write(spark, f"{day}/collection=events_notes/readme.txt", b"neither format")
    storage.write(spark, f"{day}/collection=events_view/0000000000001_v.csv.gz", gzip.compress(b"event_id\n-1\n"))
    storage.write(spark, f"{day}/collection=events_view/_hidden.csv", b"event_id\n-2\n")
    files = run.files()
    resolved = resolve(spark, run.root, DATABASE, _topics(spark), files=files)
    stats = L.listing_stats(files, resolved.select("collection"))
    mixed = L.mixed_format_dirs(files).groupBy("collection").agg(F.count("*").alias("mixed_dirs"))
    drain_specs = specs_from_resolved(resolved)
    outcomes, progress = drain(spark, drain_specs, run.layout, files=files)
    report_and_raise(outcomes)
    rows = progress.groupBy("collection").agg(F.sum("rows").alias("rows"))
    return (resolved.select("collection", "owner", F.col("format").alias("drained_as"))
            .join(stats.select("collection", F.col("format").alias("listed_as"), "file_count"), "collection")
            .join(mixed, "collection", "left").join(rows, "collection", "left").fillna(0, ["mixed_dirs", "rows"]))


def failed_outcomes(spark, sf_dir):
    """A drain in which one collection holds a file that can't be read: it fails, the others are
    drained whole, and the report names it and stops the job."""
    run = LandedRun(spark, "failed")
    run.land(landing_frame(_table(spark, sf_dir, "events")))
    day = f"{run.root}/{config.LANDING_SOURCE_SEGMENT}/year=2024/month=01/day=01/database={DATABASE}"
    storage.write(spark, f"{day}/collection=events_error/0000000000001_error_00_00.parquet", b"not parquet")
    specs = specs_from_resolved(resolve(spark, run.root, DATABASE, _topics(spark)))
    outcomes, _progress = drain(spark, specs, run.layout)
    try:
        report_and_raise(outcomes)
        report = ""
    except RuntimeError as e:
        report = str(e)
    counts = outcome_counts(outcomes).select("run_id", "ok", "failed", F.array_join("failed_names", ",").alias("failed_names"))
    return (outcomes.join(row_counts(spark, run.layout, specs), "collection").join(counts, "run_id").select(
        "collection", "status", "kind", F.when(F.col("status") == "ok", F.col("n")).alias("rows"), "ok", "failed",
        "failed_names", F.lit("1 collection(s) failed: events_error: " in report).alias("stops_the_job")))


def resolution_split(spark, sf_dir):
    """Selected, parents and children, present and skipped, and formats of one resolution with a
    topic that nothing landed for, its parent present or not."""
    run = LandedRun(spark, "split")
    run.land(landing_frame(_table(spark, sf_dir, "events"), csv_types=("signup", "error")))
    topics = O.topics_frame(spark, EVENT_TOPICS, [("shop.events_view", "low", 0)])
    day = f"{run.root}/{config.LANDING_SOURCE_SEGMENT}/year=2024/month=01/day=01/database={DATABASE}"
    storage.write(spark, f"{day}/collection=events_empty/notes.txt", b"")
    return resolution_counts(resolve(spark, run.root, DATABASE, topics))


def measured_times(spark, sf_dir):
    """What is exact about a run's times: the total is the sum of the phases, and the time of the
    measurement comes back from JSON as it was."""
    res = _measured(spark, sf_dir, "BOUNDED_DRAIN",
                    [("high", 7, 90), ("medium", 7, 90), ("low", 7, 90)], "ratelimit")
    path = f"{new_run_dir(spark, 'results')}/json"
    write_results_json(res["measurements"], path)
    back, now = read_results_json(spark, path), res["measurements"]
    both = back.alias("b").join(now.alias("n"), "collection")
    return both.select(
        "collection", (F.abs(F.col("b.total_drain_wall_seconds") - (F.col("b.query_start_seconds") + F.col("b.drain_seconds")
                                                                    + F.col("b.query_stop_seconds"))) < 1e-6).alias("total_is_sum"),
        (F.col("b.drain_seconds") > 0).alias("drained"),
        (F.unix_millis("b.measured_at_utc") == F.unix_millis("n.measured_at_utc")).alias("same_time"),
        F.col("b.run_id").rlike("^[0-9]{8}T[0-9]{6}Z_[0-9a-f]{8}$").alias("run_token"))


def drain_projection(spark, sf_dir):
    res = _measured(spark, sf_dir, "BOUNDED_DRAIN",
                    [("high", 7, 90), ("medium", 7, 90), ("low", 7, 90)], "ratelimit")
    return res["projections"].select("max_workers", "simple_ceil_collection_rounds",
                                     "lpt_projected_full_drain_seconds")


def listing_stats(spark, sf_dir):
    res = _measured(spark, sf_dir, "LISTING_ONLY")
    return res["measurements"].select("collection", "format", "file_count",
                                      "collection_dirs_checked", "status")


def run_summary(spark, sf_dir):
    res = _measured(spark, sf_dir, "LISTING_ONLY")
    return res["summary"].select("parents_present", "children_discovered", "collections_measured",
                                 "errored_collections", "visible_files")


def results_cast(spark, sf_dir):
    res = _measured(spark, sf_dir, "LISTING_ONLY")
    path = f"{new_run_dir(spark, 'results')}/json"
    write_results_json(res["measurements"], path)
    back = read_results_json(spark, path)
    return back.select("collection", "listing_status", "status", "file_count", "drain_seconds")


def format_detection(spark, sf_dir):
    run = LandedRun(spark, "formats")
    ev = _table(spark, sf_dir, "events")
    run.land(landing_frame(ev))
    extra = ev.where((F.col("event_type") == "view") & (F.dayofmonth(_ts()) <= 3))
    run.land(landing_frame(extra).withColumn("_format", F.lit("csv")))
    files = run.files()
    fmt = L.detect_formats(files)
    mixed = L.mixed_format_dirs(files).groupBy("collection").agg(F.count(F.lit(1)).alias("mixed_dirs"))
    return fmt.join(mixed, "collection", "left").select(
        "collection", "format", F.coalesce("mixed_dirs", F.lit(0)).cast("bigint").alias("mixed_dirs"))


def resolve_collections(spark, sf_dir):
    run = LandedRun(spark, "resolve")
    run.land(landing_frame(_table(spark, sf_dir, "events")))
    topics = O.topics_frame(spark, EVENT_TOPICS + [("shop.events_refund", "low", 2)])
    res = resolve(spark, run.root, DATABASE, topics, shard_count=2, shard_index=None)
    return res.select("collection", "name", "owner", "tier", "format", "is_parent",
                      "shard_index", "max_files", "interval_seconds")


def backlog_anti(spark, sf_dir):
    run = LandedRun(spark, "backlog")
    ev = _table(spark, sf_dir, "events")
    early = F.dayofmonth(_ts()) <= 15
    run.land(landing_frame(ev.where(early)))
    specs = _drain_all(spark, run)
    run.land(landing_frame(ev.where(~early)))
    # what the streams wrote, from their small per-batch file manifests (no raw scan)
    pending = L.backlog(run.files(), ingested_file_table(spark, run.layout, specs), "path")
    return pending.groupBy("collection").agg(F.count(F.lit(1)).alias("backlog_files"))


def file_epoch(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    k = F.pmod(F.col("o_orderkey"), F.lit(3))
    path = (F.when(k == 0, F.format_string("/landing/collection=orders/%013d_orders_%s.parquet",
                                           ms, F.col("o_orderstatus")))
            .when(k == 1, F.format_string("/landing/collection=orders/%d_orders.parquet", ms))
            .otherwise(F.format_string("/landing/%013d_day/part-%d.parquet", ms, F.col("o_orderkey"))))
    return o.select("o_orderkey", path.alias("path")).withColumn("file_epoch_ms", N.file_epoch_ms("path"))


def _part_names(spark, sf_dir):
    p = _table(spark, sf_dir, "part")
    name = F.concat_ws("_", F.lower("p_type"),
                       F.regexp_replace(F.lower("p_brand"), "brand#", "b"),
                       F.col("p_size").cast("string"))
    names = p.select("p_partkey", name.alias("name"))
    types = p.select(F.lower("p_type").alias("t"), "p_type").distinct()
    parents = (types.where(F.col("p_type") != "PROMO").select(F.col("t").alias("parent"),
                                                             F.lit("low").alias("tier"))
               .unionByName(types.select(F.concat("t", F.lit("_b1")).alias("parent"),
                                         F.lit("high").alias("tier")))
               .distinct())
    return names, parents


def longest_prefix_owner(spark, sf_dir):
    names, parents = _part_names(spark, sf_dir)
    return O.owners(names, parents, "name").select("p_partkey", "name", "owner")


def tier_lookup(spark, sf_dir):
    names, parents = _part_names(spark, sf_dir)
    owned = O.owners(names, parents, "name")
    return O.with_tier_params(owned, O.tiers_frame(spark)).select(
        "p_partkey", "owner", "tier", "max_files", "interval_seconds")


def shard_membership(spark, sf_dir):
    c = _table(spark, sf_dir, "customer")
    n = _table(spark, sf_dir, "nation")
    names = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", F.concat_ws("_", F.lower("n_name"), F.lower("c_mktsegment")).alias("name"))
    parents = n.select(F.lower("n_name").alias("parent"), F.lit("high").alias("tier"))
    owned = O.owners(names, parents, "name")
    return O.shard_assignment(owned, 3).select("c_custkey", "owner", "shard_index")


def _doc_topics(spark, sf_dir):
    d = _table(spark, sf_dir, "documents")
    tier = F.when(F.col("lang") == "en", "high").when(F.col("lang") == "de", "medium").otherwise("low")
    topic = F.when(F.pmod(F.col("doc_id"), F.lit(2)) == 0, F.concat(F.lit("shop."), F.col("source"))) \
             .otherwise(F.col("source"))
    return d.select(topic.alias("topic"), tier.alias("tier"), F.col("doc_id").alias("position"),
                    F.lit(0).alias("origin"))


def topic_conflicts(spark, sf_dir):
    c = O.tier_conflicts(_doc_topics(spark, sf_dir))
    return c.select("collection", F.array_join("tiers", ",").alias("tiers"), "n_tiers")


def topic_dedupe(spark, sf_dir):
    return O.dedupe_topics(_doc_topics(spark, sf_dir)).select("collection", "topic", "tier", "position")


def name_normalise(spark, sf_dir):
    p = _table(spark, sf_dir, "pages")
    coll = N.collection_of("url")
    return p.select("page_id", coll.alias("collection"),
                    N.table_name(coll).alias("table_name"),
                    N.safe_name(coll).alias("safe_name"),
                    N.trim_topic(F.concat(F.lit("  "), F.col("url"), F.lit("\t"))).alias("trimmed"))


def _month_durations(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return (o.groupBy("o_orderpriority", F.date_trunc("month", F.col("o_orderdate")).alias("m"))
            .agg((F.sum(cents) / F.lit(100.0)).alias("duration")))


def makespan_projection(spark, sf_dir):
    return makespan(_month_durations(spark, sf_dir), ["o_orderpriority"], "duration")


def ceil_rounds_by_nation(spark, sf_dir):
    c = _table(spark, sf_dir, "customer")
    n = _table(spark, sf_dir, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey).select("n_name")
    return ceil_rounds(j, ["n_name"])


def _attempts(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    kind = (F.when((F.col("event_type") == "purchase") & (F.col("value") >= 250), "ok")
            .when(F.col("event_type").isin("error", "view"), "genuine")
            .otherwise("schema_evolution"))
    return e.select(F.concat(F.lit("stream_"), F.col("user_id").cast("string")).alias("collection"),
                    F.col("event_id").alias("attempt"), kind.alias("kind"),
                    F.col("value").alias("ran_seconds"))


def restart_verdicts(spark, sf_dir):
    return restart_verdict(_attempts(spark, sf_dir))


def failure_kind(spark, sf_dir):
    d = _table(spark, sf_dir, "documents")
    k = F.pmod(F.col("doc_id"), F.lit(4))
    msg = (F.when(k == 0, F.concat(F.col("text"), F.lit(" [UnknownFieldException]")))
           .when(k == 1, F.concat(F.lit("error: new_fields_in_record_with_file_path "), F.col("text")))
           .when(k == 2, F.concat(F.lit("unknownfieldexception "), F.col("text")))
           .otherwise(F.col("text")))
    return d.select("doc_id", N.failure_kind(msg).alias("kind"), N.clean_message(msg).alias("message"),
                    N.clean_message(msg, None).alias("whole_message"))


def landing_names(spark, sf_dir):
    """The partition folder and the file name of each order, were it landed by day."""
    o = _table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    ms = N.midnight_epoch_ms(day)
    part = N.day_partition_values(day)
    name = N.landing_file_name(ms, F.lower("o_orderstatus"), F.dayofyear(day), F.pmod("o_orderkey", F.lit(120)),
                               F.when(F.col("o_totalprice") > 100000, "csv").otherwise("parquet"))
    return o.select("o_orderkey", *[v.alias(k) for k, v in part.items()], ms.alias("midnight_ms"), name.alias("file_name"))


def error_texts(spark, sf_dir):
    """Errors put together as measurement rows hold them: parts joined and cut, one more added
    to a text that may be missing."""
    d = _table(spark, sf_dir, "documents")
    parts = F.array("source", "text", F.when(F.col("lang") != "en", F.col("lang")))
    before = F.when(F.pmod("doc_id", F.lit(2)) == 0, F.col("text"))
    return d.select("doc_id", N.join_errors(parts).alias("joined"), N.append_error(before, "source").alias("appended"))


QUERIES = {
    "raw_rows_by_collection": raw_rows_by_collection,
    "drain_outcomes": drain_outcomes,
    "drain_outcome_counts": drain_outcome_counts,
    "raw_content": raw_content,
    "csv_header_drift": csv_header_drift,
    "evolved_columns": evolved_columns,
    "frozen_schema_rescue": frozen_schema_rescue,
    "rescued_values": rescued_values,
    "rescued_type_pairs": rescued_type_pairs,
    "lineage": lineage,
    "priority_and_shard": priority_and_shard,
    "measured_fallback": measured_fallback,
    "listing_tree": listing_tree,
    "results_append": results_append,
    "late_files": late_files,
    "steady_state_increment": steady_state_increment,
    "rate_limited_batches": rate_limited_batches,
    "batch_details_json": batch_details_json,
    "batch_rows_json": batch_rows_json,
    "drain_projection": drain_projection,
    "listing_stats": listing_stats,
    "run_summary": run_summary,
    "results_cast": results_cast,
    "format_detection": format_detection,
    "resolve_collections": resolve_collections,
    "backlog_anti": backlog_anti,
    "file_epoch": file_epoch,
    "longest_prefix_owner": longest_prefix_owner,
    "tier_lookup": tier_lookup,
    "shard_membership": shard_membership,
    "topic_conflicts": topic_conflicts,
    "topic_dedupe": topic_dedupe,
    "name_normalise": name_normalise,
    "makespan": makespan_projection,
    "ceil_rounds": ceil_rounds_by_nation,
    "restart_verdict": restart_verdicts,
    "failure_kind": failure_kind,
    "ingest_batches": ingest_batches,
    "drain_wave_log": drain_wave_log,
    "compacted_content": compacted_content,
    "hostile_tree": hostile_tree,
    "failed_outcomes": failed_outcomes,
    "resolution_split": resolution_split,
    "measured_times": measured_times,
    "landing_names": landing_names,
    "error_texts": error_texts,
}

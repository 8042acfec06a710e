"""Landing-zone listing as a DataFrame, and everything computed from it: collection
discovery, format detection, listing statistics, mixed-format directories, backlog.

The driver lists the day folders only; tasks walk them, first for the collection folders, then
for the files of each. What they find is written once as a snapshot in the shared work folder
and read from there, so no file status is held by the driver, and nothing is listed twice."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions import names as N
from ..session import new_run_dir, ship_package
from . import storage

LAYOUT_RE = (r"/" + re.escape(config.LANDING_SOURCE_SEGMENT) +
             r"/year=([^/]+)/month=([^/]+)/day=([^/]+)/database=([^/]+)/collection=([^/]+)/([^/]+)$")

LISTING_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("year", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("day", T.StringType()),
    T.StructField("database", T.StringType()),
    T.StructField("collection", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("dir", T.StringType()),
    T.StructField("file_format", T.StringType()),
    T.StructField("strict_format", T.StringType()),
])


def escape_glob(s: str) -> str:
    """Escape Hadoop glob metacharacters in a literal path part."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", s)


def landing_glob(root: str, database: str = "*", collection: str = "*", pattern: str = "*") -> str:
    return (f"{root.rstrip('/')}/{config.LANDING_SOURCE_SEGMENT}/year=*/month=*/day=*/"
            f"database={database}/collection={collection}/{pattern}")


def source_glob(root: str, database: str, collection: str, fmt: str, gz: bool = False) -> str:
    """Exact-collection glob: the trailing '/*.<fmt>' keeps 'transactions' from matching
    'transactions_statuslogs'; ``gz`` adds the gzip variant with a brace glob."""
    ext = f"{{{fmt},{fmt}.gz}}" if gz else fmt
    return landing_glob(root, escape_glob(database), escape_glob(collection), f"*.{ext}")


def source_folders(root: str, database: str, collection: str) -> str:
    """Glob of a collection's folders, one a day. A stream over them lists a folder at a time and takes
    the files directly in it; over :func:`source_glob` it would look up each file on its own."""
    return landing_glob(root, escape_glob(database), escape_glob(collection)).rsplit("/", 1)[0]


SNAPSHOT_SCHEMA = "path string, length long, modificationTime timestamp, error string"
#: Files a directory walk leaves out, as Spark's own listings do.
_HIDDEN = ("_", ".")


def _entries(fs, folder: str) -> list:
    """What lies directly in a folder, hidden names left out."""
    import pyarrow.fs as pafs

    return [f for f in fs.get_file_info(pafs.FileSelector(folder)) if not f.base_name.startswith(_HIDDEN)]


def _walk(root: str, entries, depth: int):
    """Rows (path, length, modificationTime, error) of what lies ``depth`` folders below each given
    path (relative to ``root``): folders by name pattern for two levels, files for one. A folder
    that can't be listed is a row with its error."""
    import pyarrow as pa

    from .landing_writer import resolve_fs

    patterns = {2: ("database=", "collection="), 1: ("",)}[depth]

    def run(batches):
        fs, base, _ = resolve_fs(root)
        for batch in batches:
            rows = []
            for path, error in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if error is not None:
                    rows.append((path, None, None, error))
                    continue
                now = [path]
                for level, prefix in enumerate(patterns, 1):
                    below = []
                    for folder in now:
                        try:
                            found = entries(fs, f"{base.rstrip('/')}/{folder}")
                        except Exception as e:
                            rows.append((folder, None, None, str(e) or type(e).__name__))
                            continue
                        for f in found:
                            if f.is_file and depth == 1:
                                rows.append((f"{folder}/{f.base_name}", f.size, (f.mtime_ns or 0) // 1000, None))
                            elif not f.is_file and depth > 1 and f.base_name.startswith(prefix):
                                below.append(f"{folder}/{f.base_name}")
                    now = below
                if depth > 1:
                    rows += [(p, None, None, None) for p in now]
            cols = list(zip(*rows)) or [()] * 4
            kinds = (pa.string(), pa.int64(), pa.timestamp("us", tz="UTC"), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["path", "length", "modificationTime", "error"])
    return run


def scan_landing(spark: SparkSession, root: str, database: str | None = None, year: str = "*", month: str = "*",
                 day: str = "*", collection: str | None = None) -> DataFrame:
    """The snapshot of a listing: one row for each landed file (LISTING_SCHEMA, ``error`` null) and
    one for each folder that can't be listed, with its error and the segments it has."""
    from .landing_writer import resolve_fs

    root = storage.qualify(spark, root).rstrip("/")
    days = storage.folders(spark, f"{root}/{config.LANDING_SOURCE_SEGMENT}/year={year}/month={month}/day={day}")
    snapshot = new_run_dir(spark, "listing")
    if days:
        ship_package(spark)
        width = spark.sparkContext.defaultParallelism
        try:
            resolve_fs(root)
        except Exception:  # a scheme that only Spark's readers open: day by day, so that the driver holds one at a time
            for d in days:
                (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(escape_glob(d))
                 .select("path", "length", "modificationTime", F.lit(None).cast("string").alias("error"))
                 .write.mode("append").parquet(snapshot))
        else:
            top = spark.createDataFrame([(d[len(root) + 1:], None, None, None) for d in days], SNAPSHOT_SCHEMA)
            folders = top.repartition(min(len(days), width)).mapInArrow(_walk(root, _entries, 2), SNAPSHOT_SCHEMA)
            folder = F.regexp_extract("path", "/database=([^/]+)/collection=([^/]+)$", 1)
            name = F.regexp_extract("path", "/collection=([^/]+)$", 1)
            mine = F.col("error").isNotNull() | ((F.lit(True) if database is None else folder == database)
                                                 & (F.lit(True) if collection is None else name == collection))
            (folders.where(mine).repartition(width, "path").mapInArrow(_walk(root, _entries, 1), SNAPSHOT_SCHEMA)
             .withColumn("path", F.concat(F.lit(f"{root}/"), "path")).write.parquet(snapshot))
    files = spark.read.schema(SNAPSHOT_SCHEMA).parquet(snapshot) if days else spark.createDataFrame([], SNAPSHOT_SCHEMA)
    p = F.col("path")
    segments = {n: F.regexp_extract(p, rf"/{n}=([^/]+)", 1) for n in ("year", "month", "day", "database", "collection")}
    out = (files.where(p.rlike(LAYOUT_RE) | F.col("error").isNotNull()).withColumns(segments)
           .withColumn("file_name", F.when(F.col("error").isNull(), F.regexp_extract(p, "([^/]+)$", 1)))
           .withColumn("dir", F.regexp_replace(p, r"/[^/]+$", ""))
           .withColumn("file_format", N.format_suffix("file_name", allow_gzip=True))
           .withColumn("strict_format", N.format_suffix("file_name", allow_gzip=False)))
    if database:
        out = out.where((F.col("database") == database) | F.col("error").isNotNull())
    if collection:
        out = out.where(F.col("collection") == collection)
    return out.select(*LISTING_SCHEMA.fieldNames(), "error")


def list_landing(spark: SparkSession, root: str, database: str | None = None,
                 year: str = "*", month: str = "*", day: str = "*", collection: str | None = None) -> DataFrame:
    """One row per landed file: path, length, modificationTime, the layout segments, the
    collection directory and the file format (lenient and strict suffix rules).
    Of one ``collection`` only, if given. ``year`` / ``month`` / ``day`` are glob patterns of the partition directories (for
    example ``day="{0[1-9],1[0-5]}"``): only matching directories are listed at all. Raises if a folder can't be listed."""
    found = scan_landing(spark, root, database, year, month, day, collection)
    if bad := found.where("error is not null").first():
        raise OSError(f"cannot list {bad.path}: {bad.error}")
    return found.drop("error")


def discover_collections(files: DataFrame) -> DataFrame:
    """Distinct collection names over all days (parents and children alike)."""
    return files.select("collection").distinct()


def has_files(df: DataFrame) -> bool:
    """Existence probe: one row is enough."""
    return not df.limit(1).isEmpty()


def detect_formats(files: DataFrame, allow_gzip: bool = False) -> DataFrame:
    """Per collection: 'parquet' if any Parquet file exists, else 'csv' if any CSV file,
    else NULL. One aggregation replaces one probe job per collection."""
    fmt = F.col("file_format") if allow_gzip else F.col("strict_format")
    agg = files.groupBy("collection").agg(
        F.max(fmt == "parquet").alias("_has_parquet"), F.max(fmt == "csv").alias("_has_csv"))
    return agg.select("collection",
                      F.when(F.col("_has_parquet"), "parquet")
                      .when(F.col("_has_csv"), "csv").alias("format"))


def collections_once(files: DataFrame) -> DataFrame:
    """(collection, format) of every collection, from one pass over the listing; the small result
    is written to the shared work folder, so what reads it doesn't list again."""
    path = f"{new_run_dir(files.sparkSession, 'collections')}/formats"
    detect_formats(files, allow_gzip=False).write.parquet(path)
    return files.sparkSession.read.parquet(path)


def tree_metrics(files: DataFrame) -> dict:
    """Year / month / day directory counts and tree depth from one aggregate row.
    Empty directories are invisible to a file listing."""
    r = files.agg(F.count_distinct("year").alias("y"),
                  F.count_distinct("year", "month").alias("m"),
                  F.count_distinct("year", "month", "day").alias("d")).first()
    y, m, d = (r.y or 0), (r.m or 0), (r.d or 0)
    depth = 3 if d else (2 if m else (1 if y else 0))
    return {"year_dirs": y, "month_dirs": m, "day_dirs": d, "partition_tree_depth": depth}


def listing_stats(files: DataFrame, selected: DataFrame, listing_seconds: float = 0.0,
                  tree: dict | None = None) -> DataFrame:
    """Per selected collection: format (lenient rule), files and bytes of that format, its largest file,
    collection directories checked, tree metrics; status OK. Collections without files get
    zero counts and a NULL format."""
    tree = tree or tree_metrics(files)
    fmt = F.col("file_format")
    per = files.groupBy("collection").agg(
        F.max(fmt == "parquet").alias("_p"), F.max(fmt == "csv").alias("_c"),
        F.count_if(fmt == "parquet").alias("_np"), F.count_if(fmt == "csv").alias("_nc"),
        F.sum(F.when(fmt == "parquet", F.col("length"))).alias("_bp"),
        F.sum(F.when(fmt == "csv", F.col("length"))).alias("_bc"),
        F.max(F.when(fmt == "parquet", F.col("length"))).alias("_lp"),
        F.max(F.when(fmt == "csv", F.col("length"))).alias("_lc"),
        F.count_distinct("dir").alias("collection_dirs_checked"))
    chosen = F.when(F.col("_p"), "parquet").when(F.col("_c"), "csv")
    stats = per.select(
        "collection", chosen.alias("format"),
        F.when(F.col("_p"), F.col("_np")).when(F.col("_c"), F.col("_nc")).otherwise(0).alias("file_count"),
        F.coalesce(F.when(F.col("_p"), F.col("_bp")).when(F.col("_c"), F.col("_bc")), F.lit(0)).cast("bigint").alias("total_bytes"),
        F.when(F.col("_p"), F.col("_lp")).when(F.col("_c"), F.col("_lc")).alias("largest_bytes"),
        "collection_dirs_checked")
    out = selected.select("collection").join(stats, "collection", "left")
    return out.select(
        "collection",
        F.lit("OK").alias("listing_status"),
        F.lit(None).cast("string").alias("listing_error"),
        F.lit(float(listing_seconds)).alias("listing_seconds"),
        F.lit(tree["partition_tree_depth"]).cast("bigint").alias("partition_tree_depth"),
        F.lit(tree["year_dirs"]).cast("bigint").alias("year_dirs_walked"),
        F.lit(tree["month_dirs"]).cast("bigint").alias("month_dirs_walked"),
        F.lit(tree["day_dirs"]).cast("bigint").alias("day_dirs_walked"),
        F.coalesce("collection_dirs_checked", F.lit(0)).cast("bigint").alias("collection_dirs_checked"),
        F.coalesce("file_count", F.lit(0)).cast("bigint").alias("file_count"),
        F.coalesce("total_bytes", F.lit(0)).cast("bigint").alias("total_bytes"),
        "largest_bytes", "format")


def listing_error_stats(errors: DataFrame, listing_seconds: float = 0.0) -> DataFrame:
    """(collection, error) of collections that can't be listed: ERROR, with unknown (NULL) counts."""
    return errors.select(
        "collection", F.lit("ERROR").alias("listing_status"),
        F.substring("error", 1, config.LISTING_ERROR_CHARS).alias("listing_error"),
        F.lit(float(listing_seconds)).alias("listing_seconds"),
        *[F.lit(0).cast("bigint").alias(c) for c in
          ("partition_tree_depth", "year_dirs_walked", "month_dirs_walked", "day_dirs_walked",
           "collection_dirs_checked")],
        F.lit(None).cast("bigint").alias("file_count"),
        F.lit(None).cast("bigint").alias("total_bytes"),
        F.lit(None).cast("bigint").alias("largest_bytes"),
        F.lit(None).cast("string").alias("format"))


def mixed_format_dirs(files: DataFrame) -> DataFrame:
    """Collection directories holding both Parquet and CSV files (strict suffix rule):
    Parquet wins there and the CSV files are never ingested."""
    return (files.where(F.col("strict_format").isNotNull())
            .groupBy("collection", "dir")
            .agg(F.count_distinct("strict_format").alias("n_formats"),
                 F.count_if(F.col("strict_format") == "csv").alias("csv_files"),
                 F.count_if(F.col("strict_format") == "parquet").alias("parquet_files"))
            .where(F.col("n_formats") > 1))


def normalize_path(path) -> "F.Column":
    """Comparable form of a file URI: URL-decoded, 'file:///x' and 'file:/x' alike."""
    decoded = F.url_decode(F.col(path) if isinstance(path, str) else path)
    return F.regexp_replace(decoded, r"^([a-zA-Z][a-zA-Z0-9+.-]*):/+", "$1:///")


def backlog(files: DataFrame, ingested_paths: DataFrame, path_col: str = "_source_file") -> DataFrame:
    """Files not ingested yet: listing rows without a matching ingested path."""
    done = ingested_paths.select(normalize_path(path_col).alias("_k")).distinct()
    return (files.withColumn("_k", normalize_path("path"))
            .join(done, "_k", "left_anti").drop("_k"))

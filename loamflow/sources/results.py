"""Measurement results: typed schema, append, JSON-lines write and read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names as N

_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()

MEASUREMENT_FIELDS = [
    ("collection", _S), ("listing_status", _S), ("listing_error", _S), ("listing_seconds", _D),
    ("partition_tree_depth", _L), ("year_dirs_walked", _L), ("month_dirs_walked", _L),
    ("day_dirs_walked", _L), ("collection_dirs_checked", _L), ("file_count", _L),
    ("total_bytes", _L), ("format", _S), ("status", _S), ("micro_batches", _L),
    ("rows_seen", _L), ("query_start_seconds", _D), ("query_stop_seconds", _D),
    ("drain_seconds", _D), ("total_drain_wall_seconds", _D), ("batch_details_json", _S),
    ("error", _S),
]
RUN_FIELDS = [("run_id", _S), ("mode", _S), ("measured_at_utc", T.TimestampType()),
              ("full_set_wall_seconds", _D), ("discovery_seconds", _D)]

MEASUREMENT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in MEASUREMENT_FIELDS])
RESULTS_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in MEASUREMENT_FIELDS + RUN_FIELDS])


def append_results(df: DataFrame, path: str) -> None:
    """Append typed result rows to a Parquet dataset (new columns are read back with
    ``mergeSchema``)."""
    df.write.mode("append").parquet(path)


def append_results_table(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Append to a catalog table ``[catalog.]schema.table``, creating the schema when
    missing; new columns are added to the table before the append."""
    parts = table.split(".")
    if len(parts) >= 2:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {'.'.join(parts[:-1])}")
    if spark.catalog.tableExists(table):
        have = {f.name.lower() for f in spark.table(table).schema.fields}
        new = [f for f in df.schema.fields if f.name.lower() not in have]
        if new:
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
        df.select(*spark.table(table).columns).write.insertInto(table)
    else:
        df.write.format("parquet").saveAsTable(table)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_results_json(df: DataFrame, path: str) -> None:
    """JSON lines with explicit nulls (an all-NULL column still appears); timestamps as
    ISO text."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def read_results_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read JSON-lines results. Without a schema the types are inferred, so every
    '*_seconds' column is forced to double (an all-NULL column would infer otherwise) and
    ``measured_at_utc`` becomes a timestamp."""
    if schema is not None:
        return spark.read.schema(schema).json(path)
    df = N.cast_seconds_to_double(spark.read.json(path))
    if "measured_at_utc" in df.columns:
        df = df.withColumn("measured_at_utc", F.try_to_timestamp(F.col("measured_at_utc")))
    return df

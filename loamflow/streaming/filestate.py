"""File state: which landed files belong to which batch of which collection.

One pass plans for all collections: the listing's snapshot is anti-joined with the files that
were planned before, the rest is ranked by age within its collection and cut into batches of
the tier's file cap, and each batch becomes one small Parquet file,
``name=<table>/batch=<number>/``. A collection's stream reads these files, one a trigger, so
what Spark's file source remembers is one entry a batch, whatever the number, age or
modification times of the landed files, and no trigger lists the landing zone.

A planning run that is cut short leaves whole batch files only; the files it didn't get to are
planned again, under later numbers."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config
from ..sources import storage
from ..sources.landing import list_landing

if TYPE_CHECKING:
    from .ingest import CollectionSpec, Layout

PLAN_SCHEMA = "path string, length long"
STATE_SCHEMA = f"{PLAN_SCHEMA}, name string, batch string"


def planned_files(spark: SparkSession, layout: Layout) -> DataFrame:
    """(path, length, name, batch) of every file that some batch holds."""
    if not storage.exists(spark, layout.plan_root):
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).parquet(layout.plan_root)


def plan_files(spark: SparkSession, layout: Layout, specs: list[CollectionSpec], files: DataFrame | None = None) -> None:
    """Plan the landed files of these collections that no batch holds yet. A file belongs to the
    collection of its folder and the exact suffix of its format (with ``.gz`` if the layout
    says so)."""
    for s in specs:
        storage.make_folder(spark, layout.plan_path(s.name))
    files = files if files is not None else list_landing(spark, layout.source_root, layout.database)
    want = spark.createDataFrame([(s.collection, s.name, f".{s.fmt}", s.max_files) for s in specs],
                                 "collection string, name string, suffix string, max_files int")
    ends = F.expr("endswith(file_name, suffix)" + " or endswith(file_name, concat(suffix, '.gz'))" * layout.gz)
    state = planned_files(spark, layout)
    fresh = (files.join(want, "collection").where(ends)
             .select("name", "path", "length", "modificationTime", "max_files")
             .join(state.select("name", "path"), ["name", "path"], "left_anti"))
    after = state.groupBy("name").agg((F.max(F.col("batch").cast("long")) + 1).alias("after"))
    # a collection's new paths go to one task, which ranks them and writes its batches in order,
    # so that their files' times are in order, too
    place = F.row_number().over(Window.partitionBy("name").orderBy("modificationTime", "path")) - 1
    number = F.coalesce("after", F.lit(0)) + F.floor(F.col("place") / F.col("max_files"))
    (fresh.join(after, "name", "left").withColumn("place", place)
     .select("path", "length", "name", F.format_string("%012d", number).alias("batch"))
     .sortWithinPartitions("name", "batch", "path")
     .write.mode("append").partitionBy("name", "batch").parquet(layout.plan_root))


def batch_stream(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """Stream of (path, length), the files of one planned batch a trigger."""
    return (spark.readStream.schema(PLAN_SCHEMA).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", 1).option("maxFileAge", config.MAX_FILE_AGE)
            .parquet(layout.plan_path(name)))


def start_planner(spark: SparkSession, layout: Layout, specs: list[CollectionSpec], seconds: int) -> StreamingQuery:
    """One stream that plans for all collections every so many seconds, until it is stopped: the
    metadata stream of a continuous run. It keeps no state but the plan itself."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (clock.writeStream.queryName(f"plan_{abs(hash(layout)) % 10 ** 9}")
            .foreachBatch(lambda _, __: plan_files(spark, layout, specs))
            .trigger(processingTime=f"{int(seconds)} seconds").start())

"""The resolve plan: topics + landing listing -> one row per collection to ingest with its
owner, tier, batching parameters, format and shard. The listing is read once, into one row a
collection below the shared work folder; discovery and formats both come from that."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import ownership as O
from ..sources import landing as L


def table_name_collisions(resolved: DataFrame) -> DataFrame:
    """Distinct collections that share one table name (e.g. 'a-b' and 'a_b')."""
    return (resolved.groupBy("name").agg(F.array_sort(F.collect_set("collection")).alias("collections"))
            .where(F.size("collections") > 1))


def resolve(spark: SparkSession, source_root: str, database: str, topics: DataFrame | None = None,
            priority: str = "all", shard_count: int = 1, shard_index: int | None = 0,
            tiers: DataFrame | None = None, files: DataFrame | None = None,
            check: bool = True) -> DataFrame:
    """(collection, name, owner, tier, format, is_parent, from_fallback, shard_index,
    max_files, interval_seconds). ``format`` is NULL for a collection without files
    (skipped by the drain). ``shard_index=None`` annotates every shard instead of keeping one.
    Table-name collisions are checked where the specs are collected
    (``drain.specs_from_resolved``) or on demand with :func:`table_name_collisions`."""
    if shard_count < 1 or (shard_index is not None and not (0 <= shard_index < shard_count)):
        raise ValueError(f"shard_index={shard_index} must satisfy 0 <= shard_index < shard_count "
                         f"(shard_count={shard_count})")
    topics = topics if topics is not None else O.topics_frame(spark)
    if check:
        O.assert_no_tier_conflicts(topics)
    parents = O.parents_frame(topics, priority)
    files = files if files is not None else L.list_landing(spark, source_root, database)
    found = L.collections_once(files)
    selected, _fallback = O.select_collections(found, parents)
    sharded = O.shard_assignment(selected, shard_count)
    if shard_count > 1 and shard_index is not None:
        sharded = sharded.where(F.col("shard_index") == shard_index)
    out = (sharded.join(found, "collection", "left")
           .withColumn("name", N.table_name("collection")))
    out = O.with_tier_params(out, tiers if tiers is not None else O.tiers_frame(spark))
    out = out.select("collection", "name", "owner", "tier", "format", "is_parent",
                     "from_fallback", "shard_index", "max_files", "interval_seconds")
    return out


def resolution_counts(resolved: DataFrame) -> DataFrame:
    """Present / skipped split and format counts of one resolution."""
    return resolved.agg(
        F.count(F.lit(1)).alias("selected"),
        F.count_if(F.col("is_parent")).alias("parents"),
        F.count_if(~F.col("is_parent")).alias("children"),
        F.count_if(F.col("format").isNotNull()).alias("present"),
        F.count_if(F.col("format").isNull()).alias("skipped"),
        F.count_if(F.col("format") == "parquet").alias("parquet"),
        F.count_if(F.col("format") == "csv").alias("csv"))

"""Topics, parents, ownership, tiers and shards.

Ownership rule: a collection belongs to parent ``p`` when its name equals ``p`` or starts
with ``p + '_'``; the longest such parent wins. Instead of a theta join (which plans as a
nested-loop join) every candidate parent of a name is generated — the name itself and each
prefix that ends right before an '_' — and equi-joined with the parents, so the join
shuffles (or broadcasts, if Spark measures the parents side small) on the key like any
other equi-join. A name of k underscores has k + 1 candidates; nothing is capped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import names as N
from .scans import with_rank

TOPIC_SCHEMA = "topic string, tier string, position int"


def topics_frame(spark: SparkSession, rows=None, extra_rows=None) -> DataFrame:
    """Declared topics followed by extra topics: (topic, tier, position, origin).
    ``position`` orders declared before extra, then the given order."""
    rows = list(rows if rows is not None else config.default_topic_rows())
    extra = list(extra_rows or [])
    decl = spark.createDataFrame(rows, TOPIC_SCHEMA).withColumn("origin", F.lit(0))
    if extra:
        ext = spark.createDataFrame(extra, TOPIC_SCHEMA).withColumn("origin", F.lit(1))
        decl = decl.unionByName(ext)
    return decl


def _tier_rank(tier_col) -> "F.Column":
    expr = F.lit(len(config.TIER_ORDER))
    for i, t in reversed(list(enumerate(config.TIER_ORDER))):
        expr = F.when(tier_col == t, F.lit(i)).otherwise(expr)
    return expr


def with_canonical(topics: DataFrame, canonical: str = "collection_of") -> DataFrame:
    """Adds ``collection``: text after the first '.' (ingestion form) or the trimmed topic
    (measurement form)."""
    fn = N.collection_of if canonical == "collection_of" else N.trim_topic
    return topics.withColumn("collection", fn("topic"))


def tier_conflicts(topics: DataFrame, canonical: str = "collection_of") -> DataFrame:
    """Collections declared under more than one tier: (collection, tiers, n_tiers)."""
    t = with_canonical(topics, canonical)
    return (t.groupBy("collection")
            .agg(F.array_sort(F.collect_set("tier")).alias("tiers"))
            .withColumn("n_tiers", F.size("tiers"))
            .where(F.col("n_tiers") > 1))


def assert_no_tier_conflicts(topics: DataFrame, canonical: str = "collection_of") -> None:
    conflicts = tier_conflicts(topics, canonical)
    first = conflicts.orderBy("collection").first()
    if first:
        raise ValueError(
            f"{conflicts.count()} collection(s) are assigned to several tiers, first {first.collection!r} "
            f"({', '.join(first.tiers)}); a collection has one raw dataset and one checkpoint, so one tier")


def dedupe_topics(topics: DataFrame, canonical: str = "collection_of") -> DataFrame:
    """One row per canonical collection: the first in (origin, tier order, position, topic).
    The rows are first put together by topic, a hash aggregate of one number; only distinct
    topics meet the aggregate by the whole order."""
    t = (with_canonical(topics, canonical).groupBy("collection", "topic", "tier", "origin")
         .agg(F.min("position").alias("position")))
    order = F.struct("origin", _tier_rank(F.col("tier")), "position", "topic", "tier")
    return (t.groupBy("collection").agg(F.min(order).alias("f"))
            .select("collection", "f.topic", "f.tier", "f.position", "f.origin"))


def parents_frame(topics: DataFrame, priority: str = "all",
                  canonical: str = "collection_of") -> DataFrame:
    """(parent, tier) after de-duplication; ``priority`` other than 'all' keeps one tier
    before ownership is decided."""
    p = dedupe_topics(topics, canonical)
    if priority != "all":
        p = p.where(F.col("tier") == priority)
    return p.select(F.col("collection").alias("parent"), "tier")


def name_candidates(name_col: str = "name") -> "F.Column":
    """The name and every prefix of it that ends right before an '_'."""
    parts = F.split(F.col(name_col), "_", -1)
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, 1, i), "_"))


def owners(names: DataFrame, parents: DataFrame, name_col: str = "name") -> DataFrame:
    """``names`` + ``owner`` (longest parent p with name == p or name startswith p + '_',
    NULL when none) and ``tier`` (the owner's tier).

    Every matching candidate is a prefix of the name, so the longest match is just
    ``max(length)`` (a hash aggregate with a fixed-width buffer) and the owner is that
    many leading characters of the name; its tier comes from an equi-join on the parents."""
    p = parents.select(F.col("parent").alias("_cand"), F.col("tier").alias("_tier")) \
               .dropDuplicates(["_cand"])
    distinct_names = names.select(F.col(name_col).alias("_n")).distinct()
    cand = distinct_names.select("_n", F.explode(name_candidates("_n")).alias("_cand"))
    matched = cand.join(p.select("_cand"), "_cand", "left_semi")
    best = (matched.groupBy("_n").agg(F.max(F.length("_cand")).alias("_len"))
            .select("_n", F.expr("substring(_n, 1, _len)").alias("owner")))
    best = best.join(p.select(F.col("_cand").alias("owner"), F.col("_tier").alias("tier")),
                     "owner", "left")
    return names.join(best, names[name_col] == best["_n"], "left").drop("_n")


def select_collections(discovered: DataFrame, parents: DataFrame) -> tuple[DataFrame, bool]:
    """Owned discovered names; when discovery found nothing at all, the parents themselves
    (children are then not ingested). Returns (collection, owner, tier, is_parent,
    from_fallback) and whether the fallback was taken."""
    if discovered.limit(1).isEmpty():
        out = parents.select(F.col("parent").alias("collection"), F.col("parent").alias("owner"),
                             "tier", F.lit(True).alias("is_parent"),
                             F.lit(True).alias("from_fallback"))
        return out, True
    owned = owners(discovered.select(F.col("collection").alias("name")), parents, "name")
    out = (owned.where(F.col("owner").isNotNull())
           .select(F.col("name").alias("collection"), "owner", "tier",
                   (F.col("name") == F.col("owner")).alias("is_parent"),
                   F.lit(False).alias("from_fallback")))
    return out, False


def shard_assignment(selected: DataFrame, shard_count: int, owner_col: str = "owner") -> DataFrame:
    """Round-robin shards over the distinct owners in sorted order: i-th owner -> i % count; rows
    without an owner have no shard. The owners are ranked by ranges, not in one task; children
    follow their owner through an equi-join. One shard needs no ranks.
    Assignment moves when a new parent appears."""
    if int(shard_count) == 1:
        return selected.withColumn("shard_index", F.when(F.col(owner_col).isNotNull(), 0))
    ranked = with_rank(selected.select(owner_col).where(F.col(owner_col).isNotNull()).distinct(), [owner_col], "owner_rank")
    ranked = ranked.select(owner_col, F.pmod("owner_rank", F.lit(int(shard_count))).cast("int").alias("shard_index"))
    return selected.join(ranked, owner_col, "left")


def with_tier_params(df: DataFrame, tiers: DataFrame) -> DataFrame:
    """Attach (max_files, interval_seconds) by tier."""
    return df.join(tiers, "tier", "left")


def tiers_frame(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(list(rows or config.tier_rows()),
                                 "tier string, max_files int, interval_seconds int")

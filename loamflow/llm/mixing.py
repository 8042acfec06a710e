"""Mixing sources to target weights.

Documents get a hash-random key (MD5 of id and seed). Within each source the documents are
ordered by that key, a distributed prefix sum of their sizes is taken, and the order is cut
at the source's exact budget; a budget above the source's size repeats whole epochs first.

The prefix sum has two levels: documents fall into key ranges (leading hex digits of the
key), the ranges of a source are summed and prefix-summed, and each document adds the sum
within its own range. A source that holds a third of all rows is thereby spread over all
its ranges; no task sees more than one range of one source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Hex digits of the key that name its range: 16**3 ranges a source.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources``: one row a source (source, source_size). Adds weight and target.

    Weights repeat over the sources in code-point order, null last. The whole size is shared
    by weight; no target passes ``max_epochs`` times its source's size, and what a source
    can't take is shared again among the rest by weight. That fixed point is found directly:
    in ascending order of cap per weight, a source is full when sharing what is left over
    the weights left would exceed its cap. One row a source, never one a document, goes
    through these windows."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    s = (sources.withColumn("weight", w)
         .withColumn("cap", F.col("source_size") * F.lit(max_epochs))
         .withColumn("ratio", F.col("cap") / F.col("weight"))
         .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("weight_left", F.sum("weight").over(
             by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("total", F.sum("source_size").over(whole))
         .withColumn("level", (F.col("total") - F.col("cap_before")) / F.col("weight_left"))
         .withColumn("share", F.max(F.when(F.col("level") < F.col("ratio"), F.col("level")))
                     .over(whole)))
    return s.select("source", "source_size", "weight",
                    F.when(F.col("share").isNull() | (F.col("ratio") <= F.col("share")),
                           F.col("cap").cast("double"))
                    .otherwise(F.col("share") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix",
        range_digits: int = RANGE_DIGITS) -> DataFrame:
    """Mix whole ``docs`` (doc_id, source, text); returns doc_id, source, size, source_size,
    target, epochs (whole copies), taken (words taken, repeats counted).

    Each source's words taken add up to the floor of its target; the document at the cut
    gives its first words only. Documents of equal key are ordered by id, then size; rows
    equal in both are alike in the result. A null text has size 0 and is taken 0 times; a
    null id has the key of the empty string; a null source is a source, last in order. An
    empty table gives an empty result; a table without any word has targets 0."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":" + seed)))
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                    key.alias("key"),
                                    F.substring(key, 1, range_digits).alias("range")), "mix-sizes")
    ranges = sized.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")),
                             weights, max_epochs)
    before = (Window.partitionBy("source").orderBy("range")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = (ranges.withColumn("start", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
              .alias("r").join(targets.alias("t"),
                               F.col("r.source").eqNullSafe(F.col("t.source")))
              .select("r.source", "range", "start", "source_size", "target"))
    inside = (Window.partitionBy("source", "range").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = (placed.alias("d").join(
        starts.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))
        & (F.col("d.range") == F.col("s.range"))))
    budget = F.floor("target")
    rows = rows.select(
        "doc_id", "d.source", "size", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size")))
        .otherwise(F.lit(0)).cast("long").alias("epochs"),
        (F.col("start") + F.col("inside")).alias("before"))
    rest = F.floor("target") - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return rows.select("doc_id", "source", "size", "source_size", "target", "epochs",
                       (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"))


ORACLE_MIX = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix') AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM s),
r AS (SELECT *, (3 * source_size)::DOUBLE AS cap, (3 * source_size) / weight AS ratio FROM w),
l AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(3 * source_size) OVER (ORDER BY ratio, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY ratio, source NULLS LAST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r),
t AS (
  SELECT source, source_size, weight, cap, ratio,
         max(CASE WHEN level < ratio THEN level END) OVER () AS share FROM l),
g AS (
  SELECT source, source_size,
         CASE WHEN share IS NULL OR ratio <= share THEN cap ELSE share * weight END AS target
  FROM t),
p AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN floor(floor(g.target) / g.source_size) ELSE 0 END AS epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size,
          floor(target) - epochs * source_size - before)))::BIGINT AS taken
FROM p
"""

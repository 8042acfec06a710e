"""Drain projections: collection rounds and the greedy longest-first makespan.

Makespan (list scheduling, longest processing time first; Graham 1969): durations in
descending order, each added to the least-loaded of ``w`` slots (the first one on ties);
the answer is the largest slot load, 0.0 with no durations. Expressed as a grouped
aggregate with Spark higher-order functions — no UDF, no cross join: the worker counts are
generated per group with ``explode``.

LPT is sequential within a group, so one group's durations are folded in one task. In
the system this re-implements a group is one run's collections (config-bounded);
:func:`makespan` checks the largest group against ``max_group_items`` before folding and
refuses rather than dropping items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config

_LPT = ("array_max(aggregate({arr}, array_repeat(CAST(0.0 AS DOUBLE), {w}), "
        "(s, d) -> transform(s, (x, i) -> IF(i = array_position(s, array_min(s)) - 1, x + d, x))))")


def lpt_expr(arr_col: str, workers_col: str):
    """Makespan of a descending-sorted array of durations on ``workers_col`` slots."""
    return F.expr(_LPT.format(arr=arr_col, w=workers_col))


def ceil_rounds_expr(n_col: str, workers_col: str):
    """ceil(n / w), 0 when n = 0."""
    return F.when(F.col(n_col) == 0, F.lit(0)).otherwise(
        F.ceil(F.col(n_col) / F.col(workers_col))).cast("int")


def makespan(df: DataFrame, group_cols: list[str], duration_col: str,
             workers=config.PROJECTED_WORKERS, max_group_items: int | None = 1_000_000) -> DataFrame:
    """Per group and worker count: (max_workers, simple_ceil_collection_rounds,
    lpt_projected_full_drain_seconds). NULL durations are ignored."""
    d = F.col(duration_col).cast("double")
    if max_group_items is not None:
        biggest = (df.where(d.isNotNull()).groupBy(*group_cols).count()
                   .agg(F.max("count").alias("m")).first().m) or 0
        if biggest > max_group_items:
            raise ValueError(f"a group holds {biggest} durations; greedy makespan folds one "
                             f"group in one task (limit {max_group_items})")
    grouped = df.groupBy(*group_cols).agg(
        F.sort_array(F.collect_list(d), asc=False).alias("_ds"),
        F.count(d).alias("_n"))
    w = grouped.withColumn("max_workers", F.explode(F.array(*[F.lit(int(x)) for x in workers])))
    return w.select(*group_cols, "max_workers",
                    ceil_rounds_expr("_n", "max_workers").alias("simple_ceil_collection_rounds"),
                    lpt_expr("_ds", "max_workers").alias("lpt_projected_full_drain_seconds"))


def ceil_rounds(df: DataFrame, group_cols: list[str], workers=config.PROJECTED_WORKERS) -> DataFrame:
    """Per group and worker count: ceil(rows / w) with rows counted by a partial aggregate."""
    g = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
    w = g.withColumn("max_workers", F.explode(F.array(*[F.lit(int(x)) for x in workers])))
    return w.select(*group_cols, "max_workers",
                    F.col("_n").alias("collections"),
                    ceil_rounds_expr("_n", "max_workers").alias("simple_ceil_collection_rounds"))

"""Ranks over a whole order, without a window over the whole table.

``Window.orderBy(o)`` alone sorts every row in one task. Here rows are dealt into ranges of the
order; a range's first rank is the rows of all ranges before it, and only one row a range is
summed in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_run_dir


def with_rank(df: DataFrame, order: list[Column | str], out: str) -> DataFrame:
    """``df`` plus the rank (from 0) of each row in ``order``, without a window over the whole table:
    rows are dealt into ranges of the order and written to the work folder, each range is
    counted, and a row's rank is the rows of all ranges before its own plus its place in it.
    Rows equal in ``order`` fall into one range; make the order total where they are many."""
    part = f"{out}_part"
    path = new_run_dir(df.sparkSession, "rank")
    dealt = df.repartitionByRange(*order).withColumn(part, F.spark_partition_id())
    dealt.write.parquet(path)
    dealt = df.sparkSession.read.schema(dealt.schema).parquet(path)
    counts = dealt.groupBy(part).count()
    before = Window.partitionBy(F.lit(0)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(f"{out}_start"))
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    return (dealt.withColumn(out, place).join(F.broadcast(starts), part)
            .withColumn(out, F.col(f"{out}_start") + F.col(out)).drop(part, f"{out}_start"))

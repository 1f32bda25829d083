"""Ranks and running sums over a whole table, without sending the table to one task.

A table is range-partitioned by its order and written once; each partition numbers or sums its own rows, and the totals
of the partitions before it, one row each, are added by a broadcast join whose size is the number of partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.plans.session import written


def _with_totals(df: DataFrame, order: list[Column], value: Column) -> tuple[DataFrame, DataFrame]:
    spread = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked")
    totals = spread.groupBy("_part").agg(F.sum(value).alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return spread, totals.select("_part", before.alias("_before"))


def with_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with the number of each row in the total order, from 1. The order must leave no ties."""
    spread, before = _with_totals(df, order, F.lit(1))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return spread.withColumn(name, own).join(F.broadcast(before), "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before")


def with_sum_before(df: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """``df`` with the sum of a value over all rows before each row."""
    spread, before = _with_totals(df, order, value)
    own = F.coalesce(F.sum(value).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return spread.withColumn(name, own).join(F.broadcast(before), "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before")

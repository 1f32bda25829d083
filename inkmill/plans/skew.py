"""Joins against tables of counted keys, in which one key may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with a larger share of all rows is joined by broadcast; there can't be more than 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 2000


def join_counted(left: DataFrame, table: DataFrame, key: str, n: str, values: list[str]) -> DataFrame:
    """``left`` with the ``values`` of ``table``, whose column ``n`` counts the rows of ``left`` by ``key``.

    ``table`` must hold every key of ``left`` once and should be cheap to read again. Keys over HOT_SHARE never reach
    the shuffle, so no task gets a hot key; the broadcast side is bounded by the definition of hot."""
    total = table.agg(F.sum(n)).first()[0] or 0
    hot = table.where(F.col(n) > total * HOT_SHARE).select(key, F.struct(*values).alias("_found"))
    cold = table.where(F.col(n) <= total * HOT_SHARE).select(key, F.struct(*values).alias("_found"))
    marked = left.join(F.broadcast(hot), key, "left")
    rest = marked.where("_found IS NULL").drop("_found").join(cold, key)
    both = marked.where("_found IS NOT NULL").unionByName(rest)
    return both.select(*left.columns, *(F.col(f"_found.{v}").alias(v) for v in values))


def join_salted(left: DataFrame, right: DataFrame, key: str, by: str, salts: int = 16) -> DataFrame:
    """An inner join of a large left side with hot keys and a small right side: the rows of a key are spread over
    ``salts`` partitions by another column of theirs, and the right side is repeated for each."""
    a = left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    b = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b, [key, "_salt"]).drop("_salt")

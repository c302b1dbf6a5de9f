"""Ordered computations on keys of any size, in two levels.

Rows of a key are cut into stretches of their order; each stretch is a task's work, and what earlier stretches hand
on is one short row a stretch. So a key with most of the rows is as many tasks as it has stretches, and only the
short rows of a key are ordered together. Null keys are keys like any other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HELPERS = ("_key", "_cut")


def inside(*order: str) -> W:
    """The rows of a stretch in their order."""
    return W.partitionBy("_key", "_cut").orderBy(*order)


def stretched(rows: DataFrame, keys: list[str], cut: Column) -> DataFrame:
    """rows with _key and _cut, shuffled by both once; cut rises with the order of rows within a key."""
    key = F.struct(*keys) if keys else F.struct(F.lit(0))
    return rows.withColumn("_key", key).withColumn("_cut", cut).repartition("_key", "_cut")


def carried(rows: DataFrame, totals: list[Column], over: Callable[[W], list[Column]]) -> DataFrame:
    """Stretched rows with what over makes of the totals of the stretches of their key, in order of _cut."""
    per = rows.groupBy("_key", "_cut").agg(*totals)
    return rows.join(per.select("_key", "_cut", *over(W.partitionBy("_key").orderBy("_cut"))), ["_key", "_cut"])


def earlier(window: W) -> W:
    return window.rowsBetween(W.unboundedPreceding, -1)


def through(window: W) -> W:
    return window.rowsBetween(W.unboundedPreceding, 0)


def with_previous(rows: DataFrame, keys: list[str], cut: Column, order: list[str], value: Column, name: str) -> DataFrame:
    """rows with the value of the row before in order, also across stretches; null for the first of a key."""
    cut_rows = stretched(rows, keys, cut).withColumn("_value", F.struct(value.alias("v")))
    along = inside(*order)
    last = F.max_by("_value", F.struct(*order)).alias("_last")
    known = carried(cut_rows, [last], lambda w: [F.lag("_last").over(w).alias("_before")])
    return known.withColumn(name, F.coalesce(F.lag("_value").over(along), F.col("_before"))["v"]).drop(*HELPERS, "_value", "_before")


def with_running_sum(rows: DataFrame, keys: list[str], cut: Column, order: list[str], value: Column, name: str) -> DataFrame:
    """rows with the sum of value over the rows of their key up to them in order."""
    cut_rows = stretched(rows, keys, cut).withColumn("_value", value)
    known = carried(cut_rows, [F.sum("_value").alias("_all")], lambda w: [F.coalesce(F.sum("_all").over(earlier(w)), F.lit(0)).alias("_before")])
    return known.withColumn(name, F.col("_before") + F.sum("_value").over(through(inside(*order)))).drop(*HELPERS, "_value", "_before")

"""Fusion of ranked lists by id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _summed(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("_id").agg(F.sum("_score").alias("_score"))


def sum_fusion(lists: list[DataFrame]) -> DataFrame:
    """Scores added over all lists that have an id."""
    return _summed([p.select("_id", "_score") for p in lists])


def reciprocal_rank_fusion(lists: list[DataFrame], constant: int = 60, window: int = 10) -> DataFrame:
    """Sum of 1 / (constant + rank) over the lists; a list's best ``window`` rows are few, so one window ranks them."""
    order = Window.orderBy(F.desc("_score"), "_id")
    top = [p.select("_id", "_score").orderBy(F.desc("_score"), "_id").limit(window) for p in lists]
    return _summed([t.select("_id", (F.lit(1.0) / (F.lit(float(constant)) + F.row_number().over(order))).alias("_score")) for t in top])

"""Latest-wins merge of versioned rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest(rows: DataFrame, key: str = "_id", version: str = "_lsn") -> DataFrame:
    """The row with the largest version of each key; combined before the shuffle, so a hot key costs a row per task."""
    names = rows.columns
    top = rows.groupBy(key).agg(F.max_by(F.struct(*[f"`{n}`" for n in names if n != key]), version).alias("__row"))
    return top.select(*[F.col(key) if n == key else F.col("__row").getField(n).alias(n) for n in names])

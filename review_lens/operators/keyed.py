"""Upsert semantics over an append-only table."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, key: str, *newest_first) -> DataFrame:
    """The newest row of every key, by the given descending order.

    `row_number() = 1` lets the planner keep one row per key and task before
    the shuffle, so a key that holds a large share of the rows stays small.
    Rows without a key cannot be stored under one and are left out.
    """
    order = [F.col(c).desc() if isinstance(c, str) else c for c in newest_first]
    window = Window.partitionBy(key).orderBy(*order)
    return (
        rows.where(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(window))
        .where("_rank = 1")
        .drop("_rank")
    )


def comment_tie() -> Column:
    """Ranks the texts of versions that agree in time and label, at the cost of one pass over them.
    Every reader uses it, so that all see the same version, whether they read texts or not."""
    return F.xxhash64("comment")

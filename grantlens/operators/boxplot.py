"""Tukey box-plot statistics per group from value counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def box_stats(df: DataFrame, group: str, value: str, min_group: int, factor: float) -> DataFrame:
    """Hinges, median and whiskers of groups with at least min_group values.

    Values are first counted per (group, value). A running total of the counts
    then tells which rank range each value fills, so that no group is ever
    sorted row by row in one task.

    Hinges are Tukey's: with n values and d = floor((n + 3) / 2) / 2, the lower
    hinge is the value at rank d, the upper one at rank n + 1 - d; fractional
    ranks average their two neighbours. Whiskers are the extreme values within
    factor * (upper - lower) of the hinges.
    """
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    whole = W.partitionBy(group)
    running = whole.orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = (
        counts.withColumn("_last", F.sum("_n").over(running))
        .withColumn("_total", F.sum("_n").over(whole))
        .withColumn("_first", F.col("_last") - F.col("_n") + 1)
        .filter(F.col("_total") >= min_group)
        .withColumn("_depth", F.floor((F.col("_total") + 3) / 2) / 2)
    )

    def at_rank(rank: Column) -> Column:
        def pick(r: Column) -> Column:
            hit = r.between(F.col("_first"), F.col("_last"))
            return F.max(F.when(hit, F.col(value))).over(whole)

        return (pick(F.floor(rank)) + pick(F.ceil(rank))) / 2

    # Same partitioning throughout: the values are shuffled once.
    total, depth = F.col("_total"), F.col("_depth")
    hinged = ranked.select(
        group,
        value,
        total.alias("n"),
        at_rank(depth).alias("q1"),
        at_rank((total + 1) / 2).alias("median"),
        at_rank(total + 1 - depth).alias("q3"),
    )
    reach = factor * (F.col("q3") - F.col("q1"))
    fenced = hinged.withColumns(
        {"low_fence": F.col("q1") - reach, "high_fence": F.col("q3") + reach}
    )
    inside = F.when(F.col(value).between(F.col("low_fence"), F.col("high_fence")), F.col(value))
    return fenced.groupBy(group, "n", "q1", "median", "q3", "low_fence", "high_fence").agg(
        F.min(inside).cast("double").alias("low"), F.max(inside).cast("double").alias("high")
    )


def outliers(df: DataFrame, stats: DataFrame, group: str, value: str) -> DataFrame:
    """Rows beyond the fences of their group.

    `stats` holds one row per group; only its two fences travel.
    """
    fences = stats.select(group, "low_fence", "high_fence")
    beyond = (F.col(value) < F.col("low_fence")) | (F.col(value) > F.col("high_fence"))
    return df.join(fences, group).filter(beyond).select(group, value)

"""Row counts, stage counters and constraint checks as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlens.functions.numbers import count_where
from grantlens.operators.joins import keep_unknown


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table, by name."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, parts).orderBy("tbl")


def side_by_side(counts: DataFrame, names: dict[str, str]) -> DataFrame:
    """Turn table_counts rows into one row with a column per table."""
    return counts.agg(
        *[F.max(F.when(F.col("tbl") == tbl, F.col("n"))).alias(out) for tbl, out in names.items()]
    )


def stage_counters(stage: str, df: DataFrame, **conditions: Column) -> DataFrame:
    """(stage, counter, n): rows in total and rows per condition, in one pass."""
    names = ["rows", *conditions]
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[count_where(c).alias(name) for name, c in conditions.items()],
    )
    pairs = F.array(
        *[F.struct(F.lit(n).alias("counter"), F.col(n).alias("n")) for n in names]
    )
    return counted.select(F.lit(stage).alias("stage"), F.inline(pairs))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; empty when the key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def missing_keys(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNull())


def orphans(df: DataFrame, key: str, parent: DataFrame, unique: bool = False) -> DataFrame:
    """Rows whose non-NULL key has no parent."""
    return keep_unknown(df.filter(F.col(key).isNotNull()), key, parent, unique)


def constraint_report(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, violations) for named frames of offending rows."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(n).alias("check"), "violations")
        for n, df in checks.items()
    ]
    return reduce(DataFrame.union, parts)

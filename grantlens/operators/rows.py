"""Keep-one selection, surrogate keys and date-range filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grantlens.functions.flags import fiscal_years_of, within

FISCAL_YEAR = "fiscal_year"
# Marks a table whose rows stand for all transactions of a month.
ACTIONS = "n_actions"


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order, which should be total.

    Spark turns the row_number() = 1 filter into a group limit ahead of the
    shuffle: every task sends at most one row per key, so a hot key is cheap.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def whole_row_order(df: DataFrame, first: list[str] | None = None) -> list[Column]:
    """Ascending order over all columns, the named ones first."""
    head = list(first or [])
    return [F.col(c).asc_nulls_last() for c in [*head, *(c for c in df.columns if c not in head)]]


def check_months(df: DataFrame, *windows: tuple[dt.date, dt.date]) -> None:
    """Monthly rows cannot be cut within a month."""
    if ACTIONS in df.columns and any(day.day != 1 for window in windows for day in window):
        raise ValueError(f"monthly rows cannot answer for {windows}; take the transactions")


def in_window(df: DataFrame, day: str, window: tuple[dt.date, dt.date]) -> DataFrame:
    """Half-open date range; reads only its fiscal years where df has them."""
    check_months(df, window)
    condition = within(F.col(day), window)
    if FISCAL_YEAR in df.columns:
        condition = condition & F.col(FISCAL_YEAR).between(*fiscal_years_of(window))
    return df.filter(condition)


def in_any_window(df: DataFrame, day: str, *windows: tuple[dt.date, dt.date]) -> DataFrame:
    """Rows in at least one of the half-open ranges, in one scan of their fiscal years."""
    check_months(df, *windows)
    condition = within(F.col(day), windows[0])
    for window in windows[1:]:
        condition = condition | within(F.col(day), window)
    if FISCAL_YEAR in df.columns:
        bounds = [fiscal_years_of(w) for w in windows]
        years = sorted({y for first, last in bounds for y in range(first, last + 1)})
        condition = condition & F.col(FISCAL_YEAR).isin(years)
    return df.filter(condition)


def with_surrogate_key(
    df: DataFrame, name: str, buckets: int = 4096, chunk: int = 10_000
) -> DataFrame:
    """Number the rows 1..n by content, without putting them into one task.

    Equal rows are counted first and then cut into chunks of at most `chunk`
    copies, so a large group of copies travels as few rows. Chunks are hashed
    into buckets; the running total of at most `buckets` bucket sizes gives each
    bucket its first number, and a running total inside the bucket the rest, in
    order of the hash and, where that ties, of the columns.
    """
    columns = df.columns
    copies = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    done = F.col("_chunk") * chunk
    chunks = (
        copies.withColumn(
            "_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / chunk)))
        )
        .withColumn("_size", F.least(F.lit(chunk), F.col("_copies") - done))
        .withColumn("_hash", F.xxhash64(*columns, "_chunk"))
        .withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
        .drop("_copies")
    )
    totals = chunks.groupBy("_bucket").agg(F.sum("_size").alias("_total"))
    # One task, but never more than `buckets` rows; hence the broadcast, too.
    offsets = totals.select(
        "_bucket", (F.sum("_total").over(W.orderBy("_bucket")) - F.col("_total")).alias("_offset")
    )
    in_bucket = (
        W.partitionBy("_bucket")
        .orderBy("_hash", *columns, "_chunk")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    last = F.col("_offset") + F.sum("_size").over(in_bucket)
    numbers = F.sequence(F.col("_last") - F.col("_size") + 1, F.col("_last"))
    return (
        chunks.join(F.broadcast(offsets), "_bucket")
        .withColumn("_last", last)
        .withColumn(name, F.explode(numbers))
        .select(name, *columns)
    )

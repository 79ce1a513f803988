"""Exact distinct counts of any span of months, merged from stored sets.

Keys get dense numbers once. Each month keeps, per group, the set of numbers
that occur in it as bitmaps of 32,768 places; sets of several months are united
bit by bit. No count of a window reads the transactions again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.functions import flags
from grantlens.operators.rows import with_surrogate_key


def dense_ids(rows: DataFrame, key: str) -> DataFrame:
    """(key, id) for each non-NULL value of a key, ids from 1 without gaps."""
    return with_surrogate_key(rows.select(key).filter(F.col(key).isNotNull()).distinct(), "id").select(key, "id")


def monthly_sets(transactions: DataFrame, ids: DataFrame, by: str, key: str) -> DataFrame:
    """(month, by, bucket, members): the key's values of each month and group as bitmaps.

    Repetitions within a month are reduced before the ids are looked up. NULL
    groups and undated rows have sets of their own. Numbers are moved, not
    bitmaps: a bitmap begun in every task, however few its numbers, would make
    their bytes grow with the square of the rows. All months of a group and
    bucket meet in a task, which holds 32,768 numbers of each at most.
    """
    month = flags.month_of(F.col("action_date")).alias("month")
    once = transactions.filter(F.col(key).isNotNull()).select(month, by, key).distinct().join(ids, key)
    places = once.select(
        "month", by, F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("place")
    )
    met = places.repartition(by, "bucket")
    return met.groupBy("month", by, "bucket").agg(F.bitmap_construct_agg("place").alias("members"))


def distinct_in(
    sets: DataFrame, by: str, name: str, window: tuple[dt.date, dt.date] | None = None
) -> DataFrame:
    """(by, name): exact number of distinct keys per group in a half-open span of whole months, or ever."""
    if window and any(day.day != 1 for day in window):
        raise ValueError(f"sets are kept by month; {window} does not begin and end with one")
    some = sets.filter(flags.within(F.col("month"), window)) if window else sets
    united = some.groupBy(by, "bucket").agg(F.bitmap_or_agg("members").alias("members"))
    return united.groupBy(by).agg(F.sum(F.bitmap_count("members")).alias(name))

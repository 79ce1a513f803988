"""Join shapes that recur across plans, written so that hot keys stay cheap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_set(
    df: DataFrame, key: str, alias: str | None = None, unique: bool = False
) -> DataFrame:
    """Non-NULL values of a key, once each.

    Repeated values are reduced ahead of the shuffle. unique=True states that
    the key is one of the table's own keys, which saves that step.
    """
    keys = df.filter(F.col(key).isNotNull()).select(F.col(key).alias(alias or key))
    return keys if unique else keys.distinct()


def keep_known(df: DataFrame, key: str, known: DataFrame, unique: bool = False) -> DataFrame:
    """Rows whose key occurs in `known` (foreign-key filter). NULL keys drop."""
    return df.join(key_set(known, key, unique=unique), key, "left_semi")


def keep_unknown(df: DataFrame, key: str, known: DataFrame, unique: bool = False) -> DataFrame:
    """Rows that keep_known drops, those with a NULL key included."""
    return df.join(key_set(known, key, unique=unique), key, "left_anti")


def flag_known(
    df: DataFrame, key: str, known: DataFrame, flag: str, unique: bool = False
) -> DataFrame:
    """Boolean column: does the row's key occur in `known`? A NULL key does not."""
    keys = key_set(known, key, "_known", unique)
    joined = df.join(keys, F.col(key) == F.col("_known"), "left")
    return joined.withColumn(flag, F.col("_known").isNotNull()).drop("_known")


def distinct_counts(df: DataFrame, by: str, **keys: str) -> DataFrame:
    """Exact number of distinct non-NULL values per group, all keys in one scan.

    Rows without a group form one of their own. Values are reduced per task and
    spread by value before they are counted, so a large group is no hot key.
    """
    return df.groupBy(by).agg(*[F.count_distinct(key).alias(name) for name, key in keys.items()])


def null_unmatched(df: DataFrame, key: str, known: DataFrame, unique: bool = False) -> DataFrame:
    """Keep every row, but set keys that do not occur in `known` to NULL."""
    keys = key_set(known, key, "_known", unique)
    joined = df.join(keys, F.col(key) == F.col("_known"), "left")
    return joined.withColumn(key, F.col("_known")).drop("_known")


def left_join_fanout(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join where one key may own a large share of the RIGHT side.

    A left outer join can only split hot keys of its left side. The matched
    part is therefore an inner join, which splits either side, and the rest
    comes from an anti join against the distinct keys.
    """
    matched = left.join(right.filter(F.col(key).isNotNull()), key, "inner")
    unmatched = left.join(key_set(right, key), key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def list_values(listing: Column) -> Column:
    """Entries of a comma-separated list, as written and trimmed."""
    parts = F.split(listing, ",", -1)
    return F.array_union(parts, F.transform(parts, lambda entry: F.trim(entry)))


def flag_list_overlap(
    df: DataFrame, row_key: str, listing: str, values: DataFrame, value: str, flag: str
) -> DataFrame:
    """Boolean column: does any entry of the row's list occur among the values?

    Entries are exploded and equi-joined with the distinct values instead of
    testing every row against every value.
    """
    entries = df.select(row_key, F.explode(list_values(F.col(listing))).alias(value))
    hits = entries.join(key_set(values, value), value, "left_semi").select(row_key).distinct()
    return df.join(hits.withColumn(flag, F.lit(True)), row_key, "left").withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False))
    )

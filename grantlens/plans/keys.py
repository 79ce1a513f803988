"""Surrogate keys that survive reloads: an append-only register of natural keys.

with_surrogate_key numbers the rows of one load; the next load may number them
anew. Here a row keeps the id that its natural key got first, and new keys go on
from the highest id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grantlens.operators.rows import whole_row_order, with_surrogate_key

COPY = "copy"


def with_copy_number(rows: DataFrame, keys: list[str], chunk: int = 10_000) -> DataFrame:
    """Rows with a number 1, 2, ... among those of equal keys, in order of their columns.

    Equal rows travel as one and are dealt out again in chunks, so many copies
    are no load for one task.
    """
    columns = rows.columns
    distinct = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    order = W.partitionBy(*keys).orderBy(*whole_row_order(rows)).rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = distinct.withColumn("_last", F.sum("_copies").over(order))
    chunks = numbered.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / chunk))))
    first = F.col("_last") - F.col("_copies") + 1 + F.col("_chunk") * chunk
    last = F.least(F.col("_last"), first + chunk - 1)
    return chunks.hint("rebalance").select(*columns, F.explode(F.sequence(first, last)).alias(COPY))


def _same(keys: list[str], left: DataFrame, right: DataFrame) -> Column:
    """NULL equals NULL."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in [*keys, COPY]])


def empty_register(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    return rows.limit(0).select(*keys, F.lit(0).cast("bigint").alias(COPY), F.lit(0).cast("bigint").alias(name))


def new_keys(register: DataFrame, rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, copy, id) to append to the register, for keys it does not hold yet."""
    wanted = with_copy_number(rows.select(*keys), keys)
    fresh = wanted.join(register.select(*keys, COPY), _same(keys, wanted, register), "left_anti")
    highest = register.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    return with_surrogate_key(fresh, name).select(*keys, COPY, (F.col(name) + highest).alias(name))


def with_registered_key(rows: DataFrame, register: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows with the ids of the register, in the first column."""
    numbered = with_copy_number(rows, keys)
    found = numbered.join(register, _same(keys, numbered, register))
    return found.select(register[name], *[numbered[c] for c in rows.columns])

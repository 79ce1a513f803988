"""Sinks: Parquet, buckets, CSV, append, reload, counters of a write, seed rows and added columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantlens.operators.rows import keep_one, whole_row_order

# Shuffled bytes of a task that writes whole rows where they are: it sorts them by folder, in memory.
TASK_BYTES = "16m"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside merge shuffled rows to tasks of TASK_BYTES, unless the session names a size of its own."""
    if spark.conf.get(ADVISORY, None) is not None:
        yield
        return
    spark.conf.set(ADVISORY, TASK_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(ADVISORY)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    sort_by: list[str] | None = None,
    mode: str = "overwrite",
    rebalance: bool = True,
    counters: dict[str, Column] | None = None,
) -> dict[str, int]:
    """ZSTD Parquet. mode='overwrite' reloads the table, 'append' adds rows.

    With partition_by, rows are rebalanced on it first, so that every
    partition folder gets few, evenly sized files whatever its share of rows.
    rebalance=False saves that shuffle, for rows that arrive in the order of
    their partitions, such as feeds with a folder per year, and for tables so
    large that more files cost less than moving all rows once more.
    The result holds the number of rows and the given counters, of this write.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*([partition_by] if partition_by else []), *sort_by)
    df, seen = counted(df, counters)
    writer = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with nullcontext() if rebalance else small_tasks(df.sparkSession):
        writer.parquet(path)
    return seen.get


def counted(df: DataFrame, counters: dict[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """df with counters that the job which writes it fills on its way: rows, and sums of the given columns.

    Right ahead of a write they belong to its last stage, whose tasks count once
    each, however often one is tried.
    """
    seen = Observation()
    sums = [F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias(n) for n, c in (counters or {}).items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *sums), seen


def bucketed_table(
    spark: SparkSession, table: str, path: str, schema: T.StructType, key: str, buckets: int
) -> DataFrame:
    """The Parquet files below a path as a table of the session, clustered and sorted by a key."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet OPTIONS (compression 'zstd') "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def write_bucketed(
    df: DataFrame, table: str, path: str, key: str, buckets: int, counters: dict[str, Column] | None = None
) -> dict[str, int]:
    """Reload a table whose rows with one key share a file: later plans by that key shuffle nothing.

    One task writes a bucket, so keys that own a large share of the rows belong
    elsewhere. The result is that of write_parquet.
    """
    bucketed_table(df.sparkSession, table, path, df.schema, key, buckets)
    df, seen = counted(df.repartition(buckets, key), counters)
    df.write.insertInto(table, overwrite=True)
    df.sparkSession.catalog.refreshTable(table)
    return seen.get


def replace_partitions(df: DataFrame, path: str, partition_by: str, rebalance: bool = True) -> None:
    """Reload only the partitions that occur in df; the others stay as they are. rebalance is that of write_parquet."""
    writer = (
        (df.hint("rebalance", partition_by) if rebalance else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(partition_by)
    )
    with nullcontext() if rebalance else small_tasks(df.sparkSession):
        writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """CSV with a header; quotes inside a field are doubled.

    Compressed files take a fraction of the disk, but each is read by one task.
    """
    (
        df.write.mode(mode)
        .option("compression", compression)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", True)
        .option("emptyValue", "")
        .csv(path)
    )


def rows_to_seed(seed: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Seed rows whose key is not in the table yet, each key once; append these."""
    seed = keep_one(seed, [key], whole_row_order(seed))
    return seed.join(existing.select(key).distinct(), key, "left_anti")


def with_columns_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns that the schema has and df lacks, as typed NULLs."""
    have = {c.lower() for c in df.columns}
    added = {
        f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name.lower() not in have
    }
    return df.withColumns(added) if added else df

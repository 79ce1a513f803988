"""Tables that several plans read are computed once and written as Parquet.

A written table in a folder that all executors share cuts the lineage: losing
an executor later costs a re-read, not a re-run of the whole chain.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from grantlens.sources.readers import read_parquet
from grantlens.sources.writers import bucketed_table, write_bucketed, write_parquet

BUCKETS = "spark.grantlens.buckets"
WAREHOUSE = "spark.grantlens.warehouse"
CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Where this session stores its tables: a folder that all executors see.

    Named by spark.grantlens.warehouse, else spark.checkpoint.dir, else Spark's
    own warehouse setting. The last may be a folder of the driver's machine that
    nobody chose: with executors on other machines that is an error.
    """
    conf = spark.sparkContext.getConf()
    named = (spark.conf.get(k, None) or conf.get(k, None) for k in (WAREHOUSE, CHECKPOINT_DIR))
    folder = next((f for f in named if f), None) or _spark_warehouse(spark)
    return f"{folder.rstrip('/')}/grantlens/{spark.sparkContext.applicationId}"


def _spark_warehouse(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.sql.warehouse.dir")
    alone = re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master)
    if not alone and (folder.startswith("file:") or "://" not in folder):
        raise ValueError(
            f"{folder} may be a folder of one machine; name a folder that all executors see "
            f"in {WAREHOUSE} or {CHECKPOINT_DIR}"
        )
    return folder


@dataclass(frozen=True)
class TableSpec:
    """How to compute a table, and how to lay it out on disk."""

    build: Callable[[TableStore], DataFrame]
    partition_by: str | None = None
    sort_by: tuple[str, ...] = ()
    # Rows with one value of this column share a file.
    bucket_by: str | None = None
    # False for tables that are cheap to derive from their source each time.
    stored: bool = True
    # False for rows that arrive by partition: they are written where they are.
    rebalance: bool = True
    # Sums that the job which writes the table takes on its way.
    counters: dict[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class StoredTable:
    """Where a written table is, how it is laid out, and what its write counted."""

    name: str
    path: str
    schema: T.StructType
    bucket_by: str | None
    buckets: int | None
    counters: dict[str, int]

    def open(self, spark: SparkSession) -> DataFrame:
        if self.bucket_by:
            return bucketed_table(spark, catalog_name(self.path), self.path, self.schema, self.bucket_by, self.buckets)
        return read_parquet(spark, self.path, self.schema)


def catalog_name(path: str) -> str:
    """A name for the files below a path in the session's catalog."""
    return f"grantlens_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def bucket_count(spark: SparkSession) -> int:
    """Buckets of clustered tables: spark.grantlens.buckets, else as many as a shuffle has partitions."""
    return int(spark.conf.get(BUCKETS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


class TableStore:
    """Named tables, each computed and written below `folder` on first use."""

    def __init__(self, spark: SparkSession, folder: str, specs: dict[str, TableSpec]):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.specs = specs
        self.written: dict[str, StoredTable] = {}
        self._tables: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            spec = self.specs[name]
            df = spec.build(self)
            if spec.stored:
                self.written[name] = self._write(name, spec, df)
                df = self.written[name].open(self.spark)
            self._tables[name] = df
        return self._tables[name]

    def _write(self, name: str, spec: TableSpec, df: DataFrame) -> StoredTable:
        path, buckets = self.path(name), None
        if spec.bucket_by:
            buckets = bucket_count(self.spark)
            counters = write_bucketed(df, catalog_name(path), path, spec.bucket_by, buckets, spec.counters)
        else:
            counters = write_parquet(
                df, path, spec.partition_by, list(spec.sort_by), rebalance=spec.rebalance, counters=spec.counters
            )
        return StoredTable(name, path, df.schema, spec.bucket_by, buckets, counters)

    def counters(self, name: str) -> dict[str, int]:
        """What the job that wrote a table counted: its rows, and the counters of its spec."""
        self.table(name)
        return self.written[name].counters

    def register_views(self, names: list[str], prefix: str = "") -> None:
        """Make tables visible to spark.sql under their own names."""
        for name in names:
            self.table(name).createOrReplaceTempView(prefix + name)

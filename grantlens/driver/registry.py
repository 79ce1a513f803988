"""Query registry and the per-session tables the queries read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from grantlens.config import DEFAULT_CONFIG
from grantlens.driver import adapter
from grantlens.driver.oracle import with_tables
from grantlens.plans import changes
from grantlens.plans.tables import table_specs
from grantlens.sources.store import TableSpec, TableStore, shared_folder

QueryFn = Callable[[TableStore], DataFrame]
CFG = DEFAULT_CONFIG

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query and, where SQL can express it, the SQL to check it with."""

    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return register


def table_specs_for(sf_dir: str) -> dict[str, TableSpec]:
    specs = table_specs(
        lambda spark: adapter.usaspending(spark, sf_dir),
        lambda spark: adapter.grants(spark, sf_dir),
        lambda spark: adapter.terminations(spark, sf_dir),
        CFG,
    )

    def change_log(s: TableStore) -> DataFrame:
        opportunities = s.table("opportunities")
        old, new = adapter.old_snapshot(opportunities), adapter.new_snapshot(opportunities)
        return changes.change_log(changes.diff_snapshots(old, new, 2, CFG))

    return {**specs, "change_log": TableSpec(change_log)}


_STORES: dict[tuple[str, str], TableStore] = {}


def store_for(spark: SparkSession, sf_dir: str) -> TableStore:
    """The session's tables for one input folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        folder = shared_folder(spark)
        label = "".join(c if c.isalnum() else "_" for c in sf_dir).strip("_")
        folder = f"{folder}/{label}"
        _STORES[key] = TableStore(spark, folder, table_specs_for(sf_dir))
    return _STORES[key]


def bind(fn: QueryFn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(store_for(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run

"""Versions of a set of tables, of which readers see the last complete one.

Each load writes its tables into a folder of its own and, when all are there,
one small manifest that names them. A reader goes by the newest manifest, so it
sees the tables of one load or of another, never a mixture; a load that breaks
off leaves the earlier tables as they are.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from grantlens.sources.store import StoredTable, TableSpec, TableStore

MANIFEST = (
    "version string, name string, path string, columns string, bucket_by string, buckets int, counters map<string, bigint>"
)


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """One row per table of every published version; none for a folder without any."""
    try:
        return spark.read.schema(MANIFEST).json(f"{folder.rstrip('/')}/manifests/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Published versions, oldest first. Folders of other versions belong to loads that broke off."""
    return sorted(r.version for r in manifests(spark, folder).select("version").distinct().collect())


def new_version(spark: SparkSession, folder: str) -> str:
    """A name that sorts behind all published ones; loads that run side by side get different ones."""
    last = max((int(v.split("-")[0]) for v in versions(spark, folder)), default=0)
    return f"{last + 1:08d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, folder: str, specs: dict[str, TableSpec], names: list[str]) -> TableStore:
    """Build the named tables in a new version below `folder`, then make it the current one.

    The manifest is a single file, which Spark moves to its place when it is
    complete. Nothing published before is touched.
    """
    folder = folder.rstrip("/")
    version = new_version(spark, folder)
    store = TableStore(spark, f"{folder}/versions/{version}", specs)
    for name in names:
        store.table(name)
    rows = [
        (version, t.name, t.path, json.dumps(t.schema.jsonValue()), t.bucket_by, t.buckets, t.counters)
        for t in store.written.values()
    ]
    manifest = spark.createDataFrame(rows, MANIFEST).coalesce(1)
    manifest.write.mode("error").json(f"{folder}/manifests/{version}")
    return store


def current(spark: SparkSession, folder: str, version: str | None = None) -> dict[str, StoredTable]:
    """The tables of the newest published version, or of the one named, by table name."""
    rows = manifests(spark, folder)
    if version is None:
        version = rows.agg(F.max("version")).first()[0]
    found = rows.filter(F.col("version") == F.lit(version)).collect()
    if not found:
        raise LookupError(f"no published tables in {folder}" + f" of version {version}" * bool(version))
    return {
        r.name: StoredTable(
            r.name, r.path, T.StructType.fromJson(json.loads(r.columns)), r.bucket_by, r.buckets, dict(r.counters)
        )
        for r in found
    }


def open_store(
    spark: SparkSession, folder: str, specs: dict[str, TableSpec] | None = None, version: str | None = None
) -> TableStore:
    """A store over published tables. Tables that only `specs` knows are computed as usual."""
    tables = current(spark, folder, version)
    at = next(iter(tables.values())).path.rsplit("/", 1)[0]
    opened = {n: TableSpec(lambda s, t=t: t.open(s.spark), stored=False) for n, t in tables.items()}
    store = TableStore(spark, at, {**(specs or {}), **opened})
    store.written.update(tables)
    return store

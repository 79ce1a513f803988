"""Reading inputs, tables in the shared folder, and batches inside tasks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Generator, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Text handed to one step inside a task; a longer document is a step of its own.
STEP_BYTES = 4 << 20
# Rows of a few numbers each that may be broadcast: some tens of megabytes.
BROADCAST_ITEMS = 500_000


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or if unset, Spark's own warehouse.

    The latter may be a folder of the driver's machine that nobody chose: with
    executors on other machines that is an error.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir")
    alone = re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master)
    if not alone and (folder.startswith("file:") or "://" not in folder):
        raise ValueError(f"{folder} may be a folder of one machine; name a folder that all executors see in {CHECKPOINT_DIR}")
    return folder.rstrip("/")


_WRITTEN: list[str] = []


def written() -> list[str]:
    """Folders of the tables that this driver has stored so far, for the caller to remove once results are safe."""
    return list(_WRITTEN)


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: its lineage ends there.

    The table stays until its owner removes it (written()): frames built on it
    are evaluated later.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(table: DataFrame, *weights: str, limit: int = BROADCAST_ITEMS) -> DataFrame:
    """A stored table, marked for broadcast if it has at most `limit` rows.

    weights name array columns whose elements count as rows. Beyond the limit
    the table is joined as Spark chooses, by a shuffle.
    """
    size = F.count("*")
    for column in weights:
        size = size + F.coalesce(F.sum(F.greatest(F.size(column), F.lit(0))), F.lit(0))
    return F.broadcast(table) if table.agg(size).first()[0] <= limit else table


def raw_text(column: str = "text") -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


def steps(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about STEP_BYTES of the column at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        part = np.cumsum(sizes.to_numpy(zero_copy_only=False)) // STEP_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            yield batch.slice(start, stop - start)


def map_steps(
    df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, object]], schema: str, column: str = "text"
) -> DataFrame:
    """Apply fn to record batches of bounded text size; it returns columns by name."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, column):
            made = fn(batch)
            yield pa.RecordBatch.from_arrays(
                [as_array(made[f.name], f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, schema)


def as_array(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values.cast(kind)
    return pa.array(values, type=kind)


def in_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.RecordBatch], dict[str, object]], schema: str, held_rows: int = 20_000, ask: Callable[[list], list] | None = None) -> DataFrame:
    """Apply fn to the rows of each group of neighbours with equal keys; it returns columns by name.

    Rows must be sorted by the keys within their partitions. A task holds about
    held_rows rows, or one group. With ask, fn may yield questions on its way:
    ask gets those of all groups held, and returns an answer to each.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def made(groups: list[dict[str, object]]) -> pa.RecordBatch:
        columns = [pa.chunked_array([as_array(g[f.name], f.type) for g in groups], type=f.type).combine_chunks() for f in arrow]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            values = [rows.column(k).to_numpy(zero_copy_only=False) for k in keys]
            new = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1
            cuts = [0, *new.tolist(), *([rows.num_rows] if last else [])]
            held = [] if last else [rows.slice(cuts[-1])]
            groups = [fn(rows.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])]
            groups = answered(groups, ask) if ask else groups
            if groups:
                yield made(groups)

        limit = held_rows
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(h.num_rows for h in held) >= limit:
                yield from flush(False)
                # A group that is not over yet is looked at again once it has doubled.
                limit = max(held_rows, 2 * sum(h.num_rows for h in held))
        if held:
            yield from flush(True)

    return df.mapInArrow(run, schema)


def answered(steps: list[Generator], ask: Callable[[list], list]) -> list[object]:
    """What each generator returns; the questions that they yield at a time are asked at once."""
    out: list[object] = [None] * len(steps)
    said: list[tuple[int, object]] = [(k, None) for k in range(len(steps))]
    while said:
        open_ = []
        for k, answer in said:
            try:
                open_.append((k, steps[k].send(answer)))
            except StopIteration as end:
                out[k] = end.value
        said = list(zip([k for k, _ in open_], ask([q for _, q in open_]))) if open_ else []
    return out


def pairs_in_groups(
    rows: DataFrame,
    key: str,
    spread: str,
    fn: Callable[[pa.RecordBatch, pa.RecordBatch, bool], dict[str, object] | Generator],
    schema: str,
    size: int,
    ask: Callable[[list], list] | None = None,
) -> DataFrame:
    """What fn returns of every two rows of one key, as columns by name.

    The rows of a key are dealt into parts of about `size` rows by the hash of
    the column `spread`, and any two parts meet in a task step of their own: all
    pairs are seen, whatever the size of the group, and none is held. fn gets
    the rows of both parts and whether they are one part, whose rows all meet.
    ask is as in in_groups().
    """
    parts = rows.groupBy(key).agg(F.ceil(F.count("*") / size).cast("int").alias("_parts"))
    dealt = rows.join(parts, key).withColumn("_part", F.pmod(F.xxhash64(spread), F.col("_parts")).cast("int"))
    cells = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    cells = cells.withColumns({"_low": F.least("_part", "_other"), "_high": F.greatest("_part", "_other")}).drop("_parts", "_other")
    keys = [key, "_low", "_high"]

    def run(cell: pa.RecordBatch) -> dict[str, object]:
        low, high = cell.column("_low")[0].as_py(), cell.column("_high")[0].as_py()
        if low == high:
            return fn(cell, cell, True)
        return fn(cell.filter(pc.equal(cell.column("_part"), low)), cell.filter(pc.equal(cell.column("_part"), high)), False)

    return in_groups(cells.repartition(*keys).sortWithinPartitions(*keys), keys, run, schema, ask=ask)

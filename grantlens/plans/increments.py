"""Roll-ups that follow a partitioned feed by reading only the partitions that changed.

For every partition of the source a state is kept, the partial result of its
rows, under a mark that tells the files it came from. A refresh compares marks,
builds the states of new and changed partitions, and then names the valid marks
in one small file. Until that file is there readers see the states of before.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from grantlens.operators.rows import FISCAL_YEAR
from grantlens.sources.readers import read_parquet

MARKS = "version bigint, part string, mark string"
# The partition of rows without a value.
NO_PART = "none"


def partition_marks(spark: SparkSession, path: str, partition_by: str = FISCAL_YEAR) -> dict[str, str]:
    """A digest of the names, sizes and times of each partition's files. Their content is not read."""
    files = spark.read.format("binaryFile").load(path)
    file = F.concat_ws(":", F.element_at(F.split("path", "/"), -1), "length", "modificationTime")
    marks = files.groupBy(F.coalesce(F.col(partition_by).cast("string"), F.lit(NO_PART)).alias("part")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(file)), ",").cast("binary"), 256).alias("mark")
    )
    return {r.part: r.mark for r in marks.collect()}


class PartitionStates:
    """States of a source's partitions below `folder`.

    build turns rows of one partition into its state. A state is valid for the
    files it was built from; states of partitions that are gone or were replaced
    stay on disk, but are not read any more.
    """

    def __init__(
        self, spark: SparkSession, folder: str, build: Callable[[DataFrame], DataFrame], partition_by: str = FISCAL_YEAR
    ):
        self.spark, self.build, self.partition_by = spark, build, partition_by
        self.folder = folder.rstrip("/")

    def marks(self) -> tuple[int, dict[str, str]]:
        """The newest version of the valid marks; version 0 before the first refresh."""
        try:
            rows = self.spark.read.schema(MARKS).json(f"{self.folder}/marks/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}
        newest = rows.agg(F.max("version")).first()[0]
        return newest, {r.part: r.mark for r in rows.filter(F.col("version") == newest).collect()}

    def refresh(self, source: str) -> list[str]:
        """Bring the states up to the source's files; returns the partitions that were read."""
        version, held = self.marks()
        now = partition_marks(self.spark, source, self.partition_by)
        changed = sorted(part for part, mark in now.items() if held.get(part) != mark)
        if now == held:
            return []
        if changed:
            rows = read_parquet(self.spark, source)
            states = [self._state(rows, part, now[part]) for part in changed]
            reduce(DataFrame.unionByName, states).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).option("compression", "zstd").partitionBy("part", "mark").parquet(f"{self.folder}/states")
        named = self.spark.createDataFrame([(version + 1, p, m) for p, m in sorted(now.items())], MARKS)
        named.coalesce(1).write.mode("overwrite").json(f"{self.folder}/marks/{version + 1:08d}")
        return changed

    def _state(self, rows: DataFrame, part: str, mark: str) -> DataFrame:
        value = F.col(self.partition_by)
        mine = rows.filter(value.isNull() if part == NO_PART else value.cast("string") == part)
        return self.build(mine.drop(self.partition_by)).withColumns({"part": F.lit(part), "mark": F.lit(mark)})

    def states(self) -> DataFrame:
        """The valid states of all partitions, with their partition as text in `part`."""
        version, marks = self.marks()
        if not version:
            raise LookupError(f"no states in {self.folder}: refresh them first")
        rows = self.spark.read.parquet(f"{self.folder}/states")
        valid = [f"{part}/{mark}" for part, mark in marks.items()]
        # Partition columns only: what is not valid is not opened.
        return rows.filter(F.concat_ws("/", F.col("part").cast("string"), "mark").isin(valid)).drop("mark")

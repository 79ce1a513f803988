"""Small fixed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, schema: T.StructType, rows: list[tuple]) -> DataFrame:
    """A table of literals, made inside the JVM from one row of constants."""

    def record(row: tuple) -> Column:
        return F.struct(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]
        )

    return spark.range(1).select(F.inline(F.array(*[record(r) for r in rows])))

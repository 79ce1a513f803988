"""Type profile of text feeds: what each column's values could be, against what is declared.

One pass counts, per file and column, how many values have each shape. The
counts of files add up, so profiles of any files merge; the type of a column is
the narrowest that all its values have.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Shapes of values, each a pattern or a test. A code is a number that would not
# survive as one: with leading zeros, or with the three places of listing codes.
WHOLE = r"^[+-]?[0-9]+$"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
CODE = r"^(0[0-9]+|[0-9]+\.[0-9]{3})$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
SHAPES = ("whole", "decimal", "code", "day", "truth")
# Types that declared ones count as.
FAMILIES = {"int": "bigint", "float": "double"}


def _has_shape(value: Column, shape: str) -> Column:
    return {
        "whole": value.rlike(WHOLE),
        "decimal": value.rlike(DECIMAL),
        "code": value.rlike(CODE),
        "day": value.rlike(DAY) & value.try_cast("date").isNotNull(),
        "truth": F.lower(value).isin("true", "false"),
    }[shape]


def shape_counts(rows: DataFrame, by: Column | None = None) -> DataFrame:
    """(file, column, n_values, n_whole, ...) of a frame of text columns; `by` tells files apart."""
    columns = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]
    if not columns:
        return rows.sparkSession.createDataFrame([], "file string, column string, " + ", ".join(f"n_{s} bigint" for s in ("values", *SHAPES)))
    file = (F.lit(None).cast("string") if by is None else by).alias("file")

    def counts(name: str) -> list[Column]:
        value = F.trim(name)
        shapes = [F.count_if(F.coalesce(_has_shape(value, s), F.lit(False))).alias(f"{name}#{s}") for s in SHAPES]
        return [F.count(name).alias(f"{name}#values"), *shapes]

    wide = rows.groupBy(file).agg(*[c for name in columns for c in counts(name)])
    cells = [
        F.struct(F.lit(name).alias("column"), *[F.col(f"`{name}#{s}`").alias(f"n_{s}") for s in ("values", *SHAPES)])
        for name in columns
    ]
    return wide.select("file", F.inline(F.array(*cells)))


def merged(*profiles: DataFrame) -> DataFrame:
    """The profile of all files together: one row per column."""
    sums = [F.sum(f"n_{s}").alias(f"n_{s}") for s in ("values", *SHAPES)]
    return reduce(DataFrame.unionByName, profiles).groupBy("column").agg(*sums)


def with_types(profile: DataFrame, declared: T.StructType) -> DataFrame:
    """Profile rows with the type their values allow, the declared one, and whether that loses nothing.

    Columns without values allow any type. Codes must be text, and text takes
    everything.
    """

    def all_are(shape: str) -> Column:
        return F.col(f"n_{shape}") == F.col("n_values")

    found = (
        F.when(F.col("n_values") == 0, F.lit(None).cast("string"))
        .when((F.col("n_code") > 0) & all_are("decimal"), "string")
        .when(all_are("whole"), "bigint")
        .when(all_are("decimal"), "double")
        .when(all_are("day"), "date")
        .when(all_are("truth"), "boolean")
        .otherwise("string")
    )
    names = F.create_map(*[F.lit(x) for f in declared.fields for x in (f.name.lower(), f.dataType.simpleString())])
    families = F.create_map(*[F.lit(x) for pair in FAMILIES.items() for x in pair])
    stated = F.try_element_at(names, F.lower("column"))
    family = F.coalesce(F.try_element_at(families, stated), stated)
    fits = F.col("found").isNull() | (family == "string") | (family == F.col("found")) | ((family == "double") & (F.col("found") == "bigint"))
    return (
        profile.withColumn("found", found).withColumn("declared", stated)
        .withColumn("is_code", (F.col("n_code") > 0) & all_are("decimal"))
        .withColumn("fits", F.coalesce(fits, F.lit(False)))
    )

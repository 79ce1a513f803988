"""CSV and Parquet scans with declared schemas."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_LINE = "_raw_line"
# Files whose headers are read at the same time, each by a job that ends at its first line.
HEADERS_AT_ONCE = 16
FILES = T.StructType([T.StructField("file", T.StringType())])


class CheckedScan(NamedTuple):
    """A CSV feed in four parts.

    rows: typed rows with the right number of fields; a field that does not
    parse is NULL. quarantine: the other rows, as text with their raw line.
    unreadable: (field, value, n), how often which text could not be read.
    left_out: (file), the files without a header line, which hold no rows.
    """

    rows: DataFrame
    quarantine: DataFrame
    unreadable: DataFrame
    left_out: DataFrame


def _csv_reader(spark: SparkSession, multi_line: bool, trim: bool = False) -> DataFrameReader:
    """trim passes over lines of white space only, which a reader of line breaks in fields else takes as rows."""
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("ignoreLeadingWhiteSpace", trim)
        .option("quote", '"')
        .option("escape", '"')
    )


def _header(spark: SparkSession, paths: str | list[str], multi_line: bool) -> tuple[tuple[str, ...], bool]:
    """The column names, and whether lines of white space stand before them."""
    names = tuple(_csv_reader(spark, multi_line).csv(paths).columns)
    if names and not "".join(names).strip():
        return tuple(_csv_reader(spark, multi_line, trim=True).csv(paths).columns), True
    return names, False


def _scan_text_columns(
    spark: SparkSession, paths: str | list[str], names: tuple[str, ...], multi_line: bool, trim: bool
) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, RAW_LINE]])
    return (
        _csv_reader(spark, multi_line, trim)
        .schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW_LINE)
        # A row's field count must be checked whatever columns a query selects.
        .option("columnPruning", False)
        # Files of one group must agree on their header instead of being
        # aligned by position.
        .option("enforceSchema", False)
        .csv(paths)
    )


def _complete(names: tuple[str, ...]) -> Column:
    """True for rows with the right number of fields.

    A raw line is never shorter than its own first field, so the comparison
    holds exactly for rows without a raw line. Naming a data column in it lets
    Spark run count() on a scan whose fields are all text.
    """
    return F.coalesce(F.length(RAW_LINE), F.lit(-1)) < F.coalesce(F.length(names[0]), F.lit(0))


def read_csv_checked(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    multi_line: bool = True,
) -> CheckedScan:
    """Tolerant CSV scan of files with one header: nothing vanishes.

    Fields are read as text and cast one by one, so an unreadable field costs
    its own value and not the row, and a row's fate does not depend on the
    columns a query selects. Columns are matched to the header by name;
    declared columns that the files lack become NULL, others are dropped.
    multi_line=True accepts line breaks in quoted fields, one task per file;
    set it to False for feeds without them, to split large files.
    """
    header, trim = _header(spark, paths, multi_line)
    wanted = {f.name.lower(): f for f in schema.fields}
    present = [wanted[n.lower()] for n in header if n.lower() in wanted]
    typed = [f for f in present if not isinstance(f.dataType, T.StringType)]

    scan = _scan_text_columns(spark, paths, header, multi_line, trim)
    complete = _complete(header)
    found = {f.name for f in present}
    texts = [
        (F.col(f.name) if f.name in found else F.lit(None).cast("string")).alias(f.name)
        for f in schema.fields
    ]
    columns = [
        text.try_cast(f.dataType).alias(f.name) for text, f in zip(texts, schema.fields)
    ]
    lost = [
        F.when(
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
            F.struct(F.lit(f.name).alias("field"), F.col(f.name).alias("value")),
        )
        for f in typed
    ]
    none = F.array().cast("array<struct<field: string, value: string>>")
    values = scan.filter(complete).select(
        F.inline(F.array_compact(F.array(*lost)) if lost else none)
    )
    return CheckedScan(
        scan.filter(complete).select(*columns),
        scan.filter(~complete).select(*texts, RAW_LINE),
        values.groupBy("field", "value").agg(F.count("*").alias("n")),
        spark.createDataFrame([], FILES),
    )


def read_csv_groups(
    spark: SparkSession,
    groups: Iterable[str | list[str]],
    schema: T.StructType,
    multi_line: bool = True,
    left_out: Iterable[str] = (),
) -> CheckedScan:
    """Union CSV groups by column name, each of files with one header.

    Groups may differ in column order and may lack columns, which become NULL.
    left_out names files that belong to no group.
    """
    scans = [read_csv_checked(spark, group, schema, multi_line) for group in groups]
    if not scans:
        raise ValueError("no CSV file with a header")

    def union(parts: list[DataFrame]) -> DataFrame:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    unreadable = union([s.unreadable for s in scans]).groupBy("field", "value")
    return CheckedScan(
        union([s.rows for s in scans]),
        union([s.quarantine for s in scans]),
        unreadable.agg(F.sum("n").alias("n")),
        spark.createDataFrame([(f,) for f in left_out], FILES),
    )


def read_csv_files(
    spark: SparkSession, paths: str | list[str], schema: T.StructType, multi_line: bool = True
) -> CheckedScan:
    """Like read_csv_groups, for folders whose files may each have their own header."""
    by_header = files_by_header(spark, paths, multi_line)
    left_out = [file for files in by_header.pop((), []) for file in files]
    groups = [files for some in by_header.values() for files in some]
    return read_csv_groups(spark, groups, schema, multi_line, left_out)


def files_below(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files that the paths name or hold. Their content is not read."""
    listed = spark.read.format("binaryFile").load(paths).select("path")
    return sorted(r.path for r in listed.collect())


def files_by_header(
    spark: SparkSession, paths: str | list[str], multi_line: bool = True
) -> dict[tuple[str, ...], list[list[str]]]:
    """Groups of files by their column names, for feeds whose layout drifts per file.

    Spark reads each file's header as it does for the scan itself: the first
    line that is not blank, whatever splits the file has. Data rows stay where
    they are. Files without such a line come under the empty header; files of
    no bytes are not listed at all.
    """
    files = files_below(spark, paths)
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        headers = list(pool.map(lambda file: _header(spark, file, multi_line), files))
    alike: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for header, file in zip(headers, files):
        alike.setdefault(header, []).append(file)
    groups: dict[tuple[str, ...], list[list[str]]] = {}
    for (names, _), some in alike.items():
        groups.setdefault(names, []).append(some)
    return groups


def header_groups(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> list[list[str]]:
    """The groups of files_by_header, without the files that have no header."""
    by_header = files_by_header(spark, paths, multi_line)
    return [files for header, groups in by_header.items() if header for files in groups]


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Parquet scan; a given schema saves the look into file footers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)

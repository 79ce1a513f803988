"""Type profile of text columns, and SQL functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantlens.functions.classify import CFDA_DIRECTORATES, TOPIC_RULES, directorate_of, topic_of
from grantlens.plans import sql
from grantlens.sources import profile
from tests.helpers import frame, records

PORTFOLIO = (
    "recipient_uei string, status string, obligated double, deobligated double, dir string, live_apr30 boolean, program string, "
    "fain string, project_title string, division string, terminated_on date, reinstated_on date, abstract string"
)
VALUES = {
    "a": ["1", "-20", None, " 3 "],
    "b": ["1.5", "2", "1e3", ".5"],
    "c": ["007", "1", None, None],
    "d": ["47.050", "47.070", "47.1", None],
    "e": ["2025-01-31", "2024-02-29", None, None],
    "f": ["2025-02-30", "2025-01-01", None, None],
    "g": ["true", "FALSE", None, None],
    "h": ["x", "1", "", None],
    "i": [None] * 4,
}
FOUND = {"a": "bigint", "b": "double", "c": "string", "d": "string", "e": "date", "f": "string", "g": "boolean", "h": "string", "i": None}


def text_frame(spark):
    rows = [{name: values[k] for name, values in VALUES.items()} for k in range(4)]
    return frame(spark, ", ".join(f"{n} string" for n in VALUES), rows)


def declared(kind):
    return T.StructType.fromDDL(", ".join(f"{n} {kind}" for n in VALUES if n != "h"))


def test_types_of_columns(spark):
    found = profile.with_types(profile.merged(profile.shape_counts(text_frame(spark))), declared("double"))
    got = {r.column: r for r in found.collect()}
    assert {n: r.found for n, r in got.items()} == FOUND
    assert {n for n, r in got.items() if r.is_code} == {"c", "d"}
    assert {n for n, r in got.items() if r.fits} == {"a", "b", "i"} and got["h"].declared is None
    assert all(r.fits for r in profile.with_types(profile.merged(profile.shape_counts(text_frame(spark))), declared("string")).collect() if r.column != "h")


def test_profiles_of_files_merge(spark):
    rows = text_frame(spark).withColumn("part", F.when(F.col("a").isNull(), "x").otherwise(F.lit("y")))
    parts = profile.shape_counts(rows.drop("part")).drop("file")
    split = [profile.shape_counts(rows.filter(f"part = '{p}'").drop("part")) for p in "xy"]
    by_file = profile.shape_counts(rows, F.col("part"))
    whole = records(profile.merged(profile.shape_counts(rows.drop("part"))), *parts.columns)
    assert records(profile.merged(*split), *parts.columns) == whole
    assert records(profile.merged(by_file).filter("column <> 'part'"), *parts.columns) == whole
    assert profile.shape_counts(rows.select(F.lit(1).alias("n"))).count() == 0


def test_sql_maps_equal_the_column_functions(spark):
    codes = [*CFDA_DIRECTORATES, "47.05", "x", "", None]
    titles = ["Climate teacher", "Quantum algorithms", "it's", None, "", *[p for _, p in TOPIC_RULES]]
    spark.createDataFrame([(c, None) for c in codes] + [(None, t) for t in titles], "c string, t string").createOrReplaceTempView("maps")
    sql.register_functions(spark, spark.createDataFrame([], PORTFOLIO))
    got = spark.table("maps").select("*", directorate_of(F.col("c")).alias("d"), topic_of(F.col("t")).alias("p"), F.expr("nsf_directorate(c) AS d2"), F.expr("nsf_topic(t) AS p2"))
    assert got.filter("d <> d2 OR p <> p2").count() == 0 and got.count() == len(codes) + len(titles)


@pytest.mark.parametrize("asked, n", [("ABC123DEF456", 2), ("ABC123DEF456,", 2), ("ABC123DEF456,XYZ123DEF456", 3), ("ABC123DEF456,abc", 0), ("", 0), ("' OR 1=1", 0)])
def test_table_functions_void_malformed_requests(spark, asked, n):
    rows = [("ABC123DEF456", "Active", 5.0), ("ABC123DEF456", "Terminated", 7.0), ("XYZ123DEF456", "Active", 1.0)]
    portfolio = spark.createDataFrame([(u, s, o, 0.0, "BIO", True, "p", "f", None, None, None, None, None) for u, s, o in rows], PORTFOLIO)
    sql.register_functions(spark, portfolio)
    assert spark.sql("SELECT * FROM institution_awards(:asked)", args={"asked": asked}).count() == n
    figures = spark.sql("SELECT * FROM institution_figures(:asked)", args={"asked": asked}).first()
    assert figures.n_total == n and "PythonUDF" not in spark.sql("SELECT * FROM institution_funding('')")._jdf.queryExecution().toString()


def test_a_request_is_read_once_and_not_for_every_row(spark):
    row = ("ABC123DEF456", "Active", 5.0, 0.0, "BIO", True, "p", "f", None, None, None, None, None)
    sql.register_functions(spark, spark.createDataFrame([row], PORTFOLIO))
    for name in ("awards", "funding", "figures", "losses", "largest_loss"):
        asked = spark.sql(f"SELECT * FROM institution_{name}('U00000000001,U00000000002,')")
        planned = asked._jdf.queryExecution().optimizedPlan().toString().lower()
        assert not any(f in planned for f in ("forall", "split", "rlike", "regexp_replace"))

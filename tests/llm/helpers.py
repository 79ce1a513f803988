"""Small document tables for operator tests."""

from __future__ import annotations

import pandas as pd

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, *texts, ids=None):
    rows = [
        (i if ids is None else ids[i], t, "en", "s", None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def table(name: str) -> pd.DataFrame:
    return pd.read_parquet(f"{SF}/{name}.parquet")


def clashing(df):
    """The frame with extra columns named like an operator's own."""
    from pyspark.sql import functions as F

    for name in ("fp", "mask", "key", "row", "src", "root", "score", "n_words", "component_id", "kept"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd

from grantlens.llm import quality
from tests.llm.helpers import SF, clashing, docs, table


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.op7_quality(spark, sf).toPandas()
    marks = pd.read_parquet(f"{sf}/labels.parquet")
    both = got.merge(marks, on="doc_id")
    held = both[both.held_out]
    assert len(got) == len(pd.read_parquet(f"{sf}/documents.parquet"))
    assert (held.predicted == held.quality).mean() > 0.95
    assert (held[held.quality == 1].predicted == 1).mean() > 0.97
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id] == got.held_out.tolist()


def test_neighbours_against_all_pairs(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    got = {r.doc_id: r.score for r in quality.scored(frame, model).collect()}
    want = table("documents")
    for i, text in list(zip(want.doc_id, want.text))[:40]:
        v = model.project(quality.term_counts(text.encode())[None])[0]
        near = model.vectors @ v
        top = np.argsort(-near)[: quality.NEIGHBOURS]
        w = np.maximum(near[top], 0)
        if near[np.argsort(-near)[quality.NEIGHBOURS]] < near[top[-1]] - 1e-6:
            assert abs(got[i] - (w * model.labels[top]).sum() / w.sum()) < 1e-4


def test_held_out_labels_do_not_matter(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    turned = marks.withColumn("quality", quality.F.when(quality.held_out(), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    a, b = quality.fit(frame, marks), quality.fit(frame, turned)
    assert (a.vectors == b.vectors).all() and (a.labels == b.labels).all()


def test_no_labels(spark):
    frame = docs(spark, "a", None)
    model = quality.fit(frame, labels(spark, [(1, None, 0), (None, 1, 0), (77, 1, 0)]))
    assert {r.score for r in quality.scored(frame, model).collect()} == {0.5}


def test_nulls_repeats_and_extra_columns(spark):
    frame = clashing(docs(spark, None, "", "word " * 9, "a b c d e f", "a b c d e f", ids=[1, 2, 3, None, None]))
    marks = labels(spark, [(1, 0, 0), (1, 1, 0), (2, 0, 0), (3, 1, 0), (3, 1, 0)])
    model = quality.fit(frame, marks)
    rows = quality.scored(frame, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert quality.accepted(frame, model, 0.0).columns == frame.columns
    assert quality.accepted(frame, model, 0.0).count() == 5 and quality.accepted(frame, model, 1.1).count() == 0
    assert quality.scored(frame.limit(0), model).count() == 0


def test_training_rows_are_bounded(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(quality.fit(frame, spark.read.parquet(f"{SF}/labels.parquet"), rows=20).labels) == 20

"""Quality scores by votes of the nearest labelled texts.

A text becomes counts of terms: pairs of neighbouring character classes, and a
few bins that say how much it repeats itself and how long its words are. Terms
are weighted by rarity and projected to the leading latent directions of the
labelled texts. The labelled vectors, of a fixed number at most, are broadcast;
each document is compared with all of them in blocks of exact cosine products,
and the nearest ones vote with their similarity as weight.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm.common import load, map_steps, raw_text, steps

# Bound of the labelled sample: the rows of smallest hash, all of them if fewer.
TRAIN_ROWS = 4000
DIRECTIONS = 32
NEIGHBOURS = 15
THRESHOLD = 0.3
BLOCK = 512
PART = 1 << 20

# One class for each of lower case, upper case, digits, space, line end, other
# control characters, bytes beyond ASCII, and each ASCII punctuation mark.
LOWER, UPPER, DIGIT, SPACE, LINE, CONTROL, WIDE, MARKS = range(8)
BINS = 12
# Shares of the text and the weight of their bins beside the character pairs.
SHARES = {
    "distinct words": 3,
    "distinct lines": 3,
    "repeated neighbours": 12,
    "top word": 3,
    "short words": 3,
    "long words": 3,
    "length": 3,
}


def _classes() -> bytes:
    out, mark = [], MARKS
    for b in range(256):
        c = chr(b)
        if b >= 128:
            out.append(WIDE)
        elif c.islower():
            out.append(LOWER)
        elif c.isupper():
            out.append(UPPER)
        elif c.isdigit():
            out.append(DIGIT)
        elif c == " ":
            out.append(SPACE)
        elif c == "\n":
            out.append(LINE)
        elif b < 32 or b == 127:
            out.append(CONTROL)
        else:
            out.append(mark)
            mark += 1
    return bytes(out)


CLASSES = _classes()
KINDS = max(CLASSES) + 1
TERMS = KINDS * KINDS + len(SHARES) * BINS


def term_counts(raw: bytes) -> np.ndarray:
    """Weights of the terms of one text: logs of counts per 1,000 characters, and bins."""
    out = np.zeros(TERMS, dtype=np.float32)
    pairs = np.zeros(KINDS * KINDS, dtype=np.int64)
    for at in range(0, len(raw) - 1, PART):
        kinds = np.frombuffer(raw[at : at + PART + 1].translate(CLASSES), dtype=np.uint8).astype(np.int32)
        pairs += np.bincount(kinds[:-1] * KINDS + kinds[1:], minlength=KINDS * KINDS)
    out[: len(pairs)] = np.log1p(pairs * (1000.0 / max(len(raw), 1)))
    words = raw.split()
    n = max(len(words), 1)
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    again = sum(map(bytes.__eq__, words, words[1:]))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    shares = (
        len(counts) / n,
        len(set(lines)) / max(len(lines), 1),
        again / n,
        max(counts.values(), default=0) / n,
        float((sizes <= 3).sum()) / n,
        float((sizes >= 12).sum()) / n,
        min(np.log10(1 + len(raw)) / 6, 1.0),
    )
    for k, (share, weight) in enumerate(zip(shares, SHARES.values())):
        # A share lies between two bins and counts for both in proportion.
        place = share * (BINS - 1)
        low = min(int(place), BINS - 2)
        base = KINDS * KINDS + k * BINS
        out[base + low] += weight * (low + 1 - place)
        out[base + low + 1] += weight * (place - low)
    return out


@dataclass(frozen=True)
class Model:
    """Term weights, latent directions, labelled vectors of length 1 and their labels."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        return unit((unit(counts * self.weights)) @ self.directions)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Similarity-weighted mean label of the nearest neighbours of each row."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        near = self.project(counts) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        at = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, at, axis=1), 0).astype(np.float64) + 1e-9
        return (weight * self.labels[at]).sum(axis=1) / weight.sum(axis=1)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return (rows / np.maximum(length, 1e-12)).astype(np.float32)


def packed(counts: np.ndarray) -> bytes:
    """Places and values of the counts that are not zero: a tenth of them, on their way to the driver."""
    at = np.flatnonzero(counts).astype(np.int32)
    return at.tobytes() + counts[at].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    half = len(raw) // 2
    out = np.zeros(TERMS, dtype=np.float32)
    out[np.frombuffer(raw[:half], dtype=np.int32)] = np.frombuffer(raw[half:], dtype=np.float32)
    return out


def held_out(column: str = "doc_id"):
    """Rows never used to fit; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Model from at most `rows` labelled texts outside the held-out fold.

    Several labels of one id are averaged, several texts of one id count as the
    smallest. Null labels and ids without a text are left out; without any
    labelled text every score is 0.5.
    """
    chosen = (
        labels.filter(~held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.avg("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = (
        docs.select("doc_id", raw_text().alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    )

    def run(batch):
        return {
            "doc_id": batch.column("doc_id"),
            "label": batch.column("label"),
            "counts": [packed(term_counts(t)) for t in batch.column("text").to_pylist()],
        }

    rows = map_steps(texts, run, "doc_id bigint, label double, counts binary").collect()
    rows.sort(key=lambda r: r.doc_id)
    scaled = np.zeros((len(rows), TERMS), dtype=np.float32)
    for i, row in enumerate(rows):
        scaled[i] = unpacked(row.counts)
    label = np.array([r.label for r in rows], dtype=np.float64)
    weights = np.log((1 + len(rows)) / (1 + (scaled > 0).sum(axis=0))).astype(np.float32) + 1
    del rows
    scaled *= weights
    scaled /= np.maximum(np.sqrt((scaled * scaled).sum(axis=1, keepdims=True)), 1e-12)
    values, vectors = np.linalg.eigh(scaled.T @ scaled)
    directions = np.ascontiguousarray(vectors[:, np.argsort(-values)[:DIRECTIONS]]).astype(np.float32)
    return Model(weights, directions, unit(scaled @ directions), label)


def scores_of(batch: pa.RecordBatch, model: Model) -> np.ndarray:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    out = [np.zeros(0)]
    for at in range(0, len(texts), BLOCK):
        out.append(model.score(np.array([term_counts(t or b"") for t in texts[at : at + BLOCK]])))
    return np.concatenate(out)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for each row; null and empty texts are scored like any other."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        return {"doc_id": batch.column("doc_id"), "score": scores_of(batch, shared.value)}

    return map_steps(docs.select("doc_id", raw_text().alias("text")), run, "doc_id bigint, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, whose score is the threshold or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            yield batch.filter(pa.array(scores_of(batch, shared.value) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = scored(docs, fit(docs, load(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, fit(docs, load(spark, sf_dir, "labels")))

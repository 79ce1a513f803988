"""Target-distribution importance resampling.

Texts are split by an untrained tokenizer part, a regex split that returns
words with offsets. Windows over those offsets are the features; a feature's
CRC picks its bucket. Bucket histograms of the corpus and of the target give a
gain per bucket, a document's weight is the sum of its features' gains, and
noise from a hash of its id turns a draw by weight into a top list.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm.common import load, map_steps, raw_text, saved

# Fixed values of the contract.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SIZES = (1, 1)
BUCKETS = 10_000
SEED = 2024
PERCENT = 10
MIN_WORDS = 20

# Characters split at once; a longer text is cut at separators.
PART = 1 << 18
KEPT_WORDS = 500_000


class _Buckets(dict):
    """Bucket of each feature seen lately."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[feature] = value = zlib.crc32(feature.encode()) % self.buckets
        return value


def splitter():
    """The pre-tokenizer: what lies between separators, with its offsets."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(SEPARATORS), "removed")


def parts(text: str) -> Iterator[str]:
    """Pieces of about PART characters that end at a separator; a longer word stays whole."""
    at, cut = 0, re.compile(SEPARATORS)
    while len(text) - at > PART:
        found = cut.search(text, at + PART)
        if not found:
            break
        yield text[at : found.start()]
        at = found.end()
    yield text[at:]


def features(text: str, split, sizes: tuple[int, int] = SIZES) -> Iterator[tuple[int, list[str]]]:
    """Per piece of a text in ASCII lower case: its number of words, and the features that end in it.

    A feature is a window over word offsets, from the first word's start to the
    last one's end, with one space for whatever separates its words.
    """
    low, high = sizes
    tail: list[str] = []
    for piece in parts(text):
        spans = [span for _, span in split.pre_tokenize_str(piece)]
        words = tail + [piece[a:b] for a, b in spans]
        made: list[str] = []
        for size in range(low, high + 1):
            first = max(0, len(tail) - size + 1)
            if size == 1:
                made += words[first:]
            else:
                made += [" ".join(words[i : i + size]) for i in range(first, len(words) - size + 1)]
        yield len(spans), made
        tail = words[len(words) - high + 1 :] if high > 1 else []


def bucket_counts(docs: DataFrame, sizes: tuple[int, int] = SIZES, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, place, n_words, n_features, buckets, counts) for each row of docs (doc_id, text).

    buckets and counts are little-endian 32-bit arrays of the row's filled
    buckets. place tells rows apart and follows the input's order.
    """

    def run(batch):
        split, bucket = splitter(), _Buckets(buckets)
        n_words, n_features, filled, counts = [], [], [], []
        for raw in batch.column("text").to_pylist():
            words, total, here = 0, 0, np.zeros(buckets, dtype=np.int64)
            for found, made in features(raw.lower().decode("utf-8", "replace"), split, sizes):
                words += found
                total += len(made)
                here += np.bincount(np.fromiter(map(bucket.__getitem__, made), np.int64, len(made)), minlength=buckets)
            at = np.flatnonzero(here)
            n_words.append(words)
            n_features.append(total)
            filled.append(at.astype("<u4").tobytes())
            counts.append(here[at].astype("<u4").tobytes())
        return {
            "doc_id": batch.column("doc_id"),
            "place": batch.column("place"),
            "n_words": n_words,
            "n_features": n_features,
            "buckets": filled,
            "counts": counts,
        }

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("place"), raw_text().alias("text"))
    schema = "doc_id bigint, place bigint, n_words bigint, n_features bigint, buckets binary, counts binary"
    return map_steps(rows, run, schema)


def histogram(counted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows of bucket_counts; each task sends its own sums only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for at, n in zip(batch.column("buckets").to_pylist(), batch.column("counts").to_pylist()):
                total[np.frombuffer(at, "<u4")] += np.frombuffer(n, "<u4")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    sums = counted.select("buckets", "counts").mapInArrow(run, "bucket bigint, n bigint")
    return sums.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket, from the two histograms."""
    both = (
        corpus.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
        .join(corpus.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", F.coalesce("s", F.lit(0)).cast("double").alias("s"), F.coalesce("t", F.lit(0)).cast("double").alias("t"))
    )
    both = saved(both, "histograms")
    all_s, all_t = both.agg(F.sum("s"), F.sum("t")).first()
    ratio = ((F.col("t") + 1) * F.lit(all_s + buckets)) / ((F.col("s") + 1) * F.lit(all_t + buckets))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weighed(counted: DataFrame, gain: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket_counts rows with weight, the sum of the gains of their features.

    The gains, one number per bucket, go to the driver and from there to all tasks.
    """
    table = np.zeros(buckets, dtype=np.int64)
    for row in gain.collect():
        table[row.bucket] = row.gain
    shared = counted.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("buckets").to_pylist(), batch.column("counts").to_pylist())
            weight = [int(shared.value[np.frombuffer(at, "<u4")] @ np.frombuffer(n, "<u4").astype(np.int64)) for at, n in pairs]
            kept = [batch.column(c) for c in ("doc_id", "place", "n_words", "n_features")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(weight, pa.int64())], names=["doc_id", "place", "n_words", "n_features", "weight"]
            )

    return counted.mapInArrow(run, "doc_id bigint, place bigint, n_words bigint, n_features bigint, weight bigint")


def noise(seed: int = SEED):
    """floor(-1000 ln(-ln u)), u from the first 32 bits of a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    first = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((first + 0.5) / 4294967296.0)))


def drawn(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows with rank 1, 2, ... for the highest scores among those with enough words, null for the rest.

    One range shuffle puts the rows in order. Places in the whole are places in
    the own part plus the sizes of the parts before: one number per part
    reaches the driver, never the rows.
    """
    able = (F.col("n_words") >= min_words).alias("able")
    order = [F.col("able").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("place")]
    ordered = scored.select("*", able).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = saved(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.count(F.when(F.col("able"), 1)).alias("n_able"))
    starts, before, n_able = [], 0, 0
    for row in sorted(sizes.collect()):
        starts.append((row.part, before))
        before += row.n
        n_able += row.n_able
    offsets = scored.sparkSession.createDataFrame(starts, "part bigint, before bigint")
    rank = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    return ordered.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn(
        "rank", F.when(F.col("able") & (rank <= percent * n_able // 100), rank)
    )


def resampled(
    docs: DataFrame,
    target: DataFrame,
    sizes: tuple[int, int] = SIZES,
    buckets: int = BUCKETS,
    seed: int = SEED,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for each row of docs (doc_id, text).

    target has a text column. Null and empty texts have no words, weight 0 and
    no rank. Equal scores rank by doc_id (null last; its noise is that of an
    empty id), repeated rows by their place. Empty tables give an empty result
    or, as a target, gains from the corpus alone.
    """
    counted = saved(bucket_counts(docs, sizes, buckets), "bucket-counts")
    wanted = bucket_counts(target.select(F.lit(None).cast("bigint").alias("doc_id"), "text"), sizes, buckets)
    gain = gains(histogram(counted, buckets), histogram(wanted, buckets), buckets)
    scored = weighed(counted, gain, buckets).withColumn("score", F.col("weight") + noise(seed))
    return drawn(scored, percent, min_words).select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampled(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


SQL = r"""
WITH crc AS (
  SELECT [list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, step:
      CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) FOR i IN range(256)] AS t
), d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM benchmark
), dn AS (
  SELECT doc_id, w, count(*) AS n FROM d GROUP BY ALL
), words AS (
  SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM dn UNION SELECT w FROM b)
), bytes AS (
  SELECT w, [CAST(4294967295 AS BIGINT)] || [CAST('0x' || x[2 * i - 1 : 2 * i] AS BIGINT)
      FOR i IN range(1, CAST(length(x) // 2 + 1 AS BIGINT))] AS v FROM words
), bucket AS (
  SELECT w, xor(list_reduce(v, lambda c, one: xor(c >> 8, t[xor(c, one) % 256 + 1])), 4294967295) % 10000 AS k
  FROM bytes, crc
), s AS (
  SELECT k, sum(n) AS s FROM dn JOIN bucket USING (w) GROUP BY k
), t AS (
  SELECT k, count(*) AS t FROM b JOIN bucket USING (w) GROUP BY k
), counts AS (
  SELECT k, CAST(coalesce(s, 0) AS DOUBLE) AS s, CAST(coalesce(t, 0) AS DOUBLE) AS t
  FROM (SELECT unnest(range(10000)) AS k) AS all_k LEFT JOIN s USING (k) LEFT JOIN t USING (k)
), gains AS (
  SELECT k, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS gain
  FROM counts
), weights AS (
  SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS weight
  FROM dn JOIN bucket USING (w) JOIN gains USING (k) GROUP BY doc_id
), scored AS (
  SELECT doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || doc_id), 8) AS BIGINT) + 0.5)
      / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""

"""Benchmark decontamination as a prefix-filtered set join.

An item gives windows of consecutive words, and a window gives shingles. A
document can hold a window only if it holds all its shingles, so the rarest
one, by counts over all documents, is the prefix to join on. Candidates must
start and end inside the document, and their words must equal the window's.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grantlens.llm.common import load, saved

WINDOW = 13
SHINGLE = 5
# Windows broadcast at a time; a larger benchmark is joined in several blocks.
BLOCK_WINDOWS = 100_000
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    """Words of a text with A-Z in lower case; a null text has none."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(1))


def shingle_hash(array: str, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(F.col(array), at + i) for i in range(size)])


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct (item_id, window, length): an item shorter than a window is one itself.

    Items without words or without an id give none.
    """
    items = benchmark.filter("item_id is not null").select("item_id", words("text").alias("words"))
    items = items.filter(F.size("words") > 0).withColumn("length", F.least(F.size("words"), F.lit(size)))
    each = items.select(
        "item_id", "words", "length", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("s")
    )
    return each.select(
        "item_id", F.array_join(F.slice("words", F.col("s"), F.col("length")), " ").alias("window"), "length"
    ).distinct()


def window_shingles(distinct: DataFrame, size: int) -> DataFrame:
    """(window, length, offset, hash) of all shingles of `size` words of windows (window, length)."""
    each = distinct.withColumn("words", F.split("window", " "))
    each = each.select(
        "window", "length", "words", F.explode(F.sequence(F.lit(0), F.col("length") - size)).alias("offset")
    )
    return each.select("window", "length", "offset", shingle_hash("words", F.col("offset"), size).alias("hash"))


def postings(docs: DataFrame, wanted: dict[int, DataFrame], reach: int) -> DataFrame:
    """Where wanted shingles stand, and one row (hash null) for each document row.

    wanted maps a shingle size to its distinct hashes. A posting carries the
    words up to `reach` before and after it, for the later comparison.
    """
    base = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), words("text").alias("words"))
    each = base.select("doc_id", "row", "words", F.posexplode_outer("words").alias("pos", "word"))
    parts = []
    for k, (size, hashes) in enumerate(wanted.items()):
        own = each.withColumn("hash", F.when(F.col("pos") + size <= F.size("words"), shingle_hash("words", F.col("pos"), size)))
        found = F.broadcast(hashes.select("hash", F.lit(size).alias("size")))
        joined = own.join(found, "hash", "left")
        first = F.coalesce(F.col("pos"), F.lit(0)) == 0
        rows = joined.filter(F.col("size").isNotNull() | (first & F.lit(k == 0)))
        parts.append(
            rows.select(
                "doc_id",
                "row",
                F.size("words").alias("n_words"),
                F.coalesce("pos", F.lit(0)).alias("pos"),
                F.when(F.col("size").isNotNull(), F.col("hash")).alias("hash"),
                "size",
                (F.lit(k == 0) & first).alias("own"),
                F.greatest(F.col("pos") - reach, F.lit(0)).alias("from"),
                F.when(
                    F.col("size").isNotNull(),
                    F.slice("words", F.greatest(F.col("pos") - reach, F.lit(0)) + 1, F.lit(2 * reach + 1)),
                ).alias("near"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def occurrences(
    docs: DataFrame, wins: DataFrame, size: int = WINDOW, shingle: int = SHINGLE, block: int = BLOCK_WINDOWS
) -> tuple[DataFrame, DataFrame]:
    """All rows of docs as (doc_id, row, n_words), and (row, window, start, length) of each occurrence."""
    distinct = saved(wins.select("window", "length").distinct(), "windows")
    blocks = max(1, -(-distinct.count() // block))
    rows, found = None, None
    for b in range(blocks):
        some = distinct.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b)
        sizes = [r.size for r in some.select(F.least("length", F.lit(shingle)).alias("size")).distinct().collect()]
        sizes = sorted(sizes, reverse=True) or [shingle]
        shingles = {
            s: window_shingles(some.filter(F.least("length", F.lit(shingle)) == s), s).withColumn("size", F.lit(s))
            for s in sizes
        }
        posted = saved(
            postings(docs, {s: t.select("hash").distinct() for s, t in shingles.items()}, size), "postings"
        )
        if rows is None:
            rows = posted.filter("own").select("doc_id", "row", "n_words")
        posted = posted.filter("hash is not null")
        counts = posted.groupBy("hash", "size").agg(F.count("*").alias("n"))
        every = shingles[sizes[0]]
        for s in sizes[1:]:
            every = every.unionByName(shingles[s])
        # A window whose rarest shingle is in no document occurs nowhere.
        rarest = (
            every.join(counts, ["hash", "size"], "left")
            .groupBy("window", "length", "size")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "offset")).alias("rare"))
            .filter("rare.n > 0")
            .select("window", "length", "size", "rare.hash", "rare.offset")
        )
        start = F.col("pos") - F.col("offset")
        here = (
            posted.join(F.broadcast(rarest), ["hash", "size"])
            .withColumn("start", start)
            .filter((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
            .filter(F.array_join(F.slice("near", F.col("start") - F.col("from") + 1, F.col("length")), " ") == F.col("window"))
            .select("row", "window", "start", "length")
        )
        found = here if found is None else found.unionByName(here)
    return rows, saved(found.distinct(), "window-hits")


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, shingle: int = SHINGLE, block: int = BLOCK_WINDOWS
) -> DataFrame:
    """(doc_id, row, n_words, n_hit, n_items, items) for each row of docs.

    n_hit counts the words inside any occurrence of a window, n_items and items
    the items with occurring windows (ids as sorted strings). A null text has no
    words. Repeated rows get the same result each, repeated items count once,
    and empty tables give an empty result or no hits.
    """
    wins = saved(windows(benchmark, size), "item-windows")
    rows, hits = occurrences(docs, wins, size, shingle, block)
    order = W.partitionBy("row").orderBy("start", "length").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    spans = hits.select("row", "start", "length").distinct().withColumn("seen", F.max(end).over(order))
    spans = spans.groupBy("row").agg(
        F.sum(F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce("seen", F.lit(0))))).alias("n_hit")
    )
    items = (
        hits.select("row", "window").distinct().join(wins.select("window", "item_id"), "window")
        .select("row", F.col("item_id").cast("string").alias("item")).distinct()
        .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    none = F.array().cast("array<string>")
    return (
        rows.join(spans.join(items, "row"), "row", "left")
        .select(
            "doc_id",
            "row",
            F.col("n_words").cast("bigint").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce("items", none).alias("items"),
        )
    )


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not contaminated, as they are."""
    found = contamination(docs, load(spark, sf_dir, "benchmark"))
    bad = saved(found.filter(contaminated()).select(F.col("row").alias("_row")).distinct(), "contaminated")
    rows = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    return rows.join(bad, "_row", "left_anti").select(*docs.columns)


SQL = r"""
WITH d AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM documents
), b AS (
  SELECT item_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM benchmark
), starts AS (
  SELECT item_id, w, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s
  FROM b WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS t FROM starts
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM d
), occ AS (
  SELECT DISTINCT doc_id, s, k, t FROM (
    SELECT doc_id, s, k, array_to_string(w[s : s + k - 1], ' ') AS t
    FROM places, (SELECT DISTINCT k FROM win) AS ks
    WHERE s + k - 1 <= len(w)
  ) AS x WHERE t IN (SELECT t FROM win)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM occ) AS x GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ JOIN win USING (t)) AS x
  GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

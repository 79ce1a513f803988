"""SimHash near-duplicates through a hierarchical index in Gray order.

Distinct fingerprints are dealt to buckets of equal bits: among fingerprints
that differ in at most d bits, at least one of d + 1 blocks is equal. A bucket
that holds many fingerprints is dealt again by blocks of its remaining bits,
which keeps every pair. Inside a bucket the fingerprints stand in Gray order,
so neighbours share long bit patterns; runs of neighbours become nodes that
hold the bits all their members agree on, and runs of nodes become upper nodes.
A search goes down from the top, adds up the differences on the bits each node
newly fixes, and drops a whole group once they exceed d.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm.common import broadcast_if_small, load, map_steps, raw_text, saved
from grantlens.llm.components import connected

SHINGLE = 3
MAX_BITS = 3
SEED = 42
# Fingerprints in a bucket before it is dealt again. Not a cap: pairs stay whole.
BUCKET = 1024
FAN = 8
# Pairs that one search step may look at, and rows a task holds.
FRONTIER = 2_000_000
HELD_ROWS = 100_000
PART = 1 << 16


def shingle_hashes(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles, in arrays of at most PART."""
    if len(words) < size:
        if words:
            yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
        return
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(words) - size + 1, PART):
        some = words[at : at + PART + size - 1]
        joined = b" ".join(some)
        ends = np.cumsum([len(w) + 1 for w in some])
        starts = [0, *ends[:-size].tolist()]
        yield np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())),
            dtype=np.uint64,
            count=len(starts),
        )


def fingerprint(raw: bytes, size: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes."""
    total, sums = 0, np.zeros(64, dtype=np.int64)
    for hashes in shingle_hashes(raw.lower().split(), size):
        total += len(hashes)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * sums > total, bitorder="little").view(np.int64)[0]) if total else 0


def row_key():
    return F.xxhash64("doc_id", "text")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(row, doc_id, fp) for each row; null and empty texts get fingerprint zero.

    row identifies a document row; repeated rows share it.
    """

    def run(batch):
        return {
            "row": batch.column("row"),
            "doc_id": batch.column("doc_id"),
            "fp": [fingerprint(t, size) for t in batch.column("text").to_pylist()],
        }

    chosen = docs.select(row_key().alias("row"), "doc_id", raw_text().alias("text"))
    return map_steps(chosen, run, "row bigint, doc_id bigint, fp bigint")


def split_bits(bits: int, parts: int) -> list[int]:
    """Masks that deal out the set bits of a mask to so many blocks of equal size."""
    at = [i for i in range(64) if bits >> i & 1]
    cuts = [len(at) * k // parts for k in range(parts + 1)]
    return [sum(1 << i for i in at[a:b]) for a, b in zip(cuts, cuts[1:])]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bucketed(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Rows of fps (fp, ...) with (mask, val): every pair within max_bits shares a bucket.

    Buckets with more distinct fingerprints than the size are dealt again by
    their remaining bits; each round is one count and one join. Equal ones stay
    together: no bits can part them. Nor is a bucket dealt with fewer bits left
    than blocks, since pairs that differ in all of them would have none in common.
    """
    masks = split_bits((1 << 64) - 1, max_bits + 1)
    rows, done = fps, None
    while True:
        dealt = rows if done is not None else rows.withColumn(
            "mask", F.explode(F.array(*[F.lit(signed(m)) for m in masks]))
        ).withColumn("val", F.col("fp").bitwiseAND(F.col("mask")))
        hot = saved(
            dealt.groupBy("mask", "val").agg(F.count("*").alias("n"))
            .filter((F.col("n") > bucket) & (F.bit_count("mask") < 64 - max_bits)).select("mask", "val"),
            "large-buckets",
        )
        kinds = dealt.join(hot, ["mask", "val"], "left_semi").select("mask", "val", "fp").distinct()
        kinds = kinds.groupBy("mask", "val").agg(F.count("*").alias("n"))
        hot = saved(kinds.filter(F.col("n") > bucket).select("mask", "val"), "hot-buckets")
        small = dealt.join(hot, ["mask", "val"], "left_anti")
        done = small if done is None else done.unionByName(small)
        used = [r.mask for r in hot.select("mask").distinct().collect()]
        if not used:
            return done
        finer = [
            (m, signed((m & (1 << 64) - 1) | block))
            for m in used
            for block in split_bits(~m & (1 << 64) - 1, max_bits + 1)
        ]
        table = fps.sparkSession.createDataFrame(sorted(set(finer)), "mask bigint, finer bigint")
        rows = (
            dealt.join(hot, ["mask", "val"], "left_semi")
            .join(F.broadcast(table), "mask")
            .withColumn("mask", F.col("finer"))
            .withColumn("val", F.col("fp").bitwiseAND(F.col("mask")))
            .drop("finer")
            .distinct()
        )
        rows = saved(rows, "finer-buckets")


def gray_rank(column: str):
    """Place of a code in the Gray sequence: each bit is the parity of the bits above it."""
    rank = F.col(column)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank


class GrayIndex:
    """Nodes over codes sorted by bucket and Gray rank; level 0 holds the codes."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray):
        sizes = np.diff(np.append(starts, len(codes)))
        self.codes = codes
        # Per level: first child, end of children, bits all agree on, their values.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        ones, zeros = codes, codes
        while True:
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
            counts = -(-sizes // FAN)
            owner = np.repeat(np.arange(len(sizes)), counts)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            begin = first[owner] + within * FAN
            end = np.minimum(begin + FAN, first[owner] + sizes[owner])
            ones = np.bitwise_or.reduceat(ones, begin)
            zeros = np.bitwise_and.reduceat(zeros, begin)
            self.levels.append((begin, end, ~(ones ^ zeros), zeros))
            sizes = counts
            if (sizes == 1).all():
                break
        self.root = np.arange(len(sizes))

    def links(self, queries: np.ndarray, bucket: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, later code of its bucket) that differ in at most max_bits bits."""
        who, node = queries, self.root[bucket]
        diff = np.zeros(len(who), dtype=np.uint8)
        fixed = np.zeros(len(who), dtype=np.uint64)
        for level in range(len(self.levels) - 1, -1, -1):
            begin, end, agreed, value = self.levels[level]
            diff = diff + np.bitwise_count((self.codes[who] ^ value[node]) & agreed[node] & ~fixed)
            near = diff <= max_bits
            who, node, diff = who[near], node[near], diff[near]
            fixed = agreed[node]
            width = end[node] - begin[node]
            inner = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            child = np.repeat(begin[node], width) + inner
            who, diff, fixed = np.repeat(who, width), np.repeat(diff, width), np.repeat(fixed, width)
            node = child
        diff = diff + np.bitwise_count((self.codes[who] ^ self.codes[node]) & ~fixed)
        near = (diff <= max_bits) & (node > who)
        return who[near], node[near]


def union(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after joining a[i] with b[i]; each root is the smallest place of its group."""
    while len(a):
        ra, rb = roots[a], roots[b]
        apart = ra != rb
        a, b = a[apart], b[apart]
        np.minimum.at(roots, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while True:
            up = roots[roots]
            if (up == roots).all():
                break
            roots = up
    return roots


def _stars(mask: np.ndarray, val: np.ndarray, codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For whole buckets: each linked code with the first code of its group."""
    new = np.flatnonzero((mask[1:] != mask[:-1]) | (val[1:] != val[:-1])) + 1
    starts = np.concatenate([[0], new])
    sizes = np.diff(np.append(starts, len(codes)))
    keep = np.repeat(sizes > 1, sizes)
    codes, sizes = codes[keep], sizes[sizes > 1]
    if not len(codes):
        return codes, codes
    starts = np.cumsum(sizes) - sizes
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    index, roots = GrayIndex(codes, starts), np.arange(len(codes))
    part = np.cumsum(sizes[bucket]) // FRONTIER
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(codes)]
    for a, b in zip(cuts, cuts[1:]):
        roots = union(roots, *index.links(np.arange(a, b), bucket[a:b], max_bits))
    moved = roots != np.arange(len(codes))
    return codes[moved], codes[roots[moved]]


def links(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """(src, dst) edges that connect all distinct fingerprints within max_bits bits.

    Each bucket emits a spanning star per group, so a bucket of n linked codes
    gives n - 1 edges and not all pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            if not held:
                return
            mask, fp = (np.concatenate(x) for x in zip(*held))
            val = fp & mask
            stop = len(fp)
            if not last:
                same = (mask == mask[-1]) & (val == val[-1])
                stop = stop - int(np.argmin(same[::-1])) if not same.all() else 0
            held = [(mask[stop:], fp[stop:])] if stop < len(fp) else []
            if stop:
                a, b = _stars(mask[:stop], val[:stop], fp[:stop].view(np.uint64), max_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["src", "dst"]
                )

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "fp")))
            if sum(len(x[0]) for x in held) >= HELD_ROWS:
                yield from flush(False)
        yield from flush(True)

    rows = bucketed(fps.select("fp"), max_bits, bucket).select("mask", "fp")
    val = F.col("fp").bitwiseAND(F.col("mask"))
    rows = rows.repartition("mask", val).sortWithinPartitions("mask", val, gray_rank("fp"))
    return rows.mapInArrow(run, "src bigint, dst bigint")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS, bucket: int = BUCKET
) -> DataFrame:
    """(row, doc_id, fp, component_id, first_row) for each row of documents.

    component_id is the smallest doc_id reachable through fingerprints that
    differ in at most max_bits bits, the row's own included; first_row is its
    row, and where a group has no id, the smallest row. Null and empty
    texts have fingerprint zero and link like any other; a null doc_id never
    names a component; repeated rows give repeated results. An empty table
    gives an empty result.
    """
    each = saved(fingerprints(docs, size), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("anon"), "doc_id", "row")).alias("first")
    codes = saved(each.groupBy("fp").agg(first), "codes")
    roots = connected(links(codes, max_bits, bucket)).withColumnRenamed("node", "fp")
    linked = codes.join(roots, "fp")
    named = linked.groupBy("root").agg(F.min("first").alias("least"))
    linked = linked.join(named, "root").select("fp", "least")
    label = codes.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("first"))
    return each.join(label, "fp").select(
        "row", "doc_id", "fp", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("first_row")
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(load(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest doc_id; repeated rows count once."""
    found = saved(near_duplicates(docs).select("row", "first_row"), "near-groups")
    lost = found.filter("row <> first_row").select(F.col("row").alias("_row"), F.lit(0).alias("_n")).distinct()
    many = found.filter("row = first_row").groupBy(F.col("row").alias("_row")).agg(F.count("*").cast("int").alias("_n"))
    marks = broadcast_if_small(saved(lost.unionByName(many.filter("_n > 1")), "near-copies"))
    rows = docs.withColumn("_row", row_key()).join(marks, "_row", "left")
    alone = rows.filter("_n is null").select(*docs.columns)
    return alone.unionByName(rows.filter("_n > 1").dropDuplicates(["_row"]).select(*docs.columns))

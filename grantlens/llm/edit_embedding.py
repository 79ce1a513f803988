"""Document fingerprints from a randomised edit embedding.

A walk over a text writes each character once or several times: at every step
a shared random bit, which depends on the step and the character, says whether
to move on. Texts a few edits apart soon walk in step again, so their
embeddings differ in few places. The fingerprint keeps four random bits of the
character at sampled places, as many in each doubling of the length, so that
it suits texts of any length. Bands of sampled bits find candidates, and the
likeness of whole fingerprints, the share of the embedding on which they agree,
verifies them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm.common import broadcast_if_small, load, map_steps, raw_text, saved, steps
from grantlens.llm.components import connected

SEED = 20_011
# The shared random bits repeat after so many steps.
PERIOD = 4096
SAMPLES = 32
OCTAVES = 40
BANDS, BAND_PLACES = 6, 6
LIKENESS = 0.8
# Members of a band that are compared with each other once its first and last do not tie all of them.
SMALL = 16
# Keys of a larger band's members by further places, and how often bands are dealt anew.
FINER, LEVELS = 4, 4
PART = 1 << 16


class Walk:
    """The shared randomness: step widths, sampled places, and bits of characters."""

    def __init__(self) -> None:
        rng = np.random.default_rng(SEED)
        move = rng.integers(0, 2, size=(256, 2 * PERIOD), dtype=np.uint8)
        move[:, PERIOD:] = move[:, :PERIOD]
        # Steps from each place to just behind the next one that moves on.
        width = np.zeros((256, 2 * PERIOD + 1), dtype=np.int64)
        for at in range(2 * PERIOD - 1, -1, -1):
            width[:, at] = np.where(move[:, at] == 1, 1, width[:, at + 1] + 1)
        self.width = [row[:PERIOD].astype(np.uint8).tobytes() for row in width]
        self.nibble = rng.integers(0, 16, size=256, dtype=np.uint8)
        places, weights = [], []
        for octave in range(OCTAVES):
            size = 1 << octave
            some = range(size) if size <= SAMPLES else sorted(set(rng.integers(0, size, SAMPLES).tolist()))
            places += [size - 1 + p for p in some]
            weights += [size / len(some)] * len(some)
        self.places = np.array(places, dtype=np.int64)
        self.weights = np.array(weights)
        self.octave = np.floor(np.log2(self.places + 1)).astype(int)

    def run(self, text: str, at: int) -> tuple[np.ndarray, int]:
        """Sampled bits of the text walked from place `at`, and the place behind it."""
        width, mask, out = self.width, PERIOD - 1, [np.zeros(0, dtype=np.uint8)]
        for start in range(0, len(text), PART):
            code = np.frombuffer(text[start : start + PART].encode("utf-32-le", "replace"), dtype="<u4")
            kinds = (code ^ code >> 8 ^ code >> 16).astype(np.uint8)
            first, ends = at, []
            push = ends.append
            for kind in kinds.tobytes():
                at += width[kind][at & mask]
                push(at)
            low, high = np.searchsorted(self.places, (first, at))
            chars = np.searchsorted(np.array(ends), self.places[low:high], side="right")
            out.append(self.nibble[kinds[chars]])
        return np.concatenate(out), at

    def likeness(self, a: np.ndarray, b: np.ndarray) -> float:
        """Share of the longer embedding on which both agree, as sampled; two empty ones agree."""
        n, m = sorted((len(a), len(b)))
        if not m:
            return 1.0
        same = a[:n] == b[:n]
        return float(self.weights[:n][same].sum() / self.weights[:m].sum())

    def bands(self, bits: np.ndarray) -> list[int]:
        """Keys of sampled bits over the last octaves that the embedding fills, and the one before.

        Embeddings of nearly equal length fill the same octaves or one more, so
        they have a key of the same octave in common to meet on.
        """
        top = int(self.octave[len(bits) - 1]) - 1 if len(bits) else 0
        out = []
        for octave in range(max(top - 1, 0), top + 1):
            low, high = np.searchsorted(self.octave, (octave - 2, octave + 1))
            if high - low < BAND_PLACES or high > len(bits):
                out.append(xxhash.xxh3_64_intdigest(bits[:high].tobytes(), octave))
                continue
            for band, place in enumerate(self.band_places(octave)):
                out.append(xxhash.xxh3_64_intdigest(bits[place].tobytes(), octave * BANDS + band + OCTAVES))
        return out

    def finer(self, bits: np.ndarray, level: int) -> list[int]:
        """Keys of further sampled bits, more of them at each level, over the octaves of bands()."""
        top = int(self.octave[len(bits) - 1]) - 1 if len(bits) else 0
        out = []
        for octave in range(max(top - 1, 0), top + 1):
            for sample in range(FINER):
                place = self.finer_places(octave, level, sample)
                place = place[place < len(bits)]
                out.append(xxhash.xxh3_64_intdigest(bits[place].tobytes(), (octave * LEVELS + level) * FINER + sample))
        return out

    @lru_cache(maxsize=OCTAVES * LEVELS * FINER)
    def finer_places(self, octave: int, level: int, sample: int) -> np.ndarray:
        low, high = np.searchsorted(self.octave, (octave - 2, octave + 1))
        rng = np.random.default_rng((SEED, octave, level, sample))
        return np.sort(rng.choice(np.arange(low, high), min(2 + 2 * level, high - low), replace=False))

    @lru_cache(maxsize=OCTAVES)
    def band_places(self, octave: int) -> list[np.ndarray]:
        """For each band, the sampled places it reads among the three octaves up to this one."""
        low, high = np.searchsorted(self.octave, (octave - 2, octave + 1))
        rng = np.random.default_rng((SEED, octave))
        return [np.sort(rng.choice(np.arange(low, high), BAND_PLACES, replace=False)) for _ in range(BANDS)]


@lru_cache(maxsize=1)
def walk() -> Walk:
    return Walk()


def shown(bits: np.ndarray) -> str:
    return bits.tobytes().hex()[1::2]


def hidden(fingerprint: str) -> np.ndarray:
    return np.array([int(c, 16) for c in fingerprint], dtype=np.uint8)


def fingerprint(text: str) -> np.ndarray:
    return walk().run(text, 0)[0]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) for each row; a null or empty text has an empty fingerprint."""

    def run(batch):
        texts = batch.column("text").to_pylist()
        made = [shown(fingerprint(t.decode("utf-8", "replace"))) for t in texts]
        return {"doc_id": batch.column("doc_id"), "fingerprint": made}

    return map_steps(docs.select("doc_id", raw_text().alias("text")), run, "doc_id bigint, fingerprint string")


def alike(pairs: DataFrame, codes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of codes whose fingerprints have at least the given likeness."""
    x = codes.select(F.col("code").alias("a"), F.col("fingerprint").cast("binary").alias("text"))
    y = codes.select(F.col("code").alias("b"), F.col("fingerprint").alias("other"))

    def judge(batch):
        texts = zip(batch.column("text").to_pylist(), batch.column("other").to_pylist())
        like = pa.array([walk().likeness(hidden(x.decode()), hidden(y)) >= least for x, y in texts], type=pa.bool_())
        return {"a": batch.column("a").filter(like), "b": batch.column("b").filter(like)}

    both = pairs.join(x, "a").join(y, "b").select("a", "b", "text", "other")
    return saved(map_steps(both, judge, "a bigint, b bigint"), "alike-prints")


def _grouped(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (code, band): pairs of each member with its band's first and last, and the members of bands of three or more."""
    shared = rows.groupBy("band").agg(F.count("*").alias("n"), F.min("code").alias("first"), F.max("code").alias("last"))
    shared = saved(shared.filter("n > 1"), "shared-bands")
    members = saved(rows.join(broadcast_if_small(shared), "band"), "band-members")
    pairs = members.select("code", F.explode(F.array("first", "last")).alias("end")).filter("code <> end")
    return pairs.select(F.least("code", "end").alias("a"), F.greatest("code", "end").alias("b")).distinct(), members.filter("n > 2")


def near_duplicates(prints: DataFrame, least: float = LIKENESS, small: int = SMALL) -> DataFrame:
    """(fingerprint, first_id, class_id) for each distinct fingerprint of (doc_id, fingerprint).

    Fingerprints that share a band are compared with the band's first and last.
    Where that leaves a band in several classes, members of different classes
    are compared with each other if the band has few; a larger one is dealt by
    keys of further sampled places, again and again, and the same is done there.
    What is still large after the last time is compared with the first member of
    every other class in its band. class_id is the smallest doc_id of the class.
    """
    codes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    codes = saved(codes.withColumn("code", F.xxhash64("fingerprint")), "edit-codes")
    raw = codes.select("code", F.col("fingerprint").cast("binary").alias("text"))

    def keys(level: int):
        def run(batch):
            each = [hidden(t.decode()) for t in batch.column("text").to_pylist()]
            each = [walk().finer(x, level) if level else walk().bands(x) for x in each]
            return {"code": batch.column("code"), "bands": [np.array(b, dtype=np.uint64).view(np.int64) for b in each]}

        return run

    rows = map_steps(raw, keys(0), "code bigint, bands array<bigint>").select("code", F.explode("bands").alias("band"))
    pairs, members = _grouped(rows.distinct())
    tried, links = saved(pairs, "print-pairs"), None
    found = alike(tried, codes, least)
    for level in range(1, LEVELS + 2):
        links = found if links is None else links.unionByName(found)
        roots = saved(connected(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))), "print-roots")
        label = members.join(roots.withColumnRenamed("node", "code"), "code", "left")
        label = saved(label.select("band", "code", "n", F.coalesce("root", "code").alias("grp")), "labelled-bands")
        apart = label.groupBy("band").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).filter("low <> high")
        label = label.join(broadcast_if_small(saved(apart.select("band"), "broken-bands")), "band")
        if not label.head(1):
            break
        last = level > LEVELS
        few = label.filter(F.col("n") <= small) if not last else label
        other = few.select("band", F.col("code").alias("b"), F.col("grp").alias("grp_b"))
        if last:
            other = other.groupBy("band", "grp_b").agg(F.min("b").alias("b"))
        across = few.join(other, "band").filter(F.col("grp") != F.col("grp_b")).select(F.least("code", "b").alias("a"), F.greatest("code", "b").alias("b"))
        if not last:
            many = label.filter(F.col("n") > small)
            more = map_steps(raw.join(many.select("code").distinct(), "code", "left_semi"), keys(level), "code bigint, bands array<bigint>")
            more = more.select("code", F.explode("bands").alias("key")).join(many.select("code", "band"), "code")
            pairs, members = _grouped(more.select("code", F.xxhash64("band", "key").alias("band")).distinct())
            across = across.unionByName(pairs)
        pairs = saved(across.distinct().join(tried, ["a", "b"], "left_anti"), "print-pairs")
        tried = tried.unionByName(pairs)
        found = alike(pairs, codes, least)
        if last:
            roots = saved(connected(links.unionByName(found).select(F.col("a").alias("src"), F.col("b").alias("dst"))), "print-roots")
    label = codes.join(roots.withColumnRenamed("node", "code"), "code", "left").withColumn("root", F.coalesce("root", "code"))
    named = label.groupBy("root").agg(F.min("first_id").alias("class_id"))
    return label.join(named, "root").select("fingerprint", "first_id", "class_id")


def ranges(docs: DataFrame, parts: int) -> tuple[np.ndarray, dict[int, int]]:
    """Cuts that deal the ids to about even ranges, and for each range's first id the range before it.

    Both have at most `parts` entries. The first range follows the last.
    """
    ids = docs.select("doc_id").filter("doc_id is not null")
    shares = [k / parts for k in range(1, parts)]
    found = ids.agg(F.percentile_approx("doc_id", shares, 50 * parts)).first()[0] if shares else None
    cuts = np.unique(np.array(found or [], dtype=np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("doc_id").to_numpy(zero_copy_only=False)
            least = np.full(len(cuts) + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, np.searchsorted(cuts, own, side="right"), own)
            some = np.flatnonzero(np.isin(np.arange(len(least)), np.searchsorted(cuts, own, side="right")))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(least[some])], names=["bucket", "doc_id"])

    firsts = ids.mapInArrow(run, "bucket bigint, doc_id bigint").groupBy("bucket").agg(F.min("doc_id").alias("doc_id"))
    order = sorted((r.bucket, r.doc_id) for r in firsts.collect())
    return cuts, {order[k][1]: order[k - 1][0] for k in range(len(order))}


def in_order(docs: DataFrame) -> DataFrame:
    """Rows dealt to ranges of doc_id, each range with the row that follows it.

    ahead marks the copy of the next range's first row; the last range is
    followed by the very first. Texts are compressed for the shuffle. Rows
    without an id have no successor and are dealt by their text.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts, leads = ranges(docs, parts)
    rows = docs.select("doc_id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tie"), raw_text().alias("text"))

    def packed(batch):
        press = zstandard.ZstdCompressor(level=1)
        at, bucket, ahead = [], [], []
        for i, (key, tie) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist())):
            at.append(i)
            ahead.append(False)
            bucket.append(-1 - tie % parts if key is None else int(np.searchsorted(cuts, key, side="right")))
            if key in leads:
                at.append(i)
                ahead.append(True)
                bucket.append(leads[key])
        take = pa.array(at, type=pa.int32())
        text = pa.array([press.compress(t) for t in batch.column("text").to_pylist()], type=pa.binary())
        return {
            "bucket": bucket,
            "ahead": ahead,
            "doc_id": batch.column("doc_id").take(take),
            "tie": batch.column("tie").take(take),
            "text": text.take(take),
        }

    return (
        map_steps(rows, packed, "bucket bigint, ahead boolean, doc_id bigint, tie bigint, text binary")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", F.desc("ahead"), F.desc("doc_id"), F.desc("tie"))
    )


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, edited_candidate boolean, next_candidate boolean"
)


def with_edited(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint beside that of its edited text and the next document's.

    The edited text has its last quarter replaced by as much of the next
    document's start. The next document is the one of the next larger doc_id
    (after the last: the first); of rows that repeat an id, the one whose text
    has the smallest hash. A null or empty text is empty; a row without an id
    has an empty next document. The candidate columns tell whether the two
    fingerprints share a band. An empty table gives an empty result.
    """
    rows = in_order(docs)
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, maps = zstandard.ZstdDecompressor(), walk()
        bucket = held_id = object()
        # Start and fingerprint of the next document; the same of the current id.
        follower = current = ("", fingerprint(""))
        for batch in steps(batches):
            made = []
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket, held_id = row["bucket"], object()
                    follower = current = ("", fingerprint(""))
                if row["doc_id"] != held_id or row["ahead"]:
                    follower, held_id = current, row["doc_id"]
                text = unpack.decompress(row["text"]).decode("utf-8", "replace")
                cut = len(text) - len(text) // 4
                kept, place = maps.run(text[:cut], 0)
                own = np.concatenate([kept, maps.run(text[cut:], place)[0]])
                current = (text, own) if row["doc_id"] is not None else follower
                if row["ahead"]:
                    held_id = object()
                    continue
                new = follower[0][: len(text) - cut]
                edited = np.concatenate([kept, maps.run(new, place)[0]])
                keys = set(maps.bands(own))
                made.append(
                    (
                        row["doc_id"],
                        len(text),
                        hashlib.sha256((text[:cut] + new).encode("utf-8", "replace")).hexdigest(),
                        shown(own),
                        shown(edited),
                        maps.likeness(own, edited),
                        maps.likeness(own, follower[1]),
                        not keys.isdisjoint(maps.bands(edited)),
                        not keys.isdisjoint(maps.bands(follower[1])),
                    )
                )
            columns = list(zip(*made)) or [()] * len(names)
            kinds = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)

    return rows.mapInArrow(run, SCHEMA)


def op2_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_edited(load(spark, sf_dir, "documents"))

"""Byte-pair encoding and decoding with forced boundaries.

A byte pair that stands inside no vocabulary token can never be merged over.
Such pairs cut a piece of text into fragments whose encodings are independent
and are simply concatenated. Fragments are short and recur, so each task keeps
the encodings it has made, up to a fixed number.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm.common import load, map_steps, raw_text

# Fixed value: the published splitting pattern of this byte-level tokenizer.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Encodings a task keeps: so many recent ones and as many older ones.
KEPT_PIECES = 200_000
NEVER = 1 << 40
ENCODED = "doc_id bigint, ids binary, decoded string"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec(dict):
    """Encodings of the pieces met so far; a missing one is made on access."""

    def __init__(self, definition: str):
        super().__init__()
        spec = json.loads(definition)
        model = spec["model"]
        if spec["normalizer"] or model["dropout"] or model["unk_token"] or model["byte_fallback"]:
            raise ValueError("not a plain byte-level tokenizer")
        letters = byte_letters()
        vocab = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items()}
        self.token = {i: t for t, i in vocab.items()}
        self.byte_id = [vocab[bytes([b])] for b in range(256)]
        self.older: dict[str, bytes] = {}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for pair in model["merges"]:
            a, b = (bytes(letters[c] for c in t) for t in (pair.split(" ") if isinstance(pair, str) else pair))
            self.rank[vocab[a], vocab[b]] = len(self.made)
            self.made.append(vocab[a + b])
        self.inside = bytearray(1 << 16)
        for t in vocab:
            for a, b in zip(t, t[1:]):
                self.inside[a << 8 | b] = 1
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = {t: np.uint32(i).tobytes() for t, i in added.items()}
        self.token |= {i: t.encode() for t, i in added.items()}
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.pieces = regex.compile(PIECES)
        size = max(self.token) + 1
        self.table = [self.token.get(i, b"") for i in range(size)]

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids: list[int] = []
            for fragment in self.fragments(piece.encode()):
                ids += self.merged([self.byte_id[b] for b in fragment])
            packed = np.array(ids, dtype="<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= KEPT_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed

    def fragments(self, raw: bytes) -> list[bytes]:
        """The piece cut at each byte pair that no token holds."""
        inside = self.inside
        if all([inside[a << 8 | b] for a, b in zip(raw, raw[1:])]):
            return [raw]
        cuts = [i for i in range(1, len(raw)) if not inside[raw[i - 1] << 8 | raw[i]]]
        return [raw[a:b] for a, b in zip([0, *cuts], [*cuts, len(raw)])]

    def merged(self, ids: list[int]) -> list[int]:
        """Merge pairs, the lowest rank first, from left to right."""
        return self._merged_short(ids) if len(ids) <= 64 else self._merged_long(ids)

    def _merged_short(self, ids: list[int]) -> list[int]:
        rank, made = self.rank, self.made
        ranks = [rank.get((a, b), NEVER) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            ids[at] = made[best]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank.get((ids[at - 1], ids[at]), NEVER)
            if at < len(ranks):
                ranks[at] = rank.get((ids[at], ids[at + 1]), NEVER)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and links, in n log n."""
        rank, n = self.rank, len(ids)
        after, prior = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(rank.get(p, NEVER), i, *p) for i, p in enumerate(zip(ids, ids[1:]))]
        heapq.heapify(heap)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            j = after[i]
            if best == NEVER or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.made[best], -1, after[j]
            if after[j] >= 0:
                prior[after[j]] = i
            for k in (prior[i], i):
                if k >= 0 and after[k] >= 0:
                    pair = ids[k], ids[after[k]]
                    heapq.heappush(heap, (rank.get(pair, NEVER), k, *pair))
        return [t for t in ids if t >= 0]

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if self.split_added is None or not self.split_added.search(text):
            return b"".join(map(self.__getitem__, self.pieces.findall(text)))
        parts = self.split_added.split(text)
        return b"".join(
            self.added[p] if i % 2 else b"".join(map(self.__getitem__, self.pieces.findall(p)))
            for i, p in enumerate(parts)
        )

    def decode(self, ids: bytes) -> str:
        tokens = map(self.table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())
        return b"".join(tokens).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _codec(key: str, definition: str) -> Codec:
    return Codec(definition)


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, decoded) for each row of documents.

    tokenizer is the path of a byte-level tokenizer definition on the driver;
    its content, of fixed size, is broadcast. Null and empty texts give no ids.
    Repeated rows give repeated results; other columns are not read.
    """
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    key = hashlib.sha256(definition.encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batch):
        codec = _codec(key, shared.value)
        ids = [codec.encode(t.decode("utf-8", "replace")) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "ids": ids, "decoded": [codec.decode(i) for i in ids]}

    return map_steps(docs.select("doc_id", raw_text().alias("text")), run, ENCODED)


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of each document."""
    encoded = encode_decode(docs, default_tokenizer())
    return encoded.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_decode(load(spark, sf_dir, "documents"), default_tokenizer()))

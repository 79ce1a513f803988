from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from grantlens.llm import importance
from tests.llm.helpers import SF, clashing, docs, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def windows(text, sizes):
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in range(sizes[0], sizes[1] + 1) for i in range(len(w) - n + 1)]


def plain(rows, target, sizes=(1, 1), buckets=10_000, seed=2024, percent=10, min_words=20):
    """rows are (doc_id, text); the result maps doc_id to (n_features, weight, score, rank)."""
    place = lambda x: zlib.crc32(x.encode()) % buckets
    found = {i: list(map(place, windows(t, sizes))) for i, t in rows}
    s, t = Counter(b for bs in found.values() for b in bs), Counter(place(w) for x in target for w in windows(x, sizes))
    ns, nt = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets))))
    out = {}
    for i, bs in found.items():
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, bs))
        out[i] = [len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None]
    able = sorted((-out[i][2], i) for i, x in rows if len(words_of(x)) >= min_words)
    for rank, (_, i) in enumerate(able[: percent * len(able) // 100], 1):
        out[i][3] = rank
    return {i: tuple(x) for i, x in out.items()}


def got(frame):
    return {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in frame.collect()}


@pytest.mark.parametrize("sizes", [(1, 1), (1, 2), (2, 3)])
def test_against_plain_python(spark, sizes):
    own, bench = table("documents"), table("benchmark")
    want = plain(list(zip(own.doc_id, own.text)), bench.text, sizes, buckets=997, percent=30)
    frame, target = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert got(importance.resampled(frame, target, sizes, buckets=997, percent=30)) == want


def test_offsets_over_cut_texts(monkeypatch):
    monkeypatch.setattr(importance, "PART", 50)
    text = "Ab cd, " * 40 + "x" * 300 + " éß 12 \x00 z" * 9
    split = importance.splitter()
    lower = text.encode().lower().decode()
    made = list(importance.features(lower, split, (1, 3)))
    assert len(made) > 3 and sum(n for n, _ in made) == len(words_of(text))
    assert Counter(x for _, some in made for x in some) == Counter(windows(text, (1, 3)))


def test_long_text(spark):
    text = "Some words, again " * 200_000
    row = importance.bucket_counts(docs(spark, text)).first()
    assert (row.n_words, row.n_features) == (600_000, 600_000)


def test_nulls_repeats_ties_and_extra_columns(spark):
    body = "one two three four five six seven eight nine ten " * 3
    frame = clashing(docs(spark, None, "", "a b", body, body, body, ids=[1, 2, 3, 4, 4, None]))
    target = clashing(docs(spark, "one two", None))
    rows = importance.resampled(frame, target, percent=100).collect()
    by = {r.doc_id: r for r in rows if r.doc_id in (1, 2, 3)}
    assert len(rows) == 6 and {(r.n_features, r.weight, r["rank"]) for r in (by[1], by[2])} == {(0, 0, None)}
    assert by[3].n_features == 2 and by[3]["rank"] is None
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3]
    same = [r for r in rows if r.doc_id == 4]
    assert same[0].score == same[1].score and abs(same[0]["rank"] - same[1]["rank"]) == 1


def test_equal_scores_rank_by_id(spark):
    rows = [(i, 0, 0, 20, 5) for i in (9, 3, 7, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, place bigint, weight bigint, n_words bigint, score bigint")
    found = {r.doc_id: r["rank"] for r in importance.drawn(frame, percent=100).collect()}
    assert found == {3: 1, 7: 2, 9: 3, None: 4}


def test_empty_tables(spark):
    some, none = docs(spark, "a b c"), docs(spark, "a").limit(0)
    assert importance.resampled(none, some).count() == 0
    row = importance.resampled(some, none, min_words=1, percent=100).first()
    assert row["rank"] == 1 and row.weight == 3 * math.floor(1000 * math.log(10_003 / (2 * 10_000)))

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from grantlens.llm import edit_embedding as ee
from tests.llm.helpers import SF, clashing, docs, table


def plain_walk(text):
    """The walk one step at a time: a written character per step, moving on where the shared bit says so."""
    maps, out, at = ee.walk(), [], 0
    for char in text:
        code = ord(char)
        kind = (code ^ code >> 8 ^ code >> 16) & 255
        while True:
            out.append(maps.nibble[kind])
            # A width of one at a step means that its bit moves on.
            moves = maps.width[kind][at % ee.PERIOD] == 1
            at += 1
            if moves:
                break
    return out


def plain_print(text):
    out = plain_walk(text)
    return [int(out[p]) for p in ee.walk().places if p < len(out)]


def plain_edited(rows):
    """(n_chars, edited text, next text) by doc_id, for unique ids."""
    rows = sorted(rows)
    out = {}
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) - len(text) // 4
        out[i] = (len(text), text[:cut] + after[: len(text) // 4], after)
    return out


def check(rows, want, maps):
    assert len(rows) == len(want)
    for r in rows:
        n, edited, after = want[r.doc_id]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = ee.hidden(r.fingerprint), ee.hidden(r.edited_fingerprint)
        assert r.edited_fingerprint == ee.shown(ee.fingerprint(edited))
        assert r.near_edited == pytest.approx(maps.likeness(a, b))
        assert r.near_next == pytest.approx(maps.likeness(a, ee.fingerprint(after)))


def test_walk_in_parts_as_one_step_at_a_time(monkeypatch):
    monkeypatch.setattr(ee, "PART", 50)
    rng = random.Random(1)
    for n in (0, 1, 2, 49, 50, 51, 700):
        text = "".join(rng.choice("abc deé𝄞ü\n") for _ in range(n))
        assert ee.fingerprint(text).tolist() == plain_print(text)


def test_query_against_brute_force(spark):
    want = table("documents")
    rows = ee.op2_edit_embedding(spark, SF).collect()
    check(rows, plain_edited(list(zip(want.doc_id.tolist(), want.text))), ee.walk())
    texts = dict(zip(want.doc_id, want.text))
    for r in rows:
        assert r.fingerprint == ee.shown(ee.fingerprint(texts[r.doc_id]))
    assert np.median([r.near_edited for r in rows]) > 0.7 and np.median([r.near_next for r in rows]) < 0.2


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_successors_across_ranges(spark, parts):
    rng = random.Random(int(parts))
    ids = rng.sample(range(-500, 10**12), 60)
    texts = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(0, 60))) for _ in ids]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        frame = docs(spark, *texts, ids=ids).repartition(5)
        check(ee.with_edited(frame).collect(), plain_edited(list(zip(ids, texts))), ee.walk())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "3")


def test_few_edits_stay_near():
    rng = random.Random(5)
    text = "".join(rng.choice("etaoin shrdlu") for _ in range(3000))
    one = text[:2500] + "xx" + text[2500:]
    other = "".join(rng.choice("etaoin shrdlu") for _ in range(3000))
    maps, own = ee.walk(), ee.fingerprint(text)
    assert maps.likeness(own, ee.fingerprint(one)) > 0.8 > 0.3 > maps.likeness(own, ee.fingerprint(other))
    assert maps.likeness(own, own) == 1 and maps.likeness(own, ee.fingerprint("")) == 0


def test_near_duplicates_by_bands(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("etaoin shrdlu") for _ in range(rng.randint(400, 3000))) for _ in range(12)]
    texts = base + [b[:-7] + "altered" for b in base] + [base[0], "", "", None]
    prints = ee.fingerprints(clashing(docs(spark, *texts)))
    classes = {r.fingerprint: r.class_id for r in ee.near_duplicates(prints).collect()}
    got = [classes[ee.shown(ee.fingerprint(t or ""))] for t in texts]
    assert got == list(range(12)) * 2 + [0, 25, 25, 25]
    assert ee.near_duplicates(prints.limit(0)).count() == 0


@pytest.mark.parametrize("small", [2, 16])
def test_interleaved_clusters_against_all_pairs(spark, small):
    """Fingerprints that share bands but fall into many classes, as they alternate in them."""
    rng, walk = random.Random(3), ee.walk()
    size = int(np.searchsorted(walk.octave, 9))
    prints = []
    for _ in range(6):
        base = np.array([rng.randrange(16) for _ in range(size)], dtype=np.uint8)
        common = base.copy()
        for _ in range(5):
            # A cluster shares most of its last places with the others of its base.
            start = common.copy()
            for at in rng.sample(range(size), size // 4):
                start[at] = rng.randrange(16)
            for _ in range(6):
                one = start.copy()
                for at in rng.sample(range(size), rng.randint(0, size // 12)):
                    one[at] = rng.randrange(16)
                prints.append(one)
    frame = spark.createDataFrame([(i, ee.shown(p)) for i, p in enumerate(prints)], "doc_id bigint, fingerprint string")
    got = {r.fingerprint: r.class_id for r in ee.near_duplicates(frame, small=small).collect()}
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if walk.likeness(prints[i], prints[j]) >= ee.LIKENESS and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    links = [(i, j) for i in range(len(prints)) for j in range(i) if walk.likeness(prints[i], prints[j]) >= ee.LIKENESS]
    kept = [got[ee.shown(prints[i])] == got[ee.shown(prints[j])] for i, j in links]
    assert len(set(root)) > 6 and np.mean(kept) >= 0.98
    assert all(root[i] == root[got[ee.shown(p)]] for i, p in enumerate(prints))


def test_nulls_repeats_and_extra_columns(spark):
    frame = clashing(docs(spark, None, "", "abcdefgh", "abcdefgh", "zzzzzzzz", "12345678", ids=[1, 2, 5, 5, None, 9]))
    rows = sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in ee.with_edited(frame).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert rows == [
        ("1", 0, sha("")), ("2", 0, sha("")), ("5", 8, sha("abcdef12")), ("5", 8, sha("abcdef12")),
        ("9", 8, sha("123456")), ("None", 8, sha("zzzzzz")),
    ]
    assert ee.with_edited(frame.limit(0)).count() == 0
    assert ee.with_edited(docs(spark, "abcdefgh")).first().edited_sha256 == sha("abcdefab")


def test_classes_of_the_table_against_all_pairs(spark):
    found = ee.with_edited(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    prints = {r.doc_id: r.fingerprint for r in found}
    frame = spark.createDataFrame(list(prints.items()), "doc_id bigint, fingerprint string")
    classes = {r.fingerprint: r.class_id for r in ee.near_duplicates(frame).collect()}
    got = {i: classes[p] for i, p in prints.items()}
    bits = {i: ee.hidden(p) for i, p in prints.items()}
    like = {(a, b) for a in bits for b in bits if a < b and ee.walk().likeness(bits[a], bits[b]) >= ee.LIKENESS}
    kept = [got[a] == got[b] for a, b in like]
    assert len(like) > 5 and np.mean(kept) >= 0.95
    root = {a: a for a in prints}
    for a, b in like:
        x, y = sorted((root[a], root[b]))
        root = {k: x if r == y else r for k, r in root.items()}
    assert all(root[a] == root[c] for a, c in got.items())

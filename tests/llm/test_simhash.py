from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from grantlens.llm import components, simhash
from tests.llm.helpers import SF, clashing, docs, table


def plain_fingerprint(text, size=3):
    words = text.encode().lower().split()
    parts = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(codes, max_bits=3):
    """Smallest index reachable, by comparing all pairs."""
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def near_codes(rng, centres, each):
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(each):
            x = c
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


def test_query_against_all_pairs(spark):
    rows = simhash.op5_simhash(spark, SF).collect()
    want = table("documents").sort_values("doc_id")
    codes = [plain_fingerprint(t) for t in want.text]
    ids = want.doc_id.tolist()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
    assert len(rows) == len(ids)
    for i, root in enumerate(plain_groups(codes)):
        assert got[ids[i]] == (f"{codes[i]:016x}", ids[root])


@pytest.mark.parametrize("bucket", [2, 8, 1024])
@pytest.mark.parametrize("max_bits", [0, 1, 3])
def test_links_against_all_pairs(spark, bucket, max_bits):
    codes = near_codes(random.Random(bucket + max_bits), 12, 25)
    frame = spark.createDataFrame([(simhash.signed(c),) for c in codes], "fp bigint")
    found = components.connected(simhash.links(frame, max_bits, bucket)).collect()
    root = {r.node & (1 << 64) - 1: r.root for r in found}
    assert len(root) == len(found)
    want = plain_groups(codes, max_bits)
    groups: dict = {}
    for c, w in zip(codes, want):
        groups.setdefault(w, set()).add(root.get(c, ("alone", c)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_tree_finds_each_pair_once():
    codes = np.array(near_codes(random.Random(5), 3, 60), dtype=np.uint64)
    index = simhash.GrayIndex(codes, np.array([0]))
    a, b = index.links(np.arange(len(codes)), np.zeros(len(codes), dtype=int), 3)
    want = {(i, j) for j in range(len(codes)) for i in range(j) if (int(codes[i]) ^ int(codes[j])).bit_count() <= 3}
    assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want)


def test_gray_neighbours_differ_in_one_bit(spark):
    frame = spark.createDataFrame([(i,) for i in range(64)], "fp bigint").withColumn("rank", simhash.gray_rank("fp"))
    codes = [r.fp for r in frame.orderBy("rank").collect()]
    assert all((a ^ b).bit_count() == 1 for a, b in zip(codes, codes[1:]))


def test_long_text_in_parts(monkeypatch):
    monkeypatch.setattr(simhash, "PART", 7)
    text = " ".join(random.Random(2).choice("abcdefg") for _ in range(100))
    assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == plain_fingerprint(text)


def test_nulls_ties_and_extra_columns(spark):
    frame = clashing(docs(spark, None, "", " \t", "A b", "a B", "x y z w", "x y z w", ids=[7, 3, None, 9, 8, 5, 5]))
    rows = simhash.near_duplicates(frame).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in rows) == [
        ("3", 3), ("5", 5), ("5", 5), ("7", 3), ("8", 8), ("9", 8), ("None", 3)
    ]
    assert simhash.near_duplicates(frame.limit(0)).count() == 0


def test_chain_of_edges(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 90)], "src bigint, dst bigint")
    found = {r.node: r.root for r in components.connected(edges).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 90, 90: 90}


def test_stage_keeps_one_of_each_group(spark):
    frame = clashing(docs(spark, None, "", "A b", "a B", "x y z w", "x y z w", "q", "q", ids=[7, 3, 9, None, 5, 5, None, None]))
    out = simhash.stage(spark, frame, "")
    assert out.columns == frame.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == [("3", ""), ("5", "x y z w"), ("9", "A b"), ("None", "q")]
    assert simhash.stage(spark, frame.limit(0), "").count() == 0

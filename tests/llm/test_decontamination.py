from __future__ import annotations

import hashlib
import random
import re

import pytest

from grantlens.llm import decontamination as dc
from tests.helpers import plan
from tests.llm.helpers import SF, clashing, docs, table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(texts, items, size=13):
    out = []
    for text in texts:
        w, hit, found = split(text), set(), set()
        for item_id, item in items:
            v = split(item)
            n = min(len(v), size)
            wins = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for s in range(len(w) - n + 1 if n else 0):
                if tuple(w[s : s + n]) in wins:
                    hit.update(range(s, s + n))
                    found.add(str(item_id))
        out.append((len(w), len(hit), sorted(found)))
    return out


def bench(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id bigint, text string")


def check(spark, texts, items, **kw):
    frame = clashing(docs(spark, *texts))
    rows = dc.contamination(frame, bench(spark, *items), **kw).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.items) for r in rows}
    assert len(rows) == len(texts)
    assert [got[i] for i in range(len(texts))] == plain(texts, items)


def test_query_against_brute_force(spark):
    rows = {r.doc_id: r for r in dc.op9_decontamination(spark, SF).collect()}
    want = table("documents")
    items = list(table("benchmark").itertuples(index=False, name=None))
    for i, (n, hit, found) in zip(want.doc_id, plain(want.text, items)):
        r = rows[i]
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(found))
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert r.contaminated == (hit > 0 and 20 * hit >= n)


@pytest.mark.parametrize("block", [7, 100_000])
def test_random_windows(spark, block):
    rng = random.Random(block)
    items = [(i, " ".join(rng.choices("abcdef", k=rng.choice([0, 1, 2, 4, 5, 7, 12, 13, 14, 30])))) for i in range(25)]
    texts = []
    for _ in range(30):
        parts = [rng.choice(items)[1] if rng.random() < 0.4 else " ".join(rng.choices("abcdefgh", k=9)) for _ in range(4)]
        texts.append(", ".join(parts))
    check(spark, texts, items, block=block)


def test_edges_case_and_separators(spark):
    item = "The Quick-brown fox É 12 jumps over the lazy dog and then some more words"
    texts = [item, item.upper(), item.replace("É", "é"), item[:-6], "x " + item + " y", item + " " + item, "", None, "!!"]
    check(spark, texts, [(1, item), (1, item), (10, item), (2, None), (3, ""), (9, "over the lazy")])


def test_empty_tables(spark):
    frame = docs(spark, "a b c", None)
    got = dc.contamination(frame, bench(spark, (1, "x")).limit(0)).collect()
    assert sorted((r.n_words, r.n_hit, r.n_items) for r in got) == [(0, 0, 0), (3, 0, 0)]
    assert dc.contamination(frame.limit(0), bench(spark, (1, "a"))).count() == 0
    assert dc.contamination(frame, bench(spark, (None, "a b c"))).filter("n_hit > 0").count() == 0


def test_repeated_rows_and_null_ids(spark):
    frame = docs(spark, "a b", "a b", "a b", ids=[1, 1, None])
    got = dc.contamination(frame, bench(spark, (5, "a b"))).collect()
    assert sorted((str(r.doc_id), r.n_hit, r.items) for r in got) == [("1", 2, ["5"])] * 2 + [("None", 2, ["5"])]


def test_no_python_in_the_plan(spark):
    text = plan(dc.op9_decontamination(spark, SF))
    for word in ["Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"]:
        assert word not in text


def test_stage_drops_only_contaminated(spark):
    sf = SF
    frame = clashing(spark.read.parquet(f"{sf}/documents.parquet"))
    bad = {r.doc_id for r in dc.op9_decontamination(spark, sf).filter("contaminated").collect()}
    out = dc.stage(spark, frame, sf)
    assert out.columns == frame.columns
    assert {r.doc_id for r in out.collect()} == set(table("documents").doc_id) - bad

"""Each stage on what the one before kept, against brute force on the same rows."""

from __future__ import annotations

import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from grantlens.llm import bpe, quality
from grantlens.llm.common import load, saved
from tests.llm.helpers import SF, clashing, table
from tests.llm.test_decontamination import plain as plain_hits
from tests.llm.test_lines import plain_dropped
from tests.llm.test_simhash import plain_fingerprint, plain_groups


@pytest.fixture(scope="module")
def kept(spark):
    """Rows by doc_id after each stage."""
    docs, out = load(spark, SF, "documents"), {}
    out["start"] = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frame.columns == docs.columns
        docs = saved(frame, name)
        rows = docs.collect()
        out[name] = {r.doc_id: r for r in rows}
        assert len(out[name]) == len(rows)
    return out


def test_quality_drops_what_its_operator_rejects(spark, kept):
    scores = {r.doc_id: r.predicted for r in quality.op7_quality(spark, SF).collect()}
    assert kept["quality"] == {i: r for i, r in kept["start"].items() if scores[i] == 1}
    good = table("labels").query("quality == 1").doc_id
    lost = [i for i in good if i in kept["start"] and i not in kept["quality"]]
    assert len(lost) <= 0.02 * len(good)


def test_line_dedup_against_brute_force(kept):
    before, after = kept["quality"], kept["line_dedup"]
    dropped = plain_dropped([(i, r.text) for i, r in before.items()])
    for i, r in before.items():
        rest = [x for n, x in enumerate(r.text.split("\n")) if n not in dropped.get(i, [])]
        if i not in dropped:
            assert after[i] == r
        elif not "".join(rest).strip():
            assert i not in after
        else:
            assert after[i].text == "\n".join(rest) and after[i].n_chars == len(after[i].text)


def test_near_dedup_against_brute_force(kept):
    before = sorted(kept["line_dedup"].values(), key=lambda r: r.doc_id)
    roots = plain_groups([plain_fingerprint(r.text) for r in before])
    assert kept["near_dedup"] == {r.doc_id: r for k, r in enumerate(before) if roots[k] == k}


def test_decontamination_against_brute_force(kept):
    items = list(table("benchmark").itertuples(index=False, name=None))
    before = list(kept["near_dedup"].values())
    hits = plain_hits([r.text for r in before], items)
    clean = {r.doc_id: r for r, (n, hit, _) in zip(before, hits) if not (hit and 20 * hit >= n)}
    assert kept["decontamination"] == clean


def test_encoding_as_the_library(kept):
    library = Tokenizer.from_file(bpe.default_tokenizer())
    before = kept["decontamination"]
    assert set(kept["encoding"]) == set(before)
    for i, r in kept["encoding"].items():
        assert r.n_tokens == len(library.encode(before[i].text, add_special_tokens=False).ids)
        assert r.decoded_sha256 == hashlib.sha256(before[i].text.encode()).hexdigest()


def test_run_gives_the_last_stage(spark, kept):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r for r in rows} == kept["encoding"]


def test_stages_bear_nulls_and_extra_columns(spark):
    rows = [(None, None, "en", "s", None), (1, "", "en", "s", 0), (2, None, None, None, None), (None, "a b c d e f", "x", "y", 9)]
    docs = clashing(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    for frame in (docs, docs.union(docs), docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = saved(stage(spark, frame, SF), name)
            if name != "encoding":
                assert frame.columns == docs.columns

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pandas as pd
import pytest

from grantlens.llm import toxicity
from tests.llm.helpers import clashing, docs

SF = "/root/testdata/sf0.01"
BODY = "the idiot and the moron were pathetic losers of a stupid clown show with trash and scum " * 20


@pytest.fixture(scope="module")
def language():
    return toxicity.log_probabilities(toxicity.triples(BODY).astype(float))


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(spark):
    got = toxicity.op11_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    marks = pd.read_parquet("/root/testdata/sf0.1/labels.parquet")
    both = got.merge(marks, on="doc_id")
    held = both[both.held_out]
    assert len(got) == 10_000 and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    assert (held[held.toxic == 1].predicted == 1).mean() > 0.9
    assert (held[held.toxic == 0].predicted == 0).mean() > 0.99
    assert [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id] == got.held_out.tolist()


def test_obfuscated_copies_score_like_plain_ones(spark):
    frame, marks = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(frame, marks)
    held = marks.filter(toxicity.held_out()).filter("quality = 1")
    clear = frame.filter("lang = 'en'").join(held, "doc_id").select("doc_id", "text", "toxic").toPandas()
    words = ["idiot", "moron", "stupid", "pathetic", "loser", "trash", "clown", "scum", "worthless", "disgusting"]
    hidden = ["idi0t", "m0r0n", "$tupid", "p-a-t-h-e-t-i-c", "looooser", "tra$h", "c l o w n", "s.c.u.m", "wor7hless", "d1sgust1ng"]
    bad = clear[(clear.toxic == 1) & clear.text.str.contains("|".join(words))].copy()
    for a, b in zip(words, hidden):
        bad["text"] = bad.text.str.replace(rf"\b{a}\b", b, regex=True)
    assert not bad.text.str.contains(r"\b(?:" + "|".join(words) + r")\b").any() and len(bad) > 30
    score = {r.doc_id: r.score for r in toxicity.scored(docs(spark, *bad.text, ids=bad.doc_id.tolist()), model).collect()}
    assert np.mean([s >= 0.3 for s in score.values()]) > 0.9


def plain(run, model, spelled):
    """Cost of every path through the lattice, one by one."""
    best = None
    for path in itertools.product(*toxicity.lattice(run, spelled)):
        a = b = 0
        total = 0.0
        for syms, cost, _ in path:
            total -= cost
            for s in syms:
                if s or b:
                    total += model[(a * 64 + b) * 64 + s]
                a, b = (b, s) if s else (0, 0)
        total += model[(a * 64 + b) * 64] if b else 0
        if best is None or total > best[0] + 1e-9:
            best = (total, "".join(x[2] for x in path))
    return best[1]


@pytest.mark.parametrize("run", ["1di0t", "m0r0n", "tra$$h", "s.c.u.m", "p4th3t1c", "sss7uuup1d", "a1b2c3", "i d i 0 t", "cl0wn-sh0w", "___x", "l0-5e_r"])
def test_search_against_all_paths(language, run):
    for spelled in (False, True):
        assert toxicity.likeliest(run, language.tolist(), spelled) == plain(run, language, spelled)


def test_restored_text(language):
    reader = toxicity.Reader(language)
    got = reader.text("The 1di0t, a M0R0N! i d i o t; stuuuupid s.c.u.m $tupid tra$h!!  cl0wn\n12 345 end$$$ the.")
    assert got == "the idiot, a moron! idiot; stupid scum stupid trash!!  clown\n12 345 end$$$ the."
    assert reader.words("Idi0t idi0t i d i o t") == {"idiot": 3}


def test_plain_text_is_left_alone(language):
    reader = toxicity.Reader(language)
    for text in ("a plain text, well written, of 20 words (or so)...", "été à ñ", "", "--- ### $$$ 1234", "x" * 2):
        assert toxicity.LETTERS.findall(reader.text(text)) == toxicity.LETTERS.findall(text)


def test_triples_count_every_symbol():
    s = toxicity.triples("ab, é. b")
    a, b, e = 1, 2, toxicity.symbol("é")
    want = {(0, 0, a), (0, a, b), (a, b, 0), (0, 0, e), (0, e, 0), (0, 0, b), (0, b, 0)}
    assert {((i // 64) // 64, i // 64 % 64, i % 64) for i in np.flatnonzero(s)} == want and s.sum() == 7


def test_long_texts_in_linear_time(language):
    reader = toxicity.Reader(language)
    for text in ("x" * 1_000_000, "ab1" * 300_000, "a b " * 200_000, "a.b" * 300_000, "the idiot " * 200_000):
        assert sum(reader.words(text).values()) > 0


def test_counts_cover_all_documents(spark):
    some = toxicity.language_model(docs(spark, "abab " * 50, None, ""))
    more = toxicity.language_model(docs(spark, "abab " * 50, "zz " * 500, ""))
    assert some[26] < more[26]


def test_held_out_labels_do_not_matter(spark):
    frame, marks = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    f = toxicity.F
    turned = marks.withColumn("toxic", f.when(toxicity.held_out(), 1 - f.col("toxic")).otherwise(f.col("toxic")))
    a, b = toxicity.fit(frame, marks), toxicity.fit(frame, turned)
    assert a.weights == b.weights and a.base == b.base and (a.factors == b.factors).all()


def test_without_labels_and_with_one_kind(spark):
    frame = docs(spark, "a", None, "you idiot")
    for rows, want in (([(1, 1, None), (None, 1, 0), (77, 1, 0)], 0.5), ([(0, 1, 0), (1, 1, 0)], 0.0)):
        model = toxicity.fit(frame, labels(spark, rows))
        assert {round(r.score, 6) for r in toxicity.scored(frame, model).collect()} == {want}


def test_nulls_repeats_and_extra_columns(spark):
    texts = [None, "", "you idiot " * 3, "you are nice", "you are nice"] + [f"idiot number {i} x" for i in range(20)] + [f"nice number {i} x" for i in range(20)]
    ids = [1, 3, None, 4, 4, *range(100, 140)]
    frame = clashing(docs(spark, *texts, ids=ids))
    marks = labels(spark, [(1, 1, 0), (1, 0, 1), (3, 0, 0), (None, 0, 1)] + [(i, 1, int(i < 120)) for i in range(100, 140)])
    model = toxicity.fit(frame, clashing(marks))
    rows = toxicity.scored(frame, model).collect()
    assert len(rows) == 45 and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[None] > 0.3 > by[4]
    assert toxicity.restored(frame, model.language).count() == 45
    assert toxicity.scored(frame.limit(0), model).count() == 0
    assert (toxicity.language_model(frame.limit(0)) < 0).all()


def test_training_rows_are_bounded(spark):
    frame, marks = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    language = toxicity.language_model(frame)
    assert toxicity._training_words(frame, marks, language, 20).count() <= 20

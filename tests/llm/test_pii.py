from __future__ import annotations

import hashlib
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from grantlens.llm import pii
from tests.llm.helpers import SF, clashing, docs, table


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


PIECES = ["1", "2", "25", "255", "256", ".", "..", "@", "a", "b.", "-", " ", "+", "(", ")", "4111111111111111", ".com", "%", "é", "12"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30))
def test_base_spans_as_the_plain_patterns(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == plain_spans(text)


def test_query_against_plain_patterns(spark):
    rows = {r.doc_id: r for r in pii.op1_pii(spark, SF).collect()}
    want = table("documents")
    assert len(rows) == len(want)
    for i, text in zip(want.doc_id, want.text):
        base = plain_spans(text)
        r = rows[i]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(joined.split(",")) <= set(r.spans.split(","))


def test_labelled_texts_are_labelled():
    for text, spans in pii.labelled_texts():
        assert sorted(pii.find([text])[0][1]) == sorted(spans)


def test_far_repetitions_take_the_label():
    far = " and words" * 400
    text = f"Call +1 (212) 555-0147 now.{far} Then (212) 555-0147 once more."
    _, spans = pii.find([text])[0]
    assert [text[s:e] for k, s, e in spans if k == "phone"] == ["+1 (212) 555-0147", "(212) 555-0147"]
    alone = pii.find([f"Section 12 of 555-0147.{far} Year 1999, 404."])[0]
    assert alone == ([], [])


def test_messages_are_exact_on_a_chain():
    """Without cycles, loopy sum-product equals the sum over all labellings."""
    field, graph = pii.model(), pii.Graph()
    graph.add("1 (212) 555-0147 x", [])
    x, n = graph.features() @ field.node, len(pii.LABELS)
    chain, skip = graph.edges()
    assert len(chain) == 2 and not len(skip)
    total = np.zeros(x.shape)
    for ls in np.ndindex(*[n] * len(x)):
        p = np.exp(sum(x[i, ls[i]] for i in range(len(x))) + sum(field.chain[ls[a], ls[b]] for a, b in chain))
        for i, k in enumerate(ls):
            total[i, k] += p
    want = total / total.sum(axis=1, keepdims=True)
    assert np.abs(field.marginals(graph) - want).max() < 0.01


def test_batches_do_not_touch_each_other():
    texts = ["Call +1 (212) 555-0147 now", "page (212) of 300", "", "mail a@b.co"]
    assert pii.find(texts) == [pii.find([t])[0] for t in texts]


def test_long_texts_take_linear_time():
    start = time.time()
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1 " * 150_000, "+1" * 150_000, "a.b@" * 75_000, "1." * 150_000):
        pii.find([text])
    assert time.time() - start < 60
    start = time.time()
    for text in ("x" * 1_000_000, "é-" * 500_000, "ab " * 300_000 + "x" * 1_000_000 + " 1"):
        pii.find([text])
    assert time.time() - start < 10


@settings(max_examples=500, deadline=None)
@given(st.text("a1@ .\n", max_size=30))
def test_tokens_as_the_plain_pattern(text):
    assert [m.span() for m in pii.TOKEN.finditer(text)] == [m.span() for m in re.finditer(r"\S*[0-9@]\S*", text)]


def test_nulls_repeats_and_extra_columns(spark):
    frame = clashing(docs(spark, None, "", "a@b.co", "a@b.co", ids=[1, 2, None, None]))
    rows = pii.detect(frame).collect()
    assert sorted(len(r.base) for r in rows) == [0, 0, 1, 1]
    assert pii.detect(frame.limit(0)).count() == 0

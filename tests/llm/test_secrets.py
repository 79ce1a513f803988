from __future__ import annotations

import hashlib
import random
import re

import pytest

from grantlens.llm import secrets
from tests.helpers import plan
from tests.llm.helpers import SF, clashing, docs, table

PLAIN = {
    "assign": re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def plain_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text or ""):
            if {"assign": lambda: len(m[2]) >= 8, "access": lambda: len(m[0]) >= 16, "hex": lambda: len(m[0]) >= 32}[kind]():
                out.append((m.start(), n, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def spans(df):
    return {r.doc_id: [(s.kind, s.start, s.stop) for s in r.spans] for r in df.collect()}


def test_query_against_plain_patterns(spark):
    want = table("documents")
    rows = {r.doc_id: r for r in secrets.op3_secrets(spark, SF).collect()}
    assert len(rows) == len(want)
    for i, text in zip(want.doc_id, want.text):
        base = plain_spans(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert rows[i].spans == joined and rows[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [rows[i].n_assign, rows[i].n_access, rows[i].n_hex] == [sum(b[0] == k for b in base) for k in PLAIN]


def test_random_texts(spark):
    rng = random.Random(4)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", ":", "=", " ", "'", '"', "abc", "deadbeef" * 5,
             "abcdefgh", "AKIA", "ABCDEFGHIJKL", "é", "\n", "0123456789abcdef", "Z", "ſecret", "toKen"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 18))) for _ in range(800)]
    frame = clashing(docs(spark, *texts).repartition(4))
    got = spans(secrets.scan(frame))
    assert [got[i] for i in range(len(texts))] == list(map(plain_spans, texts))


@pytest.mark.parametrize(
    "pattern, want",
    [
        ("ab", []),
        ("[a-z]+", []),
        ("abcd", [{"abc", "bcd"}]),
        ("(abc|x)def+[0-9]gh", [{"abc", "bcd", "cde"}, {"xde"}]),
        ("a[xy]cd", [{"axc", "xcd"}, {"ayc", "ycd"}]),
        ("(foo|[0-9]+bar)baz", [{"bar", "baz"}, {"baz", "foo"}]),
        ("(abc)?def", [{"def"}]),
        ("(abc)*", []),
        ("(abc[0-9])+x", [{"abc"}]),
        ("abc|ab", []),
    ],
)
def test_trigram_queries(pattern, want):
    got = secrets.trigram_query(pattern)
    assert sorted(map(sorted, got)) == sorted(map(sorted, want))


def test_a_match_always_answers_its_query():
    rng = random.Random(9)
    pattern = r"(?i:(foo|ba[rz]|qu?ux))[0-9]*(abc|d[ef]{1,2}g)+-?end"
    query = secrets.trigram_query(pattern)
    assert query
    made = 0
    for _ in range(3000):
        text = "".join(rng.choices(["foo", "BAR", "baz", "qux", "quux", "1", "abc", "deg", "dffg", "-", "end", "x"], k=8))
        if re.search(pattern, text):
            made += 1
            assert any(all(t in text.lower() for t in part) for part in query)
    assert made > 5


def test_index_holds_exactly_the_asked_trigrams(spark):
    frame = docs(spark, "my token", "broken key", "secret", None, "")
    index = secrets.trigram_index(frame, ["tok", "oke", "ken", "sec"])
    got = sorted((r.trigram, r.n) for r in index.groupBy("trigram").agg(secrets.F.count("*").alias("n")).collect())
    assert got == [("ken", 2), ("oke", 2), ("sec", 1), ("tok", 1)]
    rules = secrets.candidates(index, secrets.RULES).collect()
    assert len(rules) == 1 and rules[0].kinds == ["assign"]


def test_nulls_repeats_and_empty(spark):
    frame = docs(spark, None, "", "token=abcdefgh", "token=abcdefgh", "token=short", ids=[1, 2, 3, 3, None])
    rows = secrets.scan(frame).collect()
    assert sorted((str(r.doc_id), len(r.spans)) for r in rows) == [("1", 0), ("2", 0), ("3", 1), ("3", 1), ("None", 0)]
    assert secrets.scan(frame.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    text = plan(secrets.op3_secrets(spark, SF))
    for word in ["Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"]:
        assert word not in text

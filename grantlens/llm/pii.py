"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans. The field then labels the tokens that can be
part of an entity at all: those with a digit or an at sign. Neighbouring
tokens are joined by chain potentials. Tokens of a document that repeat or
resemble each other are joined by skip potentials, however far apart, so that
a mention that is clear in one place labels its bare repetitions elsewhere.
Loopy message passing gives the marginals. All documents of a batch form one
graph, whose parts never touch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm.common import load, map_steps, raw_text

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
ROUNDS = 12
CERTAIN = 0.6

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Runs of digits cannot be entered in the middle, so failing ones cost one pass.
IP = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Entered at the start of a token only and never tried twice, so any text costs one pass.
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
EDGES = "\"'.,;:!?<>[]{}*$%&#|"

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(t - 9 * (t > 9) for t in twice)) % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Each at sign with a domain behind it takes the local part before it, if any is left."""
    end = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            yield "email", start, end


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by kind, then start."""
    found: list[Span] = list(emails(text)) if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start():
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


FEATURES = 17


def token_features(word: str, kind: str) -> np.ndarray:
    """What a token looks like, and which base span covers it."""
    digits = sum(map(str.isdigit, word))
    groups = re.findall(r"[0-9]+", word)
    letters = sum(map(str.isalpha, word))
    return np.array(
        [
            1,
            kind == "email",
            kind == "ip",
            kind == "card",
            kind == "phone",
            "@" in word and "." in word,
            len(groups) == 4 and word.count(".") == 3 and not letters,
            13 <= digits <= 19 and not letters,
            digits in (7, 10) and "-" in word and not letters,
            digits == 3 and word[:1] == "(" and word[-1:] == ")",
            word[:1] == "+",
            1 <= digits <= 6 and digits == len(word),
            7 <= digits <= 12 and digits == len(word),
            digits > 19,
            letters > 0 and "@" not in word,
            len(groups) <= 3 and "." in word,
            "/" in word or ":" in word or "=" in word,
        ],
        dtype=np.float64,
    )


def tokens(text: str, base: list[Span]) -> list[tuple[str, int, int, str]]:
    """(word, start, end, covering kind) of each token with a digit or an at sign."""
    out = []
    spans = sorted((s, e, k) for k, s, e in base)
    at = 0
    for m in TOKEN.finditer(text):
        word = m[0].lstrip(EDGES)
        start = m.end() - len(word)
        word = word.rstrip(EDGES)
        if not word:
            continue
        end = start + len(word)
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        kind = next((k for s, e, k in spans[at : at + 4] if s < end and e > start), "")
        out.append((word, start, end, kind))
    return out


def alike(word: str) -> list[str]:
    """Keys under which tokens resemble each other: the same word, digits, or mail name."""
    keys = ["w" + word.lower()]
    digits = "".join(c for c in word if c in "0123456789")
    if len(digits) >= 7:
        keys.append("d" + digits)
    if "@" in word:
        keys.append("w" + word.lower().split("@")[0])
    return keys


class Graph:
    """Tokens of many texts with their chain and skip edges."""

    def __init__(self) -> None:
        self.words: list[tuple[str, int, int, str]] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []

    def add(self, text: str, base: list[Span]) -> range:
        first = len(self.words)
        found = tokens(text, base)
        last: dict[str, int] = {}
        for i, (word, start, _, _) in enumerate(found, first):
            # Repetitions are linked one to the next: as many links as tokens.
            for key in alike(word):
                if key in last and last[key] != i:
                    self.skip.append((last[key], i))
                last[key] = i
            if i > first and not text[found[i - first - 1][2] : start].strip():
                self.chain.append((i - 1, i))
        self.words += found
        return range(first, len(self.words))

    def features(self) -> np.ndarray:
        return np.array([token_features(w, k) for w, _, _, k in self.words]).reshape(-1, FEATURES)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        return (np.array(x, dtype=np.int64).reshape(-1, 2) for x in (self.chain, self.skip))


# Small labelled texts: entities in brackets, with their kind before a bar.
LABELLED = """
Write to {email|ann.lee@mail.example.org} or call {phone|+1 (212) 555-0101} today. Later call {phone|(212) 555-0101} again.
The host {ip|10.20.30.40} answered; {ip|10.20.30.40} is down, port 8080, since 12:30 on 2024-05-06.
Card {card|4111111111111111} was charged 12.50 on 3 May 2021, version 2.1.0 and 3.14 apply, order 123456.
Card {card|5500 0000 0000 0004} expires 12/27. In 1999 there were 12 of 100 pages, chapter 7, part 4.0.
Mail {email|bob@site.example.net}, not bob@home. Token 9f86d081884c7d659a2feaa0c55ad015 has 32 letters.
Ring {phone|+44 20 7946 0958} now. Please call {phone|+1 (646) 555-0199}, then {phone|(646) 555-0199}.
Number 1234567890123456 fails its check. Page 404 of 500, ratio 0.25, price 19.99, id 20240131.
Address {ip|192.168.1.77} and section 1.2.3 of rule 1.2 in 2020. Build 1000000 and 7 more, 15.
From {email|carol_95@uni.example.edu} to {email|d.ohara@post.example.com}: see item 3 of 14, 25% off.
Server {ip|172.16.0.9} moved to {ip|172.16.0.10}; release 4.18.2 came on 2019-11-30 at 23:59:59.
Fax {phone|+49 30 901820}, office {phone|+33 1 42 68 53 00}. Room 212, floor 3, zip 10115, born 1984.
Paid with {card|378282246310005} and {card|6011-1111-1111-1117}; invoice 20230815001, total 1,250.00.
Isbn 978-3-16-148410-0, part no 555-12, score 3-0, range 10-20, run 1e10, key a1b2c3d4e5f6.
The meeting at 10:15 in room 4 has 25 seats; 300 people, 1500 words, 42 pages, 7 tables, 2 maps.
"""


def labelled_texts() -> list[tuple[str, list[Span]]]:
    out = []
    for line in LABELLED.strip().splitlines():
        text, spans = "", []
        for part in re.split(r"(\{[a-z]+\|[^}]*\})", line):
            if part.startswith("{"):
                kind, inside = part[1:-1].split("|")
                spans.append((kind, len(text), len(text) + len(inside)))
                part = inside
            text += part
        out.append((text, spans))
    return out


class Field:
    """Weights of node features, chain label pairs and skip agreement, by pseudo-likelihood."""

    def __init__(self) -> None:
        graph, truth = Graph(), []
        for text, spans in labelled_texts():
            for i in graph.add(text, base_spans(text)):
                _, s, e, _ = graph.words[i]
                truth.append(next((LABELS.index(k) for k, a, b in spans if a < e and b > s), 0))
        x, y, n = graph.features(), np.array(truth), len(LABELS)
        one = np.eye(n)[y]
        chain, skip = graph.edges()
        left, right, same = (np.zeros((len(y), n)) for _ in range(3))
        np.add.at(left, chain[:, 1], one[chain[:, 0]])
        np.add.at(right, chain[:, 0], one[chain[:, 1]])
        for a, b in (skip.T, skip.T[::-1]):
            np.add.at(same, a, one[b])
        self.node, self.chain, self.skip = np.zeros((FEATURES, n)), np.zeros((n, n)), 0.5
        for _ in range(800):
            logit = x @ self.node + left @ self.chain + right @ self.chain.T + self.skip * same
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            gap = one - p / p.sum(axis=1, keepdims=True)
            self.node += 0.05 * (x.T @ gap - 0.02 * self.node)
            self.chain += 0.05 * (left.T @ gap + gap.T @ right - 0.1 * self.chain)
            self.skip += 0.05 * ((same * gap).sum() - 0.01 * self.skip)
        # Agreement along skip edges never repels.
        self.skip = max(self.skip, 2.0)

    def marginals(self, graph: Graph) -> np.ndarray:
        """Label probabilities of each token by loopy sum-product."""
        n = len(LABELS)
        node = graph.features() @ self.node
        chain, skip = graph.edges()
        ends = np.vstack([chain, skip])
        if not len(ends):
            return _normal(node)
        pair = np.concatenate(
            [np.repeat(self.chain[None], len(chain), 0), np.repeat(self.skip * np.eye(n)[None], len(skip), 0)]
        )
        source = np.concatenate([ends[:, 0], ends[:, 1]])
        target = np.concatenate([ends[:, 1], ends[:, 0]])
        weight = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.roll(np.arange(len(source)), len(ends))
        message = np.zeros((len(source), n))
        for _ in range(ROUNDS):
            belief = node.copy()
            np.add.at(belief, target, message)
            send = (belief[source] - message[back])[:, :, None] + weight
            top = send.max(axis=1)
            new = top + np.log(np.exp(send - top[:, None, :]).sum(axis=1))
            message = 0.5 * message + 0.5 * (new - new.max(axis=1, keepdims=True))
        belief = node.copy()
        np.add.at(belief, target, message)
        return _normal(belief)


def _normal(logit: np.ndarray) -> np.ndarray:
    p = np.exp(logit - logit.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


@lru_cache(maxsize=1)
def model() -> Field:
    return Field()


def added_spans(text: str, words: list[tuple[str, int, int, str]], chance: np.ndarray) -> list[Span]:
    """Spans of neighbouring tokens with the same label that no base span touches."""
    out: list[Span] = []
    for (_, start, end, kind), p in zip(words, chance):
        label = LABELS[int(p.argmax())]
        if kind or label == "none" or p.max() < CERTAIN:
            continue
        if out and out[-1][0] == label == "phone" and not text[out[-1][2] : start].strip():
            out[-1] = (label, out[-1][1], end)
        else:
            out.append((label, start, end))
    return out


def find(texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text, both by kind, then start."""
    graph, parts, bases = Graph(), [], []
    for text in texts:
        base = base_spans(text)
        bases.append(base)
        parts.append(graph.add(text, base))
    chance = model().marginals(graph) if graph.words else np.zeros((0, len(LABELS)))
    out = []
    for text, base, part in zip(texts, bases, parts):
        more = added_spans(text, graph.words[part.start : part.stop], chance[part.start : part.stop])
        out.append((base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))))
    return out


SPANS = "array<struct<kind: string, start: int, stop: int>>"


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) for each row of documents; positions are code points, ends exclusive.

    Null and empty texts have no spans. Each row is labelled on its own whole
    text, so repeated rows give repeated results.
    """

    def run(batch):
        found = find([t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()])
        named = [[[{"kind": k, "start": s, "stop": e} for k, s, e in x] for x in both] for both in found]
        return {"doc_id": batch.column("doc_id"), "base": [n[0] for n in named], "spans": [n[1] for n in named]}

    return map_steps(
        docs.select("doc_id", raw_text().alias("text")), run, f"doc_id bigint, base {SPANS}, spans {SPANS}"
    )


def joined(spans: str) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(load(spark, sf_dir, "documents"))
    counts = [count_of("base", kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )

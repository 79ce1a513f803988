"""Toxicity scores of texts restored through a noisy channel.

Obfuscated spellings become a lattice of characters: a digit or mark may stand
for a letter, a mark or space may have been put between letters, a repeated
letter may be one or two. A Viterbi search finds the likeliest reading under a
character language model, counted over all documents, and the costs of the
channel. Words of the restored text are scored by word beginnings that the
labelled texts tie to toxicity; a logistic model turns the sums into a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm.common import load, map_steps, raw_text, saved, steps

# Bound of the labelled sample: the rows of smallest hash, all of them if fewer.
TRAIN_ROWS = 8000
FOLDS = 4
THRESHOLD = 0.3
# Toxic training texts that must hold a word beginning, and the beginnings kept.
MIN_TEXTS = 5
KEPT_WEIGHTS = 20_000
BEGINNINGS = range(4, 9)

# Symbols of the language model: 0 for anything but letters, 1 to 26 for a to z,
# the rest shared by all other letters according to their code points.
SYMBOLS = 64
CODES = SYMBOLS**3

# The channel: what a sign may stand for, and the cost of each step in nats.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e",
}
BETWEEN = "._*~- "
COST_LEET = 0.7
COST_KEEP = 4.5
COST_DROP = 2.0
# Between single letters a break is rather part of the spelling than the end of a word.
COST_DROP_SPELLED = 0.3
COST_KEEP_SPELLED = 2.5
COST_REPEAT = 0.5
# A longer run of letters and signs is a code, not a spelling of a word.
LONGEST = 64

TRAILING = "!?.,;:\"'()[]{}<>#%&*|/\\-_~=^`…«»"
LEADING = "?.,;:\"'()[]{}<>#%&*/\\-_~=^`…«»"
LETTERS = re.compile(r"[^\W\d_]+")
THRICE = re.compile(r"([^\W\d_])\1\1")
SPELLED = re.compile(r"(?<!\S)[^\W_](?:[ ][^\W_]|[ ][@$!|+€]){3,}(?=[.,;:!?]*(?!\S))")
CUT = re.compile(r"(?<=\S\S)\s+(?=\S\S)")
SIGNS = "[" + re.escape("".join(LEET) + BETWEEN.strip()) + "]"
RUN = re.compile(rf"(?:[^\W_]|{SIGNS})+")
# A sign between letters, before the first or after the last one.
HIDDEN = re.compile(rf"(?:^[0-9@$!|+€]{{1,2}}|[^\W\d_]{SIGNS}+)[^\W\d_]|[^\W\d_][0-9@$]{{1,2}}$")
DOTTED = re.compile(r"[^\W_](?:[._*~-]+[^\W_]){2,}")
PART = 1 << 20
KEPT_TOKENS = 300_000


def symbol(c: str) -> int:
    """Symbol of a lower-case letter."""
    return ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % (SYMBOLS - 27)


_TABLE: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """Symbols of a lower-case text."""
    if not _TABLE:
        table = np.zeros(0x110000, dtype=np.uint8)
        for code in range(0x110000):
            if chr(code).isalpha():
                table[code] = symbol(chr(code))
        _TABLE.append(table)
    return _TABLE[0][np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")]


def triples(text: str) -> np.ndarray:
    """Counts of each symbol after the two before it; a word's first symbols follow boundaries only."""
    s = np.concatenate([[0, 0], symbols(text), [0]]).astype(np.int32)
    p, q, c = s[:-2], s[1:-1], s[2:]
    # Of several signs in a row only the first ends a word.
    real = (c != 0) | (q != 0)
    p = np.where(q == 0, 0, p)
    return np.bincount(((p * SYMBOLS + q) * SYMBOLS + c)[real], minlength=CODES)


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probability of each symbol after each two others, from all documents.

    Tasks add up their counts, Spark adds up the tasks', and a table of a fixed
    size reaches the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES, dtype=np.int64)
        for batch in steps(batches):
            texts = (t.decode("utf-8", "replace").lower() for t in batch.column("text").to_pylist())
            for part in parts("\n".join(texts)):
                total += triples(part)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["code", "n"])

    found = docs.select(raw_text().alias("text")).mapInArrow(run, "code bigint, n bigint")
    counts = np.zeros(CODES)
    for row in found.groupBy("code").agg(F.sum("n").alias("n")).collect():
        counts[row.code] = row.n
    return log_probabilities(counts)


def log_probabilities(counts: np.ndarray, weight: float = 4.0) -> np.ndarray:
    """Three-symbol counts, smoothed by those of two and one symbols."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p = (one + 1) / (one.sum() + SYMBOLS)
    p = (two + weight * p) / (two.sum(axis=1, keepdims=True) + weight)
    p = (three + weight * p) / (three.sum(axis=2, keepdims=True) + weight)
    return np.log(p).astype(np.float32).ravel()


def parts(text: str) -> Iterator[str]:
    """Pieces of about PART characters, cut between words of two characters or more."""
    at = 0
    while len(text) - at > PART:
        found = CUT.search(text, at + PART)
        if not found:
            break
        yield text[at : found.start()]
        at = found.end()
    yield text[at:]


def lattice(run: str, spelled: bool = False) -> Iterator[list[tuple[tuple[int, ...], float, str]]]:
    """For each stretch of equal characters, its readings: symbols, cost and text."""
    at = 0
    while at < len(run):
        c, end = run[at], at + 1
        while end < len(run) and run[end] == c:
            end += 1
        n, at = end - at, end
        if c in LEET:
            read = [
                ((symbol(x),) * k, COST_LEET, x * k) for x in LEET[c] for k in (1, 2) if k <= n
            ] + [((0,), COST_KEEP, c * n)]
            if not c.isdigit():
                read.append(((), COST_DROP, ""))
        elif c in BETWEEN:
            read = [((0,), COST_KEEP_SPELLED * spelled, c * n), ((), COST_DROP_SPELLED if spelled else COST_DROP, "")]
        elif not c.isalpha():
            read = [((0,), 0.0, c * n)]
        elif n > 2:
            read = [((symbol(c),) * k, COST_REPEAT, c * k) for k in (1, 2)]
        else:
            read = [((symbol(c),) * n, 0.0, c * n)]
        yield read


def likeliest(run: str, model: list[float], spelled: bool = False) -> str:
    """The reading of least cost under the language model: Viterbi over the last two symbols.

    spelled says that the run's letters stand alone between spaces or marks.
    """
    done: list[str] = []
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for read in lattice(run, spelled):
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (p, q), (score, path) in states.items():
            for syms, cost, text in read:
                a, b, total = p, q, score - cost
                for s in syms:
                    if s:
                        total += model[(a * SYMBOLS + b) * SYMBOLS + s]
                        a, b = b, s
                    elif b:
                        total += model[(a * SYMBOLS + b) * SYMBOLS]
                        a = b = 0
                held = after.get((a, b))
                if held is None or total > held[0]:
                    after[a, b] = (total, (path, text))
        if len(after) == 1:
            # All readings meet here: what lies before is settled.
            (key, (_, path)), = after.items()
            done.append(_text(path))
            after = {key: (0.0, None)}
        states = after
    _, path = max(
        ((s + (model[(p * SYMBOLS + q) * SYMBOLS] if q else 0.0), path) for (p, q), (s, path) in states.items()),
        key=lambda x: x[0],
    )
    return "".join(done) + _text(path)


def _text(path: tuple | None) -> str:
    out = []
    while path is not None:
        path, text = path
        out.append(text)
    return "".join(reversed(out))


class Reader:
    """Restores texts under one language model; readings of tokens are kept for a while."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.tokens: dict[str, str] = {}

    def token(self, token: str) -> str:
        """A token between white space, restored; plain words stay as they are."""
        if token.isalpha() and not THRICE.search(token):
            return token
        known = self.tokens.get(token)
        if known is None:
            if len(self.tokens) >= KEPT_TOKENS:
                self.tokens.clear()
            known = RUN.sub(self._run, token)
            self.tokens[token] = known
        return known

    def _run(self, match: re.Match) -> str:
        run = match.group()
        core = run.rstrip(TRAILING)
        core = core[: len(core.rstrip("$@+"))] if re.search(r"[$@+]{3,}$", core) else core
        tail = run[len(core) :]
        bare = core.lstrip(LEADING)
        head, core = core[: len(core) - len(bare)], bare
        if not core or core.isdigit() or not LETTERS.search(core):
            return run
        if THRICE.search(core) or (len(core) <= LONGEST and HIDDEN.search(core)):
            core = likeliest(core, self.model, bool(DOTTED.fullmatch(core)))
        return head + core + tail

    def _spelled(self, match: re.Match) -> str:
        return likeliest(match.group(), self.model, True)

    def spaced(self, text: str) -> str:
        """Words spelled with spaces between the letters are joined where that reads better."""
        return SPELLED.sub(self._spelled, text)

    def text(self, text: str) -> str:
        """The whole text in lower case, restored."""
        return re.sub(r"\S+", lambda m: self.token(m.group()), self.spaced(text.lower()))

    def words(self, text: str) -> Counter:
        """Counts of the words of the restored text."""
        out: Counter = Counter()
        for part in parts(text.lower()):
            for token, n in Counter(self.spaced(part).split()).items():
                token = self.token(token)
                if token.isalpha():
                    out[token] += n
                else:
                    for word in LETTERS.findall(token):
                        out[word] += n
        return out


def traits(word: str) -> list[str]:
    """A word's beginnings, and the whole word."""
    return [word[:n] for n in BEGINNINGS if len(word) > n] + [word + " "]


def weight_of(word: str, weights: dict[str, float]) -> float:
    """The largest weight among a word's traits, 0 if none has one."""
    return max((weights.get(t, 0.0) for t in traits(word)), default=0.0)


SUMS = 6


def sums_of(words: Counter, weights: dict[str, float], known: dict[str, float]) -> list[float]:
    """What the logistic model sees of a text: how many weighty words it has, and in how many."""
    n = total = hits = strong = kinds = most = 0.0
    for word, count in words.items():
        n += count
        w = known.get(word)
        if w is None:
            if len(known) >= KEPT_TOKENS:
                known.clear()
            known[word] = w = weight_of(word, weights)
        if w > 0:
            total += w * count
            hits += count
            strong += count * (w > 2.5)
            kinds += 1
            most = max(most, w)
    root = np.sqrt(n + 1)
    return [most, np.log1p(total), total / root, np.log1p(strong), np.log1p(kinds), np.log1p(n)]


@dataclass(frozen=True)
class Model:
    """Language model, weights of traits, and the logistic model over the sums."""

    language: np.ndarray
    weights: dict[str, float]
    mean: np.ndarray
    scale: np.ndarray
    factors: np.ndarray
    base: float

    def score(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.base + ((sums - self.mean) / self.scale) @ self.factors, -30, 30)))


def weights_from(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log odds of a trait in toxic against clean texts, less one standard error; 0 for the rest."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    low = odds - np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    return np.where((toxic >= MIN_TEXTS) & (low > 0.5), low, 0.0)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Factors and base of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w, keep = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def held_out(column: str = "doc_id"):
    """Rows whose labels are never used to fit; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _training_words(docs: DataFrame, labels: DataFrame, language: np.ndarray, rows: int) -> DataFrame:
    """(label, fold, words, counts) of at most `rows` labelled texts outside the held-out fold, stored."""
    chosen = (
        labels.filter(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.avg("toxic").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = (
        docs.select("doc_id", raw_text().alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label").agg(F.min("text").alias("text"))
        # Equal texts are one text, or their words would seem to be many witnesses.
        .groupBy("text").agg(F.avg("label").alias("label"))
        .withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int"))
    )
    shared = docs.sparkSession.sparkContext.broadcast(language)

    def run(batch):
        reader = Reader(shared.value)
        words = [reader.words(t.decode("utf-8", "replace")) for t in batch.column("text").to_pylist()]
        return {
            "label": batch.column("label"),
            "fold": batch.column("fold"),
            "words": [list(w) for w in words],
            "counts": [list(w.values()) for w in words],
        }

    return saved(map_steps(texts, run, "label double, fold int, words array<string>, counts array<bigint>"), "toxic-words")


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Model from all documents' characters and at most `rows` labelled texts outside the held-out fold.

    Several labels of one id are averaged, several texts of one id count as the
    smallest. Null labels and ids without a text are left out. The sums that
    the logistic model learns from use weights of the other folds' texts, so
    that a text's own words do not vouch for it. Without texts of both kinds
    every score is the mean label, without any it is 0.5.
    """
    language = language_model(docs)
    trained = _training_words(docs, labels, language, rows)
    sizes = {(r.fold, r.toxic): r.n for r in trained.groupBy("fold", (F.col("label") >= 0.5).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n = np.array([[sizes.get((k, t), 0) for k in range(FOLDS)] for t in (True, False)])
    if not n.sum(axis=1).all():
        mean = (n[0].sum() + 1) / (n.sum() + 2) if not n.sum() else n[0].sum() / n.sum()
        base = float(np.log((mean + 1e-12) / (1 - mean + 1e-12)))
        return Model(language, {}, np.zeros(SUMS), np.ones(SUMS), np.zeros(SUMS), base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for label, fold, words in zip(*(batch.column(c).to_pylist() for c in ("label", "fold", "words"))):
                held.update({(t, fold + FOLDS * (label < 0.5)) for w in words for t in traits(w)})
        keys = list(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array(list(held.values()), pa.int64())],
            names=["trait", "cell", "n"],
        )

    cells = [F.sum(F.when(F.col("cell") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in range(2 * FOLDS)]
    toxic = sum((F.col(f"n{c}") for c in range(FOLDS)), F.lit(0))
    clean = sum((F.col(f"n{c}") for c in range(FOLDS, 2 * FOLDS)), F.lit(0))
    # The traits are those of a bounded sample; the most telling of them reach the driver.
    tried = (
        trained.mapInArrow(run, "trait string, cell int, n bigint").groupBy("trait").agg(*cells)
        .filter((toxic >= MIN_TEXTS) & (toxic * int(n[1].sum()) > clean * int(n[0].sum())))
        .orderBy((toxic / (clean + 1)).desc(), "trait").limit(KEPT_WEIGHTS).collect()
    )
    names = [r.trait for r in tried]
    count = np.array([[r[f"n{c}"] for c in range(2 * FOLDS)] for r in tried], dtype=np.float64).reshape(-1, 2, FOLDS)
    apart = [weights_from(count[:, 0].sum(axis=1) - count[:, 0, k], count[:, 1].sum(axis=1) - count[:, 1, k], n[0].sum() - n[0, k], n[1].sum() - n[1, k]) for k in range(FOLDS)]
    whole = weights_from(count[:, 0].sum(axis=1), count[:, 1].sum(axis=1), n[0].sum(), n[1].sum())
    by_fold = [{t: float(w) for t, w in zip(names, some) if w > 0} for some in apart]
    shared = docs.sparkSession.sparkContext.broadcast(by_fold)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[dict[str, float]] = [{} for _ in range(FOLDS)]
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("label", "fold", "words", "counts")))
            out = [(label, sums_of(Counter(dict(zip(w, c))), shared.value[k], known[k])) for label, k, w, c in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.float64()), pa.array([x[1] for x in out], pa.list_(pa.float64()))], names=["label", "sums"]
            )

    seen = sorted(tuple([r.label, *r.sums]) for r in trained.mapInArrow(sums, "label double, sums array<double>").collect())
    seen = np.array(seen)
    mean, scale = seen[:, 1:].mean(axis=0), seen[:, 1:].std(axis=0) + 1e-9
    factors, base = logistic((seen[:, 1:] - mean) / scale, seen[:, 0])
    return Model(language, {t: float(w) for t, w in zip(names, whole) if w > 0}, mean, scale, factors, base)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for each row; null and empty texts are scored like any other."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, {}
        reader = Reader(model.language)
        for batch in steps(batches):
            texts = (t.decode("utf-8", "replace") for t in batch.column("text").to_pylist())
            sums = [sums_of(reader.words(t), model.weights, known) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(np.array(sums)))], names=["doc_id", "score"]
            )

    return docs.select("doc_id", raw_text().alias("text")).mapInArrow(run, "doc_id bigint, score double")


def restored(docs: DataFrame, language: np.ndarray) -> DataFrame:
    """(doc_id, text) with each text in lower case and restored; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in steps(batches):
            texts = [reader.text(t.decode("utf-8", "replace")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return docs.select("doc_id", raw_text().alias("text")).mapInArrow(run, "doc_id bigint, text string")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = scored(docs, fit(docs, load(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )

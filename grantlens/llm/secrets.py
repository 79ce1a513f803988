"""Secret scans over a trigram inverted index.

Each rule is a regular expression. Strings that every match must contain are
derived from it as a Boolean query: one of several sets of trigrams must be
there in full. The index holds, for each trigram that any rule asks for, the
documents that contain it. Postings are intersected per rule, and the rule's
expression runs over the candidates only. Rules without a mandatory trigram
run over every document. Only DataFrame functions are used.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm.common import broadcast_if_small, load, saved
from grantlens.llm.pii import count_of, joined

# Alternatives kept apart while a query is derived; beyond that a part counts as any text.
MAX_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """kind, expression, and how to judge a match: group whose length must reach least."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # Runs are maximal, so shorter ones need not be matched to be dropped.
    Rule("hex", r"[0-9a-f]{32,}+", 0, 32),
)
SPAN = "array<struct<kind: string, start: int, stop: int>>"


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Sets of lower-case trigrams; a match holds all trigrams of one set.

    An empty list means that no trigram is mandatory.
    """
    exact, required = _strings(re._parser.parse(pattern))
    texts = _joined(required, exact)
    found = {frozenset(t[i : i + 3] for t in part for i in range(len(t) - 2)) for part in texts}
    if not found or frozenset() in found:
        return []
    # A set that contains another one adds nothing.
    return sorted((s for s in found if not any(o < s for o in found)), key=sorted)


def _joined(parts: list[tuple[str, ...]], ends: list[str]) -> list[tuple[str, ...]]:
    return [p + (e,) for p in parts for e in ends]


def _strings(tree: object) -> tuple[list[str], list[tuple[str, ...]]]:
    """For a sequence: the texts it may end with, and what must stand before them.

    The first are the literal texts being put together at the moment; a part
    that can be anything closes them and starts from the empty text.
    """
    now: list[str] = [""]
    before: list[tuple[str, ...]] = [()]
    for op, value in tree:
        options = _options(str(op), value)
        if options is not None and len(options) * len(now) * len(before) <= MAX_ALTERNATIVES:
            now = sorted({a + b for a in now for b in options})
            continue
        before = sorted(set(_joined(before, now)))
        now = [""]
        inner = _inside(str(op), value)
        if inner:
            before = sorted({a + b for a in before for b in inner})
        if len(before) > MAX_ALTERNATIVES:
            before = [()]
    return now, before


def _options(op: str, value: object) -> list[str] | None:
    """All texts, in lower case, that a small part can match; None if there are too many."""
    if op == "LITERAL":
        return [chr(value).lower()]
    if op == "SUBPATTERN":
        return _sequence(value[3])
    if op == "ATOMIC_GROUP":
        return _sequence(value)
    if op == "BRANCH":
        every = [_sequence(branch) for branch in value[1]]
        return None if None in every else sorted({t for o in every for t in o})
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        low, high, part = value
        inner = _sequence(part)
        if inner is None or int(high) > 2 or len(inner) > 4:
            return None
        out = {""} if low == 0 else set()
        made = [""]
        for n in range(1, int(high) + 1):
            made = [a + b for a in made for b in inner]
            if n >= low:
                out |= set(made)
        return sorted(out)
    if op == "IN" and all(str(o) == "LITERAL" for o, _ in value) and len(value) <= 4:
        return sorted({chr(v).lower() for _, v in value})
    if op == "AT":
        return [""]
    return None


def _sequence(tree: object) -> list[str] | None:
    out = [""]
    for op, value in tree:
        options = _options(str(op), value)
        if options is None or len(options) * len(out) > MAX_ALTERNATIVES:
            return None
        out = sorted({a + b for a in out for b in options})
    return out


def _inside(op: str, value: object) -> list[tuple[str, ...]]:
    """What a larger part must contain, as alternatives of texts."""
    if op == "SUBPATTERN":
        exact, before = _strings(value[3])
        return _joined(before, exact)
    if op == "BRANCH":
        return [p for branch in value[1] for p in _joined(*reversed(_strings(branch)))]
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] >= 1:
        exact, before = _strings(value[2])
        return _joined(before, exact)
    return []


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Stored postings (trigram, row) of the asked trigrams, over whole lower-cased texts."""
    low = docs.select(row_key().alias("row"), F.lower("text").alias("low"))
    has = F.array_compact(F.array(*[F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams]))
    each = low.select("row", F.explode(has).alias("trigram"))
    return saved(each.select("trigram", "row"), "trigram-postings")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(row, kinds): rows whose postings satisfy a rule's query.

    The rules' trigram sets, of fixed size, are broadcast; a row answers a set
    if it has as many of its trigrams as the set holds.
    """
    asked = [
        (rule.kind, n, len(part), t)
        for rule in rules
        for n, part in enumerate(trigram_query(rule.pattern))
        for t in sorted(part)
    ]
    sets = index.sparkSession.createDataFrame(asked, "kind string, part int, need int, trigram string")
    met = index.join(F.broadcast(sets), "trigram").groupBy("row", "kind", "part", "need")
    met = met.agg(F.count_distinct("trigram").alias("n")).filter("n = need")
    return met.groupBy("row").agg(F.collect_set("kind").alias("kinds"))


def rule_spans(text: Column, rule: Rule) -> Column:
    """Spans of the rule's leftmost matches that do not overlap, failing ones left out.

    Matches and the pieces between them alternate, so positions are sums of
    their lengths in code points.
    """
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    pieces = F.split(text, rule.pattern, -1)
    judged = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(state: Column, i: Column) -> Column:
        begin = state["at"] + F.char_length(F.get(pieces, i))
        end = begin + F.char_length(F.get(matches, i))
        good = F.char_length(F.get(judged, i)) >= rule.least
        one = F.struct(F.lit(rule.kind).alias("kind"), begin.alias("start"), end.alias("stop"))
        return F.struct(
            end.alias("at"), F.when(good, F.concat(state["spans"], F.array(one))).otherwise(state["spans"]).alias("spans")
        )

    places = F.when(F.size(matches) > 0, F.sequence(F.lit(0), F.size(matches) - 1))
    found = F.aggregate(F.coalesce(places, F.array().cast("array<int>")), start, step)
    return found["spans"]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) for each row of documents: spans by start, then rule order.

    Positions are code points, ends exclusive. Null and empty texts have no
    spans; repeated rows give repeated results; an empty table gives an empty
    result.
    """
    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    full = [r for r in rules if r not in indexed]
    trigrams = sorted({t for r in indexed for part in trigram_query(r.pattern) for t in part})
    rows = docs.select("doc_id", row_key().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    none = F.array().cast(SPAN)
    if indexed:
        index = trigram_index(docs, trigrams)
        chosen = broadcast_if_small(saved(candidates(index, indexed), "rule-candidates"), "kinds")
        rows = rows.join(chosen, "row", "left")
    parts = [
        F.when(F.array_contains("kinds", r.kind), rule_spans(F.col("text"), r)).otherwise(none) for r in indexed
    ]
    # A test without building arrays comes first where every text is scanned.
    parts += [F.when(F.col("text").rlike(r.pattern), rule_spans(F.col("text"), r)).otherwise(none) for r in full]
    order = {r.kind: n for n, r in enumerate(rules)}
    kinds = F.create_map(*[x for k, n in order.items() for x in (F.lit(k), F.lit(n))])
    keyed = F.transform(
        F.concat(*parts),
        lambda s: F.struct(
            s["start"].alias("start"), kinds[s["kind"]].alias("nth"), s["kind"].alias("kind"), s["stop"].alias("stop")
        ),
    )
    spans = F.transform(
        F.array_sort(keyed),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")),
    )
    return rows.select("doc_id", spans.alias("spans"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(load(spark, sf_dir, "documents"))
    counts = [count_of("spans", r.kind).alias(f"n_{r.kind}") for r in RULES]
    return found.select("doc_id", *counts, joined("spans").alias("spans")).select(
        "doc_id",
        *[f"n_{r.kind}" for r in RULES],
        F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


def _kind_sql(nth: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("}+", "}").replace("'", "''")
    return f"""
  SELECT doc_id, {nth} AS nth, '{rule.kind}' AS kind, length(judged[i]) AS size,
    list_sum([length(x) FOR x IN pieces[1 : i]])
      + coalesce(list_sum([length(x) FOR x IN matches[1 : i - 1]]), 0) AS s, length(matches[i]) AS n
  FROM (
    SELECT doc_id, pieces, matches, judged, unnest(range(1, len(matches) + 1)) AS i
    FROM (
      SELECT doc_id, string_split_regex(t, '{pattern}') AS pieces,
        regexp_extract_all(t, '{pattern}') AS matches,
        regexp_extract_all(t, '{pattern}', {rule.group}) AS judged
      FROM d WHERE regexp_matches(t, '{pattern}')
    ) AS x
  ) AS y WHERE length(judged[i]) >= {rule.least}"""


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_kind_sql(n, r) for n, r in enumerate(RULES))}
), joined AS (
  SELECT doc_id, string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, nth) AS spans,
    {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in RULES)}
  FROM found GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in RULES)},
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN joined USING (doc_id)
"""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from grantlens.config import DEFAULT_CONFIG as CFG
from grantlens.config import fiscal_year_of
from grantlens.functions import classify, flags, numbers, text
from grantlens.plans.institutions import valid_ueis
from tests.helpers import day, frame


def apply(spark, schema, rows, expression):
    df = frame(spark, schema, rows)
    return [r.v for r in df.select(expression.alias("v")).collect()]


def test_directorate_codes_are_exact_texts(spark):
    rows = [{"c": c} for c in ["47.050", "47.05", None, "47.084", " 47.050"]]
    assert apply(spark, "c string", rows, classify.directorate_of(F.col("c"))) == [
        "GEO", "OTHER", "OTHER", "TIP", "OTHER",
    ]


def test_numeric_codes_can_be_repaired(spark):
    assert apply(spark, "c double", [{"c": 47.05}], classify.cfda_text(F.col("c"))) == ["47.050"]


def test_directorate_vocabularies_meet(spark):
    rows = [{"c": c} for c in ["NSF-CSE", "CISE", " stem education ", "Office of Polar Programs", "Misc", None]]
    assert apply(spark, "c string", rows, classify.directorate_code(F.col("c"))) == [
        "CISE", "CISE", "EDU", "OPP", "Misc", None,
    ]


def test_first_topic_rule_wins_and_matches_inside_words(spark):
    titles = ["Training systems", "Climate teacher", None, "A DATABASE", "Fossil birds"]
    rows = [{"t": t} for t in titles]
    assert apply(spark, "t string", rows, classify.topic_of(F.col("t"))) == [
        "education / training",
        "climate / environment",
        "other / uncategorized",
        "computing / AI",
        "other / uncategorized",
    ]


def test_title_case_starts_words_at_any_other_character(spark):
    rows = [{"n": "O'NEIL-SMITH A&M  COLLEGE"}, {"n": "école 3d-LAB"}]
    assert apply(spark, "n string", rows, text.display_name(F.col("n"))) == [
        "O'Neil-Smith A&M College",
        "École 3d-Lab",
    ]


def test_canonical_names_with_and_without_word_edges(spark):
    rows = [
        {"n": "UNIVERSITY OF NEW MEXICO"},
        {"n": "THE UNIVERSITY OF SAN FRANCISCO"},
        {"n": "Foo College, Inc."},
    ]
    assert apply(spark, "n string", rows, text.canonical_name(F.col("n"))) == [
        "UNIVERSITY OF NEW MEXI",
        "UNIVERSITY OF SAN FRANCIS",
        "FOO COLLEGE",
    ]
    assert apply(spark, "n string", rows, text.canonical_name(F.col("n"), strict=True)) == [
        "UNIVERSITY OF NEW MEXICO",
        "UNIVERSITY OF SAN FRANCISCO",
        "FOO COLLEGE",
    ]


def test_academic_names(spark):
    names = ["a University", "Polytechnic X", "MIT institute of technology", "RAND", None]
    rows = [{"n": n} for n in names]
    found = apply(spark, "n string", rows, text.is_academic(F.col("n"), CFG.academic_keywords))
    assert found == [True, True, True, False, False]


def test_termination_activity_texts(spark):
    rows = [
        {},
        {"r": "TRUE", "t": "true"},
        {"r": "False", "t": "FALSE"},
        {"r": "false", "t": "true"},
    ]
    expression = flags.termination_active(F.col("r"), F.col("t"))
    assert apply(spark, "r string, t string", rows, expression) == [False, True, True, False]


def test_period_status_edges(spark):
    today = CFG.as_of
    rows = [
        {"s": None, "e": None},
        {"s": today + dt.timedelta(1), "e": today + dt.timedelta(9)},
        {"s": day("2020-01-01"), "e": today},
        {"s": day("2020-01-01"), "e": day("2025-04-06")},
        {"s": day("2020-01-01"), "e": day("2025-04-05")},
    ]
    expression = flags.period_status(F.col("s"), F.col("e"), CFG)
    assert apply(spark, "s date, e date", rows, expression) == [
        "unknown",
        "not_yet_started",
        "in_progress",
        "ended_under_1yr",
        "ended_over_1yr",
    ]


def test_open_opportunities_without_close_date(spark):
    rows = [
        {"a": True, "p": day("2024-10-06")},
        {"a": True, "p": day("2024-10-05")},
        {"a": True, "c": CFG.as_of, "p": day("2000-01-01")},
        {"a": False, "c": CFG.as_of, "p": day("2026-01-01")},
    ]
    expression = F.coalesce(
        flags.currently_open(F.col("a"), F.col("c"), F.col("p"), CFG), F.lit(False)
    )
    assert apply(spark, "a boolean, c date, p date", rows, expression) == [True, False, True, False]


def test_agency_scope_prefix_positions(spark):
    rows = [
        {"c": "47.041"},
        {"c": "10.001,47.076"},
        {"c": "10.001, 47.076"},
        {"k": "NSF-BIO"},
        {"n": "U.S. National Science Foundation"},
        {},
    ]
    scope = flags.in_agency_scope(F.col("n"), F.col("k"), F.col("c"))
    expression = F.coalesce(scope, F.lit(False))
    assert apply(spark, "n string, k string, c string", rows, expression) == [
        True, True, False, True, True, False,
    ]


def test_award_status_without_reinstatement_is_terminated(spark):
    rows = [{}, {"i": 1}, {"i": 2, "r": True}, {"i": 3, "r": False}]
    expression = flags.award_status(F.col("i"), F.col("r"))
    assert apply(spark, "i long, r boolean", rows, expression) == [
        "Active", "Terminated", "Reinstated", "Terminated",
    ]


def test_rounding_is_half_away_from_zero(spark):
    rows = [{"x": x} for x in [2.35, -2.35, 0.125, 1e9 + 0.005]]
    assert apply(spark, "x double", rows, numbers.round_half_up(F.col("x"), 1))[:2] == [2.4, -2.4]
    assert apply(spark, "x double", rows, numbers.money(F.col("x")))[2:] == [0.13, 1e9 + 0.01]


def test_percent_of_nothing_is_null(spark):
    rows = [{"a": 1.0, "b": 0.0}, {"a": 1.0, "b": 4.0}, {"a": 1.0}]
    expression = numbers.percent(F.col("a"), F.col("b"))
    assert apply(spark, "a double, b double", rows, expression) == [None, 25.0, None]


@pytest.mark.parametrize(
    ("request_text", "ids"),
    [
        ("ABC123DEF456", ["ABC123DEF456"]),
        ("ABC123DEF456,AAAAAAAAAAAA", ["ABC123DEF456", "AAAAAAAAAAAA"]),
        ("ABC123DEF456,", ["ABC123DEF456"]),
        ("ABC123DEF456,abc", []),
        ("ABC123DEF456,,", []),
        ("ABC123DEF456\n", []),
        ("", []),
    ],
)
def test_requested_ids_are_validated_together(request_text, ids):
    assert valid_ueis(request_text) == ids


def test_fiscal_years():
    assert fiscal_year_of(day("2024-09-30")) == 2024
    assert fiscal_year_of(day("2024-10-01")) == 2025
    assert flags.fiscal_years_of(CFG.prior_half) == (2025, 2025)
    assert flags.fiscal_years_of(CFG.timeline) == (2025, 2026)

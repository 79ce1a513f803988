from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from grantlens.config import DEFAULT_CONFIG as CFG
from grantlens.plans import baselines, changes, dashboard, institutions, silver, views
from tests.helpers import (
    awards,
    column,
    day,
    opportunities,
    frame,
    plan,
    recipients,
    records,
    terminations,
    transactions,
)


def scope(spark, fains, start="2024-01-01", end="2027-01-01"):
    """Awards with the given FAINs, all of one academic recipient."""
    held = awards(
        spark,
        *[
            {
                "award_unique_key": f"A-{f}",
                "award_id_fain": f,
                "recipient_uei": "U1",
                "awarding_sub_agency_name": "BIO",
                "period_of_perf_start": day(start),
                "period_of_perf_end": day(end),
            }
            for f in fains
        ],
    )
    return held, recipients(spark, {"recipient_uei": "U1", "recipient_name": "X University"})


def act(key, date, kind, amount, uei="U1", directorate="BIO", award="A1"):
    return {
        "transaction_unique_key": key,
        "award_unique_key": award,
        "recipient_uei": uei,
        "action_date": day(date),
        "action_type_description": kind,
        "federal_action_obligation": amount,
        "awarding_sub_agency_name": directorate,
    }


def test_unmatched_terminations_count_by_directorate_only(spark):
    held, people = scope(spark, ["F1"])
    cut = terminations(
        spark,
        {"award_id_fain": "F1", "post_termination_deobligation": -5.0, "reinstated": True},
        {"award_id_fain": None, "directorate": "D", "nsf_total_budget": 7.0},
        {"award_id_fain": None, "directorate": None},
    )
    by_directorate = views.disruption_by_directorate(cut, held)
    assert records(
        by_directorate, "directorate", "n_terminated_awards", "total_deobligated", "n_reinstated"
    ) == [("BIO", 1, 5.0, 1), ("D", 1, 0.0, 0), (None, 1, 0.0, 0)]
    by_recipient = views.disruption_by_recipient(cut, held, people)
    assert records(by_recipient, "recipient_uei", "n_terminated_awards") == [("U1", 1)]


def test_disbursement_is_capped_and_may_be_negative(spark):
    pairs = [(120.0, 100.0), (-5.0, 100.0), (None, 100.0), (5.0, 0.0), (1.0, 3.0)]
    held = awards(
        spark,
        *[
            {
                "award_unique_key": str(i),
                "total_outlayed_amount": paid,
                "total_obligated_amount": owed,
            }
            for i, (paid, owed) in enumerate(pairs)
        ],
    )
    assert records(views.disbursement_progress(held), "award_unique_key", "pct_disbursed") == [
        ("0", 100.0),
        ("1", -5.0),
        ("4", 33.3),
    ]


def test_resilience_needs_awards_in_the_prior_half(spark):
    acts = transactions(
        spark,
        act("1", "2024-11-01", "NEW", 100.0),
        act("2", "2025-11-01", "NEW", 25.0),
        act("3", "2025-11-01", "NEW", 25.0, directorate="ENG"),
        act("4", "2024-11-01", "REVISION", 25.0, directorate="GEO"),
    )
    offers = opportunities(
        spark,
        {"opportunity_id": "1", "cfda_numbers": "47.074,47.041", "is_active": True, "close_date": CFG.as_of},
    )
    got = views.directorate_resilience(acts, offers)
    assert records(got, "directorate", "n_open_opportunities", "pct_dollar_retained") == [
        ("BIO", 1, 25.0)
    ]


def test_monthly_net_is_gross_minus_clawback(spark):
    acts = transactions(
        spark,
        act("1", "2025-01-05", "NEW", 100.0),
        act("2", "2025-01-31", "REVISION", -30.25),
        act("3", "2025-02-01", "REVISION", 0.0),
    )
    got = views.monthly_obligations(acts).collect()
    assert [(r.month, r.net_obligation, r.gross_obligated, r.gross_deobligated) for r in got] == [
        (day("2025-01-01"), 69.75, 100.0, 30.25),
        (day("2025-02-01"), 0.0, 0.0, 0.0),
    ]
    assert [r.n_deobligations for r in got] == [1, 0]


def test_plans_take_decimal_amounts(spark):
    held, people = scope(spark, ["F1"])
    acts = transactions(
        spark,
        act("1", "2025-01-05", "NEW", 0.1),
        act("2", "2025-01-06", "NEW", 0.2),
        act("3", "2025-01-07", "REVISION", -7.0),
    )
    cut = terminations(spark, {"award_id_fain": "F1", "post_termination_deobligation": -0.3})

    def results(convert):
        a, t, h = convert(acts), convert(cut), convert(held)
        return [
            [tuple(r) for r in df.collect()]
            for df in [
                views.monthly_obligations(a),
                views.disruption_by_directorate(t, h),
                dashboard.phase_timeline(a, t, h, people),
                dashboard.termination_totals(t, h, people),
                institutions.institution_summary(
                    institutions.institution_portfolio(people, h, t)
                ),
            ]
        ]

    assert results(silver.with_exact_money) == results(lambda df: df)


def test_timeline_fills_gaps_with_zeros(spark):
    held, people = scope(spark, ["F1"])
    acts = transactions(
        spark,
        act("1", "2025-01-10", "NEW", 2e6),
        act("2", "2025-01-11", "NEW", -1e6),
        act("3", "2025-02-10", "REVISION", -3e6),
        act("4", "2025-04-10", "REVISION", 3e6),
        act("5", "2024-12-31", "NEW", 3e6),
        act("6", "2025-01-10", "NEW", 9e6, uei="U2"),
    )
    cut = terminations(
        spark,
        {"award_id_fain": "F1", "latest_termination_date": day("2025-03-05")},
        {"award_id_fain": None, "latest_termination_date": day("2025-03-05")},
        {"award_id_fain": "F1", "latest_termination_date": day("2026-04-01")},
    )
    got = dashboard.phase_timeline(acts, cut, held, people)
    assert records(got, "month", "n_new", "new_m", "clawback_m", "n_terms") == [
        (day("2025-01-01"), 2, 2.0, 1.0, 0),
        (day("2025-02-01"), 0, 0.0, 3.0, 0),
        (day("2025-03-01"), 0, 0.0, 0.0, 1),
    ]


def test_half_year_change_on_both_bases(spark):
    held, people = scope(spark, ["F1"])
    acts = transactions(
        spark,
        act("1", "2024-10-10", "NEW", 100.0),
        act("2", "2025-02-10", "NEW", 50.0),
        act("3", "2025-11-10", "NEW", 75.0),
    )
    timeline = dashboard.phase_timeline(acts, terminations(spark), held, people)
    got = dashboard.half_year_change(timeline, acts, people, CFG)
    assert records(got, "basis", "prior", "current", "change_pct") == [
        ("full", 150.0, 75.0, -50.0),
        ("series", 50.0, 75.0, 50.0),
    ]


def test_headline_figures_without_data(spark):
    held, people = scope(spark, ["F1"])
    acts, cut = transactions(spark), terminations(spark)
    totals = dashboard.termination_totals(cut, held, people)
    timeline = dashboard.phase_timeline(acts, cut, held, people)
    halves = dashboard.half_year_change(timeline, acts, people, CFG)
    pre_post = dashboard.pre_post_by_directorate(acts, held, cut, people)
    (row,) = dashboard.headline_kpis(totals, halves, pre_post).collect()
    assert (row.n_terms, row.change_series_pct, row.edu_post_pct) == (0, None, None)


def test_pre_post_counts_each_award_once(spark):
    held, people = scope(spark, ["F1", "F2", "F3"])
    acts = transactions(
        spark, act("1", "2024-11-01", "NEW", 4e6), act("2", "2025-11-01", "NEW", 1e6)
    )
    cut = terminations(spark, {"award_id_fain": "F1"}, {"award_id_fain": "F1"})
    got = dashboard.pre_post_by_directorate(acts, held, cut, people)
    assert records(
        got, "dir", "pre_drop_pct", "fy25h1_m", "n_awards", "n_terms", "post_term_pct"
    ) == [("BIO", 75.0, 4.0, 3, 2, 66.67)]


def test_topic_counts_add_up(spark):
    held, people = scope(spark, [f"F{i}" for i in range(6)])
    titles = ["Climate", "Solar", None, "Teacher", "Climate change", "Fossils"]
    cut = terminations(
        spark,
        *[
            {"award_id_fain": f"F{i}", "project_title": t, "reinstated": i % 2 == 0}
            for i, t in enumerate(titles)
        ],
    )
    got = dashboard.topic_recovery(cut, held, people).collect()
    total = dashboard.termination_totals(cut, held, people).collect()[0]
    assert sum(r.n_terms for r in got) == total.n_terms == 6
    assert {r.topic: r.pct_reinst for r in got}["climate / environment"] == 100.0


def test_top_programs_break_ties_by_name(spark):
    cfg = dataclasses.replace(CFG, program_min_terminations=2, program_top_k=2)
    programs = ["C", "C", "A", "A", "B", "B", "Z"]
    held, people = scope(spark, [f"F{i}" for i in range(len(programs))])
    cut = terminations(
        spark,
        *[{"award_id_fain": f"F{i}", "nsf_program_name": p} for i, p in enumerate(programs)],
    )
    got = dashboard.top_programs(cut, held, people, cfg)
    assert column(got, "program") == ["A", "B"]
    assert set(column(got, "directorate")) == {"(none)"}


def test_boxplot_lists_topics_in_display_order(spark):
    held, people = scope(spark, [f"F{i}" for i in range(11)])
    values = [("Solar", d) for d in [1, 2, 3, 4, 50]] + [("Teacher", d) for d in [1, 2, 3, 4, 10, 11]]
    cut = terminations(
        spark,
        *[
            {
                "award_id_fain": f"F{i}",
                "project_title": title,
                "reinstated": True,
                "latest_termination_date": day("2025-05-01"),
                "reinstatement_date": day(f"2025-{5 + d // 32:02d}-{1 + d:02d}")
                if d < 31
                else day("2025-06-20"),
            }
            for i, (title, d) in enumerate(values)
        ],
    )
    days = dashboard.reinstatement_days(cut, held, people)
    box = dashboard.reinstatement_boxplot(days, spark).collect()
    assert [(r.topic, r.low, r.q1, r.median, r.q3, r.high) for r in box] == [
        ("education / training", 1.0, 2.0, 3.5, 10.0, 11.0),
        ("energy", 1.0, 2.0, 3.0, 4.0, 4.0),
    ]
    assert records(dashboard.reinstatement_outliers(days), "topic", "days") == [("energy", 50)]


def portfolio_case(spark):
    people = recipients(
        spark,
        {"recipient_uei": "U1", "recipient_name": "THE FOO COLLEGE DISTRICT", "state_code": "TX"},
        {"recipient_uei": "U2", "recipient_name": "Foo  College", "state_code": "TX"},
        {"recipient_uei": "U3", "recipient_name": "Bar University"},
        {"recipient_uei": "U4", "recipient_name": "Acme LLC"},
    )
    held = awards(
        spark,
        *[
            {
                "award_unique_key": f"A{i}",
                "award_id_fain": f"F{i}",
                "recipient_uei": uei,
                "awarding_sub_agency_name": directorate,
                "total_obligated_amount": amount,
                "period_of_perf_start": day("2025-01-01"),
                "period_of_perf_end": day("2025-12-31") if i != 3 else None,
            }
            for i, (uei, directorate, amount) in enumerate(
                [("U1", "ENG", 10.0), ("U2", "BIO", 20.0), ("U2", "BIO", None), ("U3", "GEO", 5.0), ("U4", "ENG", 1.0)]
            )
        ],
    )
    cut = terminations(
        spark,
        {"award_id_fain": "F0", "latest_termination_date": day("2025-05-01"), "post_termination_deobligation": -4.0},
        {"award_id_fain": "F0", "latest_termination_date": day("2025-06-01"), "reinstated": True},
        {"award_id_fain": "F1"},
        {"award_id_fain": "F2", "reinstated": False},
    )
    return people, held, cut


def test_names_merge_into_one_institution(spark):
    people, held, cut = portfolio_case(spark)
    got = institutions.institution_choices(people, held, cut)
    assert records(got, "canonical_name", "state_code", "display_name", "ueis", "n_terminations") == [
        ("BAR UNIVERSITY", "?", "Bar University", "U3", 0),
        ("FOO COLLEGE", "TX", "Foo College", "U1,U2", 4),
    ]
    members = institutions.institutions_with_awards(people, held, cut)
    listed = institutions.institution_list(members)
    assert records(institutions.with_ueis(listed, members), *got.columns) == records(got, *got.columns)

    def search(*args, **more):
        return institutions.institution_search(listed, members, institutions.label_grams(listed), *args, **more)

    assert column(search("foo"), "label") == ["Foo College — TX (4 terminated)"]
    assert column(search(state="?"), "label") == ["Bar University — ?"]
    assert column(search(state="ALL", terminations_only=True), "ueis") == ["U1,U2"]


@pytest.mark.parametrize("text", ["", "a", "AR", "bar", "Universit", "y — t", "aaa", "aaaa", "bar University of", "100%", "o'", "x (1"])
def test_label_index_finds_what_a_scan_finds(spark, text):
    labels = ["Bar University — TX", "bar university of aaa — ?", "Baaab O'Neil — S1 (12 terminated)", "100% (1) x (1", "ab", "Unrelated — OK", "Universit bar — S2"]
    rows = [{"canonical_name": str(k), "state_code": "S", "display_name": x, "label": x} for k, x in enumerate(labels)]
    listed = frame(spark, "canonical_name string, state_code string, display_name string, n_variants long, n_terminations long, label string", rows)
    got = institutions.labels_with(listed, institutions.label_grams(listed), text)
    assert records(got, "label") == sorted(((x,) for x in labels if text.lower() in x.lower()), key=str)


def test_search_reads_postings_of_a_few_grams(spark):
    from grantlens.driver import registry

    df = contract.queries()["d9_institution_search"](spark, "/root/testdata/sf0.001")
    store = registry.store_for(spark, "/root/testdata/sf0.001")
    # Runs of the text are looked for in the postings, whose files are dealt by run.
    postings = next(line for line in plan(df).splitlines() if "FileScan" in line and "gram#" in line)
    assert "gram#" in postings.split("DataFilters: ")[1] and "Bucketed" in postings
    assert not any(f.startswith(store.path("institutions") + "/") for f in df.inputFiles())


def test_portfolio_repeats_awards_per_termination(spark):
    people, held, cut = portfolio_case(spark)
    rows = institutions.institution_portfolio(people, held, cut)
    assert records(rows, "fain", "status") == [
        ("F0", "Reinstated"),
        ("F0", "Terminated"),
        ("F1", "Terminated"),
        ("F2", "Terminated"),
        ("F3", "Active"),
    ]
    latest = institutions.institution_portfolio(people, held, cut, latest_only=True)
    assert records(latest.filter("fain = 'F0'"), "status") == [("Reinstated",)]
    ordered = institutions.in_display_order(rows).filter("canonical_name = 'FOO COLLEGE'")
    assert column(ordered, "status") == ["Terminated"] * 3 + ["Reinstated"]


def test_summary_breaks_directorate_ties_by_name(spark):
    people, held, cut = portfolio_case(spark)
    rows = institutions.institution_portfolio(people, held, cut)
    summary = {r.canonical_name: r for r in institutions.institution_summary(rows).collect()}
    foo, bar = summary["FOO COLLEGE"], summary["BAR UNIVERSITY"]
    assert (foo.most_dir, foo.most_dir_n, foo.n_term, foo.n_reinst) == ("BIO", 2, 4, 1)
    assert (foo.n_at_risk, foo.pct_term, foo.net_deob, foo.active_funding) == (4, 100.0, 4.0, 10.0)
    assert (bar.most_dir, bar.n_at_risk, bar.pct_term, bar.active_funding) == ("None", 0, 0.0, 5.0)
    (top,) = institutions.largest_termination(rows).collect()
    assert (top.obligated, top.text) == (20.0, "Largest single termination: (unknown) ($0.00M obligated).")
    assert records(institutions.funding_by_directorate(rows), "dir", "n") == [("ENG", 1), ("GEO", 1)]
    assert column(institutions.institution_terminations(rows), "reinstated") == ["—"] * 4


def test_malformed_request_voids_the_portfolio(spark):
    people, held, cut = portfolio_case(spark)
    assert institutions.institution_portfolio(people, held, cut, ueis="U1").count() == 0


def pull(spark, *rows):
    return opportunities(spark, *rows)


def test_snapshot_differences(spark):
    old = pull(
        spark,
        {"opportunity_id": "1", "title": "a", "award_floor": 1.0},
        {"opportunity_id": "2", "title": "b", "close_date": day("2026-01-01")},
        {"opportunity_id": "3", "title": "c"},
    )
    new = pull(
        spark,
        {"opportunity_id": "1", "title": "a", "award_floor": 1.0},
        {"opportunity_id": "2", "title": "B"},
        {"opportunity_id": "4", "title": "d"},
    )
    log = changes.change_log(changes.diff_snapshots(old, new, 2))
    assert records(
        log, "opportunity_id", "change_type", "field_changed", "old_value", "new_value"
    ) == [
        ("2", "MODIFIED", "close_date", "2026-01-01", None),
        ("2", "MODIFIED", "title", "b", "B"),
        ("3", "REMOVED", None, None, None),
        ("4", "ADDED", None, None, None),
    ]
    assert sorted(column(log, "change_id")) == [1, 2, 3, 4]
    gone = views.rescinded_opportunities(log, old, awards(spark, {"cfda_number": "47.041"}))
    assert records(gone, "opportunity_id", "has_matching_award") == [("3", False)]


def test_snapshot_register(spark):
    entry = changes.snapshot_entry(pull(spark, {"opportunity_id": "1"}), 7, "note")
    assert records(entry, "snapshot_id", "record_count", "notes") == [(7, 1, "note")]


def test_baseline_leaves_out_exclusions_and_later_months(spark):
    people = recipients(spark, {"recipient_uei": "U1", "recipient_name": "X University"})
    acts = transactions(
        spark,
        act("1", "2023-02-10", "NEW", 2e6),
        act("2", "2024-02-10", "NEW", 4e6),
        act("3", "2024-02-11", "NEW", 500e6, directorate="TIP"),
        act("4", "2025-05-10", "NEW", 9e6),
        act("5", "2026-02-10", "NEW", 1e6),
        act("6", "2026-02-10", "NEW", 1e6, directorate="TIP"),
        act("7", "2025-10-10", "NEW", 1e6),
    )
    got = baselines.same_month_baseline(acts, people)
    assert records(got, "month", "total_m", "n_baseline", "baseline_mean_m", "baseline_sd_m", "position") == [
        (day("2025-10-01"), 1.0, None, None, None, None),
        (day("2026-02-01"), 2.0, 2, 3.0, 1.41, "within"),
    ]


@pytest.mark.parametrize(
    ("amount", "tracked", "flagged"),
    [(-100_000.0, False, False), (-100_001.0, False, True), (-100_001.0, True, False)],
)
def test_untracked_disruption_threshold(spark, amount, tracked, flagged):
    held, _ = scope(spark, ["F1"])
    acts = transactions(
        spark,
        act("1", "2025-05-01", "REVISION", amount, award="A-F1"),
        act("2", "2025-04-30", "REVISION", -9e9, award="A-F1"),
    )
    cut = terminations(spark, {"award_id_fain": "F1" if tracked else None})
    assert baselines.untracked_disruption(acts, held, cut).count() == int(flagged)


def test_state_exposure(spark):
    people, held, cut = portfolio_case(spark)
    got = baselines.state_exposure(held, cut, people)
    assert records(got, "state_code", "n_awards", "n_terms", "term_pct") == [("TX", 3, 4, 133.33)]


def test_views_are_registered(spark):
    people, held, cut = portfolio_case(spark)
    offers = opportunities(spark, {"opportunity_id": "1", "title": "t"})
    log = changes.change_log(changes.diff_snapshots(offers, offers.limit(0), 2))
    names = views.register_views(offers, held, transactions(spark), cut, people, log)
    assert len(names) == 9
    assert spark.sql("SELECT count(*) AS n FROM v_rescinded_opportunities").collect()[0].n == 1
    assert spark.table("v_awards_with_quality").filter(F.col("pop_status") == "unknown").count() == 1


def test_snapshot_diff_sees_every_change_of_an_amount(spark):
    old = opportunities(spark, {"opportunity_id": "1", "award_ceiling": 5.0}, {"opportunity_id": "2", "award_ceiling": 1e17},
                        {"opportunity_id": "3", "award_ceiling": 7.5})
    new = opportunities(spark, {"opportunity_id": "1", "award_ceiling": 5.001}, {"opportunity_id": "2", "award_ceiling": 2e300},
                        {"opportunity_id": "3", "award_ceiling": 7.5})
    rows = records(changes.diff_snapshots(old, new, 2), "opportunity_id", "old_value", "new_value")
    assert rows == [("1", "5.00", "5.001"), ("2", "100000000000000000.00", "2.0E300")]


def test_a_loss_just_beyond_the_threshold_counts(spark):
    rows = transactions(spark, {"award_unique_key": "A", "action_date": day("2025-06-01"), "federal_action_obligation": -100000.004})
    known = awards(spark, {"award_unique_key": "A", "award_id_fain": "F"})
    assert baselines.untracked_disruption(rows, known, terminations(spark)).count() == 1


def test_dates_and_amounts_must_be_written_in_full(spark):
    frame_ = spark.createDataFrame([("2025",), ("2025-04",), ("04/18/2025",), ("5d",), (" 2025-04-18 ",), ("1e3",), ("-.5",)], "t string")
    got = frame_.select(silver.text_date(F.col("t")).alias("d"), silver.text_amount(F.col("t")).alias("n")).collect()
    assert [r.d for r in got] == [None] * 4 + [day("2025-04-18"), None, None]
    assert [r.n for r in got] == [2025.0, None, None, None, None, 1000.0, -0.5]
    us = frame_.select(silver.text_date(F.col("t"), ("yyyy-MM-dd", "MM/dd/yyyy")).alias("d")).collect()
    assert us[2].d == us[4].d == day("2025-04-18")


def test_long_id_lists_find_the_same_awards(spark, monkeypatch):
    ids = [f"U{i:011d}" for i in range(60)]
    held = awards(spark, *[{"award_unique_key": str(i), "recipient_uei": u} for i, u in enumerate(ids * 2)])
    request = ",".join(ids[:55])
    long = records(institutions.awards_of(held, request), "award_unique_key", "recipient_uei")
    monkeypatch.setattr(institutions, "FILTER_IDS", 100)
    assert len(long) == 110
    assert long == records(institutions.awards_of(held, request), "award_unique_key", "recipient_uei")


def test_exact_money_stays_decimal_through_the_timeline(spark):
    rows = silver.with_exact_money(
        transactions(spark, {"recipient_uei": "U", "action_date": day("2025-02-01"), "action_type_description": "NEW", "federal_action_obligation": 5.0})
    )
    known = recipients(spark, {"recipient_uei": "U", "recipient_name": "X UNIVERSITY"})
    line = dashboard.phase_timeline(rows, terminations(spark), awards(spark), known, CFG)
    assert line.count() == 1 and line.first().n_new == 1


def test_funnel_counts_academic_awards_at_risk(spark):
    held = awards(
        spark,
        {"award_unique_key": "1", "award_id_fain": "F1", "recipient_uei": "A", "total_obligated_amount": 5.0,
         "period_of_perf_start": day("2024-01-01"), "period_of_perf_end": day("2027-01-01")},
        {"award_unique_key": "2", "award_id_fain": "F2", "recipient_uei": "A", "total_obligated_amount": 5.0,
         "period_of_perf_start": day("2020-01-01"), "period_of_perf_end": day("2021-01-01")},
        {"award_unique_key": "3", "award_id_fain": "F3", "recipient_uei": "B", "total_obligated_amount": 5.0,
         "period_of_perf_start": day("2024-01-01"), "period_of_perf_end": day("2027-01-01")},
    )
    cut = terminations(spark, *[{"award_id_fain": f"F{k}", "reinstated": True} for k in (1, 2, 3, 9)])
    who = recipients(spark, {"recipient_uei": "A", "recipient_name": "A UNIVERSITY"}, {"recipient_uei": "B", "recipient_name": "B LLC"})
    offers = opportunities(spark, {"opportunity_id": "1"})
    funnel = baselines.lifecycle_funnel(offers, held, cut, held.limit(0), who, CFG)
    assert [r.n for r in funnel.collect()] == [1, 2, 1, 1, 1, 0]
    everyone = baselines.lifecycle_funnel(offers, held, cut, held.limit(0))
    assert [r.n for r in everyone.collect()] == [1, 3, 2, 2, 2, 0]

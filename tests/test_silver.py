from __future__ import annotations

import pytest

from grantlens.plans import silver, tables
from grantlens.sources import schemas
from grantlens.sources.store import TableSpec, TableStore
from tests.helpers import awards, column, day, frame, plan, recipients, records, usaspending


def tx(key, award="A1", fain="F1", uei="U1", **more):
    return {
        "assistance_transaction_unique_key": key,
        "assistance_award_unique_key": award,
        "award_id_fain": fain,
        "recipient_uei": uei,
        **more,
    }


def test_latest_row_keeps_its_nulls(spark):
    raw = usaspending(
        spark,
        tx("1", recipient_name="x"),
        tx("2", recipient_name=None, action_date=day("2025-05-01")),
        tx("3", recipient_name="y", action_date=day("2024-05-01")),
        tx("4", uei="", recipient_name="none"),
        tx("5", uei=None, recipient_name="none"),
    )
    got = silver.recipients(raw)
    assert records(got, "recipient_uei", "recipient_name") == [("U1", None)]
    assert "WindowGroupLimit" in plan(got)


def test_undated_rows_are_used_when_there_are_no_others(spark):
    raw = usaspending(spark, tx("2", recipient_name="b"), tx("1", recipient_name="a"))
    assert column(silver.recipients(raw), "recipient_name") == ["a"]


def test_award_attributes_skip_nulls_and_awards_need_a_fain(spark):
    raw = usaspending(
        spark,
        tx("1", fain=None, total_obligated_amount=5.0, cfda_number="47.050"),
        tx("2", fain="F1", total_obligated_amount=9.0, action_date=day("2025-01-01")),
        tx("3", award="A2", fain=None),
        tx("4", award="A3", fain="F3", uei=""),
        tx("5", award="A5", fain="F1", cfda_number="47.041"),
    )
    rolled = silver.award_rollup(raw)
    assert records(rolled, "award_unique_key", "award_id_fain", "awarding_sub_agency_name") == [
        ("A1", "F1", "GEO"),
        ("A5", "F1", "ENG"),
    ]
    got = silver.awards(raw)
    assert records(got, "award_unique_key", "total_obligated_amount", "is_active") == [
        ("A1", 9.0, None)
    ]


def test_awards_of_unknown_recipients_drop(spark):
    raw = usaspending(spark, tx("1"), tx("2", award="A2", fain="F2", uei="U2"))
    known = recipients(spark, {"recipient_uei": "U2"})
    assert column(silver.awards(raw, known), "award_unique_key") == ["A2"]
    assert sorted(column(silver.awards(raw), "award_unique_key")) == ["A1", "A2"]


def test_transactions_are_unique_and_have_an_award(spark):
    raw = usaspending(
        spark,
        tx("1", action_date=day("2025-02-01"), federal_action_obligation=1.0),
        tx("1", action_date=day("2025-01-01"), federal_action_obligation=2.0),
        tx("2", award="A9"),
        tx("3", award=None),
        tx(None),
    )
    known = awards(spark, {"award_unique_key": "A1"})
    orphans = silver.orphan_award_keys(raw, known)
    assert column(orphans, "award_unique_key") == ["A9"]
    for got in [silver.transactions(raw, known), silver.transactions(raw, orphan_keys=orphans)]:
        assert records(got, "transaction_unique_key", "federal_action_obligation") == [("1", 2.0)]


def test_opportunities_prefer_the_synopsis(spark):
    def grant(i, kind, updated=None, **more):
        return {
            "OpportunityID": i,
            "record_type": kind,
            "LastUpdatedDate": day(updated) if updated else None,
            **more,
        }

    raw = frame(
        spark,
        schemas.GRANTS,
        [
            grant("1", "Forecast", "2026-01-01", OpportunityTitle="f"),
            grant("1", "Synopsis 2", "2025-01-01", OpportunityTitle="s", CloseDate="soon"),
            grant("2", "synopsis", None, OpportunityTitle="undated"),
            grant("2", "synopsis", "2025-01-01", OpportunityTitle="dated", CloseDate="2026-05-01"),
            grant("3", None, "2026-01-01", OpportunityTitle="no kind", AwardFloor="1.5"),
            grant(None, "synopsis"),
        ],
    ).selectExpr("*", "true AS is_active")
    got = silver.opportunities(raw)
    assert records(got, "opportunity_id", "title", "close_date", "award_floor") == [
        ("1", "s", None, None),
        ("2", "dated", day("2026-05-01"), None),
        ("3", "no kind", None, 1.5),
    ]


def test_terminations_lose_unknown_fains_but_stay(spark):
    raw = frame(
        spark,
        schemas.TERMINATIONS,
        [
            {"grant_id": "F1", "reinstated": "TRUE", "termination_date": "2025-05-01"},
            {"grant_id": "F1", "reinstated": "TRUE", "termination_date": "2025-05-01"},
            {"grant_id": "F9", "reinstated": "maybe", "nsf_total_budget": "n/a"},
        ],
    ).selectExpr("*", "false AS is_active")
    got = silver.terminations(raw, awards(spark, {"award_id_fain": "F1"}))
    assert records(got, "award_id_fain", "reinstated", "latest_termination_date") == [
        ("F1", True, day("2025-05-01")),
        ("F1", True, day("2025-05-01")),
        (None, None, None),
    ]
    assert sorted(column(got, "termination_id")) == [1, 2, 3]


def _actions(spark):
    """Shared and repeated transaction keys, awards without FAIN, NULL keys, and a large award."""
    rows = []
    for k in range(60):
        rows.append(
            {
                "assistance_transaction_unique_key": None if k % 17 == 0 else f"T{k % 23}",
                "assistance_award_unique_key": None if k % 13 == 0 else f"A{k % 7 if k % 3 else 0}",
                "award_id_fain": None if k % 7 == 5 else f"F{k % 7}",
                "recipient_uei": "" if k % 11 == 0 else f"U{k % 4}",
                "cfda_number": "47.050" if k % 2 else None,
                "action_date": day(f"2025-{1 + k % 12:02d}-01"),
                "federal_action_obligation": float(k),
                "total_obligated_amount": float(k % 9),
                "transaction_description": f"text {k % 5}",
            }
        )
    return usaspending(spark, *rows)


@pytest.mark.parametrize("hot", [3, 10, 1000])
def test_clustered_plans_equal_the_plain_ones(spark, tmp_path, hot):
    raw = _actions(spark)
    specs = tables.table_specs(lambda _: raw, lambda _: frame(spark, schemas.GRANTS, []), lambda _: frame(spark, schemas.TERMINATIONS, []))
    specs["hot_award_keys"] = TableSpec(lambda s: silver.hot_award_keys(s.table("usaspending"), hot))
    store = TableStore(spark, f"file:{tmp_path}", specs)
    loose = store.table("loose_actions")
    assert store.table("award_actions").count() + loose.count() == 60
    held = raw.groupBy(silver.AWARD_KEY).count().filter(f"{silver.AWARD_KEY} is not null and count > {hot}")
    assert loose.filter(f"{silver.AWARD_KEY} is not null").count() == sum(r["count"] for r in held.collect())
    plain = silver.award_rollup(raw)
    assert records(tables.rollup_of(store), *plain.columns) == records(plain, *plain.columns)
    awards = silver.awards(raw).drop("pulled_at")
    assert records(store.table("awards"), *awards.columns) == records(awards, *awards.columns)
    rows = silver.transactions(raw, awards)
    assert records(tables.transactions_of(store), *rows.columns) == records(rows, *rows.columns)
    assert store.counters("usaspending")["rows"] == 60


def test_award_states_merge(spark):
    raw = _actions(spark)
    parts = [silver.award_states(raw.filter(f"month(action_date) % 3 = {k}")) for k in range(3)]
    merged = silver.finished_awards(silver.merged_states(parts[0].unionByName(parts[1]).unionByName(parts[2])))
    whole = silver.award_rollup(raw)
    assert records(merged, *whole.columns) == records(whole, *whole.columns)

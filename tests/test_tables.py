"""From CSV files to views, through the stored tables."""

from __future__ import annotations

from grantlens.plans import bronze, tables, views
from grantlens.sources import publish, schemas, writers
from tests.helpers import day, frame, records


def test_load_from_csv(spark, tmp_path):
    def csv(name, schema, rows):
        path = f"file:{tmp_path}/{name}"
        writers.write_csv(frame(spark, schema, rows), path)
        return path

    def tx(key, award, date, amount, **more):
        return {
            "assistance_transaction_unique_key": key,
            "assistance_award_unique_key": award,
            "award_id_fain": award and f"F{award}",
            "recipient_uei": "U00000000001",
            "recipient_name": "X University",
            "cfda_number": "47.050",
            "action_date": day(date),
            "federal_action_obligation": amount,
            **more,
        }

    years = [
        csv("y1", schemas.USASPENDING, [tx("1", "1", "2024-11-01", 5.0), tx("1", "1", "2024-11-02", 6.0)]),
        csv("y2", schemas.USASPENDING, [tx("2", "2", "2025-11-01", -2.0), tx("3", None, "2025-11-01", 1.0)]),
    ]
    offers = csv(
        "g",
        schemas.GRANTS,
        [
            {"OpportunityID": "1", "AgencyCode": "NSF", "record_type": "synopsis"},
            {"OpportunityID": "2", "AgencyCode": "DOE"},
        ],
    )
    (tmp_path / "y3").mkdir()
    (tmp_path / "y3" / "late.csv").write_text(
        "award_id_fain,assistance_transaction_unique_key,federal_action_obligation\nF1,9,oops\nF1,8\n"
    )
    (tmp_path / "y3" / "blank.csv").write_text("\n\n")
    years.append(f"file:{tmp_path}/y3")
    cut = csv("t", schemas.TERMINATIONS, [{"grant_id": "F1", "abstract": "a\nb"}, {"grant_id": "F9"}])
    store = tables.load(
        spark,
        f"file:{tmp_path}/warehouse",
        lambda spark: bronze.scan_usaspending(spark, years),
        lambda spark: bronze.scan_grants(spark, offers),
        lambda spark: bronze.scan_terminations(spark, cut),
    )
    sizes = {name: store.table(name).count() for name in tables.SILVER}
    assert sizes == {
        "agencies": 12,
        "recipients": 1,
        "opportunities": 1,
        "awards": 2,
        "transactions": 2,
        "monthly_cube": 2,
        "terminations": 2,
    }
    monthly = views.monthly_obligations(store.table("transactions"))
    assert records(monthly, "month", "directorate", "net_obligation") == [
        (day("2024-11-01"), "GEO", 5.0),
        (day("2025-11-01"), "GEO", -2.0),
    ]
    assert records(store.table("terminations"), "award_id_fain") == [("F1",), (None,)]
    lost = {(r.stage, r.counter): r.n for r in tables.load_counters(store).collect()}
    assert lost["usaspending", "rejected rows"] == 1 and lost["usaspending", "unreadable fields"] == 1
    assert lost["usaspending", "files left out"] == 1 and lost["grants", "files left out"] == 0
    assert lost["grants", "rejected rows"] == 0 and lost["transactions", "dropped"] == 3
    assert records(store.table("unreadable_usaspending"), "field", "value") == [("federal_action_obligation", "oops")]
    # All of it comes from the writes: a reader of the published tables has it, too, without the feeds.
    opened = publish.open_store(spark, f"file:{tmp_path}/warehouse")
    assert opened.spark is spark and sorted(tables.load_counters(opened).collect()) == sorted(tables.load_counters(store).collect())
    assert records(opened.table("awards"), "award_unique_key") == records(store.table("awards"), "award_unique_key")

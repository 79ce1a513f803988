"""States by partition, monthly cube, snapshot chain, key register and mergeable sets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as contract
from grantlens.config import DEFAULT_CONFIG as CFG
from grantlens.operators.joins import distinct_counts
from grantlens.operators.rows import in_window
from grantlens.plans import baselines, changes, cube, dashboard, distinct, increments, keys, silver, views
from grantlens.sources import writers
from tests.helpers import day, frame, opportunities, recipients, records, terminations, awards, transactions


def facts(spark, rows):
    return frame(spark, "k string, n int, fiscal_year int", rows)


def states_of(spark, tmp_path, log):
    def build(rows):
        log.append(1)
        return rows.groupBy("k").agg(F.sum("n").alias("n"))

    return increments.PartitionStates(spark, f"file:{tmp_path}/states", build)


def total(states):
    merged = states.states().groupBy("k").agg(F.sum("n").alias("n"))
    return records(merged, "k", "n")


def test_only_changed_partitions_are_read(spark, tmp_path):
    source, log = f"file:{tmp_path}/feed", []
    states = states_of(spark, tmp_path, log)
    with pytest.raises(LookupError, match="refresh"):
        states.states()
    rows = [{"k": "a", "n": 1, "fiscal_year": 2024}, {"k": "b", "n": 2, "fiscal_year": 2025}, {"k": "a", "n": 4, "fiscal_year": None}]
    writers.write_parquet(facts(spark, rows), source, "fiscal_year")
    assert states.refresh(source) == ["2024", "2025", "none"] and total(states) == [("a", 5), ("b", 2)]
    assert states.refresh(source) == [] and len(log) == 3
    writers.replace_partitions(facts(spark, [{"k": "c", "n": 8, "fiscal_year": 2026}]), source, "fiscal_year")
    assert states.refresh(source) == ["2026"] and total(states) == [("a", 5), ("b", 2), ("c", 8)]
    writers.replace_partitions(facts(spark, [{"k": "b", "n": 9, "fiscal_year": 2024}]), source, "fiscal_year")
    assert states.refresh(source) == ["2024"] and total(states) == [("a", 4), ("b", 11), ("c", 8)]
    assert len(log) == 5


def test_partitions_that_go_are_forgotten(spark, tmp_path):
    source = f"file:{tmp_path}/feed"
    states = states_of(spark, tmp_path, [])
    both = [{"k": "a", "n": 1, "fiscal_year": 2024}, {"k": "b", "n": 2, "fiscal_year": 2025}]
    writers.write_parquet(facts(spark, both), source, "fiscal_year")
    states.refresh(source)
    writers.write_parquet(facts(spark, both[1:]), source, "fiscal_year")
    states.refresh(source)
    assert total(states) == [("b", 2)]


def test_a_refresh_that_breaks_off_changes_nothing(spark, tmp_path):
    source = f"file:{tmp_path}/feed"
    states = states_of(spark, tmp_path, [])
    writers.write_parquet(facts(spark, [{"k": "a", "n": 1, "fiscal_year": 2024}]), source, "fiscal_year")
    states.refresh(source)
    writers.replace_partitions(facts(spark, [{"k": "a", "n": 5, "fiscal_year": 2024}]), source, "fiscal_year")
    broken = increments.PartitionStates(spark, states.folder, lambda rows: rows.select(F.raise_error(F.lit("stop")).cast("string").alias("k"), "n"))
    with pytest.raises(Exception, match="stop"):
        broken.refresh(source)
    assert total(states) == [("a", 1)]
    assert states.refresh(source) == ["2024"] and total(states) == [("a", 5)]


def some_transactions(spark, n=400):
    rng, rows = random.Random(1), []
    for k in range(n):
        rows.append(
            {
                "transaction_unique_key": f"T{k}",
                "award_unique_key": f"A{rng.randrange(40)}",
                "recipient_uei": rng.choice(["U1", "U2", "U3", None]),
                "awarding_sub_agency_name": rng.choice(["BIO", "EDU", "GEO", None]),
                "action_type_description": rng.choice(["NEW", "NEW", "REVISION", None]),
                "action_date": rng.choice([None, *[day(f"{y}-{m:02d}-{d:02d}") for y in (2023, 2024, 2025, 2026) for m in (1, 3, 4, 9, 10) for d in (1, 17, 28)]]),
                "federal_action_obligation": rng.choice([None, 0.0, 5.25, 100.5, -7.75]),
                "cfda_number": rng.choice(["47.041", None]),
            }
        )
    return silver.with_fiscal_year(transactions(spark, *rows))


@pytest.fixture(scope="module")
def tables(spark):
    """Transactions, their cube, and small tables beside them."""
    facts = some_transactions(spark).cache()
    people = recipients(spark, *[{"recipient_uei": u, "recipient_name": n} for u, n in (("U1", "X University"), ("U2", "Y College"), ("U3", "Z LLC"))])
    held = awards(spark, *[{"award_unique_key": f"A{k}", "award_id_fain": f"F{k}", "recipient_uei": f"U{k % 3 + 1}", "awarding_sub_agency_name": "BIO", "period_of_perf_start": day("2024-01-01"), "period_of_perf_end": day("2027-01-01")} for k in range(40)])
    cut = terminations(spark, *[{"award_id_fain": f"F{k}", "latest_termination_date": day("2025-05-03")} for k in range(0, 40, 3)])
    offers = opportunities(spark, {"opportunity_id": "1", "is_active": True, "cfda_numbers": "47.074", "post_date": day("2026-01-01"), "estimated_total_funding": 5.0})
    return facts, silver.with_fiscal_year(cube.monthly_cube(facts)).cache(), people, held, cut, offers


def test_plans_give_the_same_on_the_cube(tables):
    facts, monthly, people, held, cut, offers = tables
    assert monthly.count() < facts.count()
    timelines = [dashboard.phase_timeline(t, cut, held, people, CFG) for t in (facts, monthly)]
    for plan in (
        views.monthly_obligations,
        lambda t: views.directorate_resilience(t, offers, CFG),
        lambda t: views.new_awards_by_half(t, CFG),
        lambda t: dashboard.pre_post_by_directorate(t, held, cut, people, CFG),
        lambda t: dashboard.phase_timeline(t, cut, held, people, CFG),
        lambda t: dashboard.funded_directorates(t, people, CFG),
        lambda t: dashboard.half_year_change(timelines[t is monthly], t, people, CFG),
        lambda t: baselines.same_month_baseline(t, people, CFG),
    ):
        a, b = plan(facts), plan(monthly)
        assert dict(a.dtypes) == dict(b.dtypes) and records(a, *a.columns) == records(b, *b.columns)
        assert a.count() > 0


def test_months_are_not_cut(tables):
    with pytest.raises(ValueError, match="monthly rows"):
        in_window(tables[1], "action_date", (day("2025-01-01"), day("2025-01-15")))
    assert in_window(tables[0], "action_date", (day("2025-01-01"), day("2025-01-18"))).count() > 0


@pytest.mark.parametrize("name", ["d2_pre_post_by_directorate", "d3_phase_timeline", "v8_directorate_resilience", "v9_monthly_obligations", "x1_same_month_baseline", "d15_headline_kpis", "ag22_half_year_change"])
def test_monthly_queries_read_no_transactions(spark, name):
    files = contract.queries()[name](spark, "/root/testdata/sf0.001").inputFiles()
    assert not any("/transactions/" in f or "/usaspending/" in f or "lineitem" in f for f in files)


def pulls(spark, *held):
    """Each pull is a dict of opportunity_id to title."""
    rows = [{"opportunity_id": i, "title": t, "snapshot_id": 7 * k + 1} for k, pull in enumerate(held) for i, t in pull.items()]
    schema = opportunities(spark).schema.add("snapshot_id", T.IntegerType())
    register = spark.createDataFrame([(7 * k + 1,) for k in range(len(held))], "snapshot_id int")
    return frame(spark, schema, rows), register


def test_chain_of_pulls(spark):
    held, register = pulls(
        spark, {"a": "x", "b": "x"}, {"a": "y", "c": "x"}, {}, {"a": "y", "b": "z", "c": "x"}, {"a": "y", "b": "z"}, {"b": None, "d": "x"}
    )
    found = changes.chain_changes(held, register, CFG)
    assert records(found, "snapshot_id", "opportunity_id", "change_type", "field_changed", "old_value", "new_value") == sorted(
        [
            (8, "a", "MODIFIED", "title", "x", "y"), (8, "b", "REMOVED", None, None, None), (8, "c", "ADDED", None, None, None),
            (15, "a", "REMOVED", None, None, None), (15, "c", "REMOVED", None, None, None),
            (22, "a", "ADDED", None, None, None), (22, "b", "ADDED", None, None, None), (22, "c", "ADDED", None, None, None),
            (29, "c", "REMOVED", None, None, None),
            (36, "a", "REMOVED", None, None, None), (36, "b", "MODIFIED", "title", "z", None), (36, "d", "ADDED", None, None, None),
        ],
        key=str,
    )
    seen = changes.seen_snapshots(held, register)
    assert records(seen, "opportunity_id", "first_seen_snapshot_id", "last_seen_snapshot_id", "n_pulls", "n_stays") == [
        ("a", 1, 29, 4, 2), ("b", 1, 36, 4, 2), ("c", 8, 22, 2, 2), ("d", 36, 36, 1, 1),
    ]


def test_chain_equals_pairwise_differences(spark):
    rng = random.Random(2)
    made = [{str(i): rng.choice("xyz") for i in range(60) if rng.random() < 0.7} for _ in range(5)]
    held, register = pulls(spark, *made)
    names = ["snapshot_id", "opportunity_id", "change_type", "field_changed", "old_value", "new_value"]
    want = []
    for k in range(4):
        a, b = (held.filter(f"snapshot_id = {7 * j + 1}") for j in (k, k + 1))
        want += records(changes.diff_snapshots(a, b, 7 * (k + 1) + 1, CFG), *names)
    assert records(changes.chain_changes(held, register, CFG), *names) == sorted(want, key=str)


def test_a_single_pull_has_no_changes(spark):
    held, register = pulls(spark, {"a": "x"})
    assert changes.chain_changes(held, register, CFG).count() == 0
    assert changes.chain_changes(held.limit(0), register, CFG).count() == 0


def test_ids_never_move(spark):
    schema = "grant string, status string"
    first = frame(spark, schema, [{"grant": g, "status": s} for g, s in (("a", "1"), ("a", "2"), ("b", "1"), (None, "1"), ("c", "1"), ("c", "1"))])
    register = keys.empty_register(first, ["grant"], "id")
    register = spark.createDataFrame(keys.new_keys(register, first, ["grant"], "id").collect(), register.schema)
    assert sorted(r.id for r in register.collect()) == [1, 2, 3, 4, 5, 6]
    second = frame(spark, schema, [{"grant": g, "status": "9"} for g in ("z", "a", "a", "a", "b", None, None, "c")])
    more = keys.new_keys(register, second, ["grant"], "id")
    assert records(more, "grant", "copy", "id") and sorted(r.id for r in more.collect()) == [7, 8, 9]
    whole = register.unionByName(more)
    ids = {(r.grant, r.copy): r.id for r in register.collect()}
    got = keys.with_registered_key(second, whole, ["grant"], "id")
    assert got.columns == ["id", "grant", "status"] and got.count() == 8
    for grant, n in (("a", 3), ("b", 1), (None, 2), ("c", 1)):
        old = {v for (g, _), v in ids.items() if g == grant}
        mine = {r.id for r in got.collect() if r.grant == grant}
        assert len(mine) == n and len(mine & old) == min(n, len(old))
    assert keys.new_keys(whole, second, ["grant"], "id").count() == 0


def test_copy_numbers_of_many_copies(spark):
    rows = spark.range(2500).select(F.lit("a").alias("k"), (F.col("id") % 2).alias("v")).union(spark.sql("SELECT 'b', 1L"))
    got = keys.with_copy_number(rows, ["k"], chunk=300)
    assert sorted(r["copy"] for r in got.filter("k = 'a'").collect()) == list(range(1, 2501))
    assert got.filter("k = 'a' and v = 0").agg(F.max("copy")).first()[0] == 1250


@pytest.mark.parametrize("key", ["award_unique_key", "recipient_uei"])
def test_sets_of_any_months(spark, key):
    facts = some_transactions(spark, 2000)
    ids = distinct.dense_ids(facts, key)
    # Numbers beyond one bitmap's places.
    ids = ids.withColumn("id", F.col("id") * 20_000)
    sets = distinct.monthly_sets(facts, ids, "cfda_number", key)
    for window in (None, CFG.prior_half, (day("2023-01-01"), day("2026-12-01"))):
        some = in_window(facts, "action_date", window) if window else facts
        want = distinct_counts(some, "cfda_number", n=key)
        assert records(distinct.distinct_in(sets, "cfda_number", "n", window), "cfda_number", "n") == records(want, "cfda_number", "n")
    with pytest.raises(ValueError, match="by month"):
        distinct.distinct_in(sets, "cfda_number", "n", (day("2023-01-01"), day("2023-01-05")))


def test_sets_are_built_where_their_numbers_meet(spark):
    """No bitmap is moved: each is begun and ended in one task."""
    rows = [{"cfda_number": "a", "award_unique_key": f"k{i % 7}", "action_date": day("2025-01-05")} for i in range(20)]
    transactions = frame(spark, "cfda_number string, award_unique_key string, action_date date", rows)
    sets = distinct.monthly_sets(transactions, distinct.dense_ids(transactions, "award_unique_key"), "cfda_number", "award_unique_key")
    plan = sets._jdf.queryExecution().executedPlan().toString().splitlines()
    ends, begins = (next(i for i, line in enumerate(plan) if name in line) for name in ("[bitmap_construct_agg", "partial_bitmap_construct_agg"))
    assert ends < begins and not any("Exchange" in line for line in plan[ends:begins])
    assert distinct.distinct_in(sets, "cfda_number", "n").first().n == 7

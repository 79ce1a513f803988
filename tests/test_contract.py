"""Every registered query against its SQL, and properties of the plans."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from grantlens.driver import adapter, registry
from grantlens.operators import joins
from grantlens.plans import silver
from tests.helpers import plan, records
from tools import check

SF = "/root/testdata/sf0.001"
NAMES = list(registry.QUERIES)


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    verdict, _, _ = check.compare(spark, duck, name, SF)
    assert verdict == "ok"


def test_every_query_has_sql():
    assert set(registry.ORACLES) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_plans_use_neither_python_nor_nested_loops(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    for word in ["BatchEvalPython", "ArrowEvalPython", "MapInPandas", "NestedLoop", "Cartesian"]:
        assert word not in text


@pytest.mark.parametrize(
    "name", ["p4_recipients", "p5_opportunities", "p6_awards", "p7_transactions", "d14_largest_termination"]
)
def test_groups_are_limited_ahead_of_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(contract.queries()[name](spark, SF))


@pytest.mark.parametrize("name", ["fil4_half_open_dates", "d2_pre_post_by_directorate", "d3_phase_timeline", "v8_directorate_resilience"])
def test_fiscal_years_are_pruned(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    assert "PartitionFilters: [" in text and "fiscal_year" in text.split("PartitionFilters: [")[1]


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(contract.queries()["v9_monthly_obligations"](spark, SF))
    schema = text.split("ReadSchema: ")[1].splitlines()[0]
    assert "transaction_description" not in schema
    # Long schemas are cut off in plans.
    assert "n_actions" in schema and "federal_action_o" in schema


@pytest.mark.parametrize(
    "name",
    ["p4_recipients", "p7_transactions", "d2_pre_post_by_directorate", "d11_institution_summary", "v9_monthly_obligations"],
)
def test_results_do_not_depend_on_partition_counts(spark, name):
    def run(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        df = contract.queries()[name](spark, SF)
        return records(df, *df.columns)

    try:
        assert run("1") == run("13")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_award_rollup_sorts_nothing_ahead_of_its_first_shuffle(spark):
    """But for the descriptions, which are reduced to one per award on their own."""
    store = registry.store_for(spark, SF)
    text = plan(silver.award_rollup(store.table("usaspending")))
    scans = [line for line in text.splitlines() if "Scan parquet" in line]
    assert len(scans) == 2
    for branch in text.split("FileScan")[:-1]:
        lowest = branch[branch.rfind("Exchange") :]
        assert "Sort" not in lowest or "partial_min(description" in lowest


def test_clustered_facts_are_not_shuffled(spark):
    """Roll-up, orphan keys, kept rows and the foreign-key check read buckets and stay there."""
    store = registry.store_for(spark, SF)
    actions, awards = store.table("award_actions"), store.table("awards")
    keys = [store.table(n) for n in ("orphan_award_keys", "shared_transaction_keys")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (
            silver.award_rollup(actions, clustered=True),
            silver.orphan_award_keys(actions, awards),
            joins.flag_known(silver.transaction_rows(actions), "award_unique_key", awards, "kept", unique=True),
        ):
            assert "Exchange" not in plan(df) and "Bucketed: true" in plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    text = plan(silver.clustered_transactions(actions, store.table("loose_actions"), *keys))
    within, rest = text.split("\n   +- ", 1)
    assert "spark_catalog" in within and "Exchange hashpartitioning" not in within
    assert rest.count("Exchange hashpartitioning") == 1


def test_registered_pipeline_and_operators_are_optional():
    assert set(registry.QUERIES) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_lines_of_the_feed_are_shuffled_once(spark):
    """Customers join the orders, not the many more lines, where they are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(adapter.usaspending(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins_from_top = [part[:12] for part in text.split("SortMergeJoin [")[1:]]
    assert len(joins_from_top) == 2 and joins_from_top[0].startswith("l_orderkey")

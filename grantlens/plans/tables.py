"""The stored tables and how each is computed and laid out.

Feeds come in as functions, so that the same tables can be built from CSV
folders, from Parquet or from anything else that yields the raw columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.config import DEFAULT_CONFIG, StudyConfig
from grantlens.plans import bronze, cube, dashboard, distinct, institutions, silver
from grantlens.sources.publish import publish
from grantlens.sources.readers import CheckedScan
from grantlens.sources.store import TableSpec, TableStore

Feed = Callable[[SparkSession], DataFrame]
Scan = Callable[[SparkSession], CheckedScan]


def table_specs(
    usaspending: Feed, grants: Feed, tracker: Feed, cfg: StudyConfig = DEFAULT_CONFIG
) -> dict[str, TableSpec]:
    """Bronze, silver and gold tables by name, each built from the ones above it."""

    def scope(s: TableStore) -> tuple[DataFrame, DataFrame, DataFrame]:
        return s.table("terminations"), s.table("awards"), s.table("recipients")

    return {
        "raw_usaspending": TableSpec(lambda s: usaspending(s.spark), stored=False),
        "raw_grants": TableSpec(lambda s: grants(s.spark), stored=False),
        "raw_tracker": TableSpec(lambda s: tracker(s.spark), stored=False),
        # Bronze.
        "usaspending": TableSpec(
            lambda s: silver.with_fiscal_year(bronze.usaspending(s.table("raw_usaspending"), cfg)),
            partition_by="fiscal_year",
            rebalance=False,
            counters={"active": F.col("is_active"), "keyed": F.col("assistance_transaction_unique_key").isNotNull()},
        ),
        "grants": TableSpec(lambda s: bronze.grants(s.table("raw_grants")), counters={"active": F.col("is_active")}),
        "tracker": TableSpec(lambda s: bronze.terminations(s.table("raw_tracker")), counters={"active": F.col("is_active")}),
        # The same transactions clustered by award, but for those of no or of a very large award.
        "hot_award_keys": TableSpec(lambda s: silver.hot_award_keys(s.table("usaspending"))),
        "award_actions": TableSpec(
            lambda s: silver.award_actions(s.table("usaspending"), s.table("hot_award_keys")),
            bucket_by=silver.AWARD_KEY,
        ),
        "loose_actions": TableSpec(lambda s: silver.loose_actions(s.table("usaspending"), s.table("hot_award_keys"))),
        # Silver.
        "agencies": TableSpec(lambda s: silver.agencies(s.spark), stored=False),
        "recipients": TableSpec(lambda s: silver.recipients(s.table("usaspending"))),
        "opportunities": TableSpec(lambda s: silver.opportunities(s.table("grants"), cfg)),
        "awards": TableSpec(lambda s: awards_of(s, cfg), bucket_by="award_unique_key"),
        "orphan_award_keys": TableSpec(
            lambda s: silver.orphan_award_keys(s.table("award_actions"), s.table("awards")).unionByName(
                silver.orphan_award_keys(s.table("loose_actions"), s.table("awards"))
            )
        ),
        "shared_transaction_keys": TableSpec(
            lambda s: silver.shared_transaction_keys(s.table("award_actions"), s.table("loose_actions"))
        ),
        "transactions": TableSpec(
            lambda s: silver.with_fiscal_year(transactions_of(s, cfg)),
            partition_by="fiscal_year",
            sort_by=("action_date",),
            # One file per bucket and year: moving all rows once more would cost most of what this table's job shuffles.
            rebalance=False,
        ),
        "terminations": TableSpec(
            lambda s: silver.terminations(s.table("tracker"), s.table("awards")),
            counters={"matched": F.col("award_id_fain").isNotNull()},
        ),
        # Gold.
        "institution_members": TableSpec(
            lambda s: institutions.institutions_with_awards(
                s.table("recipients"), s.table("awards"), s.table("terminations"), cfg
            )
        ),
        "institutions": TableSpec(lambda s: institutions.institution_list(s.table("institution_members"))),
        "institution_grams": TableSpec(
            lambda s: institutions.label_grams(s.table("institutions")), bucket_by="gram"
        ),
        "portfolio": TableSpec(
            lambda s: institutions.institution_portfolio(
                s.table("recipients"), s.table("awards"), s.table("terminations"), cfg
            )
        ),
        "termination_totals": TableSpec(lambda s: dashboard.termination_totals(*scope(s), cfg)),
        "monthly_cube": TableSpec(
            lambda s: silver.with_fiscal_year(cube.monthly_cube(s.table("transactions"))),
            partition_by="fiscal_year",
            rebalance=False,
        ),
        # Distinct awards and recipients of each month and listing, as sets that can be united.
        "award_ids": TableSpec(lambda s: distinct.dense_ids(s.table("awards"), "award_unique_key")),
        "recipient_ids": TableSpec(lambda s: distinct.dense_ids(s.table("transactions"), "recipient_uei")),
        "award_sets": TableSpec(
            lambda s: distinct.monthly_sets(s.table("transactions"), s.table("award_ids"), "cfda_number", "award_unique_key")
        ),
        "recipient_sets": TableSpec(
            lambda s: distinct.monthly_sets(s.table("transactions"), s.table("recipient_ids"), "cfda_number", "recipient_uei")
        ),
        "funded_directorates": TableSpec(
            lambda s: dashboard.funded_directorates(s.table("monthly_cube"), s.table("recipients"), cfg)
        ),
        "pre_post": TableSpec(
            lambda s: dashboard.pre_post_by_directorate(
                s.table("monthly_cube"),
                s.table("awards"),
                s.table("terminations"),
                s.table("recipients"),
                cfg,
                s.table("funded_directorates"),
            )
        ),
        "timeline": TableSpec(
            lambda s: dashboard.phase_timeline(s.table("monthly_cube"), *scope(s), cfg)
        ),
    }


def rollup_of(store: TableStore, cfg: StudyConfig = DEFAULT_CONFIG) -> DataFrame:
    """The award roll-up: clustered rows where they lie, loose ones by a shuffle."""
    clustered = silver.award_rollup(store.table("award_actions"), cfg, clustered=True)
    return clustered.unionByName(silver.award_rollup(store.table("loose_actions"), cfg))


def awards_of(store: TableStore, cfg: StudyConfig = DEFAULT_CONFIG, recipients: DataFrame | None = None) -> DataFrame:
    return silver.unique_awards(rollup_of(store, cfg), recipients, cfg)


def transactions_of(store: TableStore, cfg: StudyConfig = DEFAULT_CONFIG) -> DataFrame:
    names = ["award_actions", "loose_actions", "orphan_award_keys", "shared_transaction_keys"]
    return silver.clustered_transactions(*[store.table(n) for n in names], cfg)


SILVER = [
    "agencies",
    "recipients",
    "opportunities",
    "awards",
    "transactions",
    "monthly_cube",
    "terminations",
]


FEEDS = ["usaspending", "grants", "tracker"]


def load_specs(
    spark: SparkSession, usaspending: Scan, grants: Scan, tracker: Scan, cfg: StudyConfig = DEFAULT_CONFIG
) -> dict[str, TableSpec]:
    """table_specs over checked scans, with what each scan set aside.

    Beside each feed there are its rejected rows, its unreadable values and the
    files without a header: rejected_<feed>, unreadable_<feed>, left_out_<feed>.
    """
    scans = {n: f(spark) for n, f in zip(FEEDS, (usaspending, grants, tracker))}
    specs = table_specs(*[lambda _, s=scans[n]: s.rows for n in FEEDS], cfg)
    for name, scan in scans.items():
        specs[f"rejected_{name}"] = TableSpec(lambda _, s=scan: s.quarantine)
        specs[f"unreadable_{name}"] = TableSpec(lambda _, s=scan: s.unreadable, counters={"fields": F.col("n")})
        specs[f"left_out_{name}"] = TableSpec(lambda _, s=scan: s.left_out)
    return specs


ASIDE = ["rejected", "unreadable", "left_out"]


def load(
    spark: SparkSession,
    folder: str,
    usaspending: Scan,
    grants: Scan,
    tracker: Scan,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> TableStore:
    """Full reload of the silver tables below `folder`, a folder all executors see.

    The tables become a new published version: readers of the folder
    (publish.open_store) see all of the old tables until all new ones are
    there. load_counters says what was lost on the way.
    """
    specs = load_specs(spark, usaspending, grants, tracker, cfg)
    return publish(spark, folder, specs, [*SILVER, *[f"{kind}_{n}" for n in FEEDS for kind in ASIDE]])


def load_counters(store: TableStore) -> DataFrame:
    """(stage, counter, n): what each feed lost on its way, and the awards and transactions dropped.

    All of it was counted by the jobs that wrote the tables; nothing is read again.
    """
    rows = []
    for name in FEEDS:
        rows.append((name, "rejected rows", store.counters(f"rejected_{name}")["rows"]))
        rows.append((name, "unreadable fields", store.counters(f"unreadable_{name}")["fields"]))
        rows.append((name, "files left out", store.counters(f"left_out_{name}")["rows"]))
    return counter_rows(store, [*rows, *dropped(store)])


def counter_rows(store: TableStore, rows: list[tuple[str, str, int]]) -> DataFrame:
    return store.spark.createDataFrame(rows, "stage string, counter string, n bigint")


def stage_counters(store: TableStore) -> DataFrame:
    """(stage, counter, n): rows of each stage and its special ones, as counted by the writes."""
    names = {"usaspending": ["rows", "active"], "grants": ["rows", "active"], "tracker": ["rows", "active"], "terminations": ["rows", "matched"]}
    rows = [(name, c, store.counters(name)[c]) for name, counters in names.items() for c in counters]
    return counter_rows(store, [*rows, *dropped(store)])


def dropped(store: TableStore) -> list[tuple[str, str, int]]:
    """Awards and transactions of the feed that the conformed tables do not hold."""
    return [
        ("awards", "dropped", store.counters("orphan_award_keys")["rows"]),
        ("transactions", "dropped", store.counters("usaspending")["keyed"] - store.counters("transactions")["rows"]),
    ]

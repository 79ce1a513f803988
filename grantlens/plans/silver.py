"""Conformed tables built from the bronze feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantlens.config import DEFAULT_CONFIG, StudyConfig
from grantlens.functions import flags
from grantlens.functions.classify import DIRECTORATE_NAMES, TOPIC_ORDER, directorate_of
from grantlens.operators.joins import keep_known, keep_unknown, key_set, null_unmatched
from grantlens.operators.rows import keep_one, whole_row_order, with_surrogate_key
from grantlens.sources import schemas
from grantlens.sources.literals import literal_table

MONEY_TYPE = "decimal(18,2)"

# The agency and its directorates.
AGENCY_SEED = [
    (1, "NSF", "National Science Foundation", "top", None),
    (2, "NSF-BIO", "Biological Sciences", "sub", 1),
    (3, "NSF-CSE", "Computer and Information Science and Engineering", "sub", 1),
    (4, "NSF-EDU", "STEM Education", "sub", 1),
    (5, "NSF-ENG", "Engineering", "sub", 1),
    (6, "NSF-GEO", "Geosciences", "sub", 1),
    (7, "NSF-MPS", "Mathematical and Physical Sciences", "sub", 1),
    (8, "NSF-SBE", "Social, Behavioral, and Economic Sciences", "sub", 1),
    (9, "NSF-TIP", "Technology, Innovation, and Partnerships", "sub", 1),
    (10, "NSF-OIA", "Integrative Activities", "sub", 1),
    (11, "NSF-OPP", "Polar Programs", "sub", 1),
    (12, "NSF-OD", "Office of the Director", "sub", 1),
]


def agencies(spark: SparkSession) -> DataFrame:
    """Agency dimension: twelve fixed rows."""
    return literal_table(spark, schemas.AGENCIES_TABLE, AGENCY_SEED)


def directorate_glossary(spark: SparkSession) -> DataFrame:
    """Long names of the eleven directorate codes."""
    return literal_table(spark, schemas.GLOSSARY_TABLE, DIRECTORATE_NAMES)


def topic_order(spark: SparkSession) -> DataFrame:
    """The nine topics with their display position."""
    return literal_table(spark, schemas.TOPICS_TABLE, list(enumerate(TOPIC_ORDER)))


def load_time(cfg: StudyConfig) -> Column:
    """The run's timestamp, in the session's time zone."""
    return F.lit(cfg.run_ts.isoformat(sep=" ")).cast("timestamp")


def with_exact_money(table: DataFrame) -> DataFrame:
    """Amounts as DECIMAL(18,2): sums of any length are then exact to the cent.

    The tables hold doubles, like the feeds. Every plan takes either.
    """
    amounts = {
        f.name: F.col(f.name).cast(MONEY_TYPE)
        for f in table.schema.fields
        if isinstance(f.dataType, T.DoubleType)
    }
    return table.withColumns(amounts) if amounts else table


# Whole-day formats that a feed's text dates may have, tried in order.
DATE_FORMATS = ("yyyy-MM-dd",)
AMOUNT_SHAPE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def text_date(column: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """A date written in full in one of the formats; anything else is NULL.

    A year or a month alone is no date: no day is made up for it.
    """
    trimmed = F.trim(column)
    return F.coalesce(*[F.try_to_timestamp(trimmed, F.lit(f)).cast("date") for f in formats])


def text_amount(column: Column) -> Column:
    """A decimal number without suffixes; anything else is NULL."""
    return F.when(column.rlike(AMOUNT_SHAPE), F.trim(column).try_cast("double"))


def recipients(usaspending: DataFrame) -> DataFrame:
    """One row per recipient: the attributes of its latest transaction.

    The whole row is taken, so a NULL in the latest transaction stays NULL.
    Undated transactions come last; remaining ties go by the other columns.
    """
    return finished_recipients(_latest(recipient_rows(usaspending)))


def recipient_rows(usaspending: DataFrame) -> DataFrame:
    """What recipients are taken from, with the date and key that order a recipient's transactions."""
    return usaspending.filter(flags.has_key(F.col("recipient_uei"))).select(
        "recipient_uei",
        "recipient_name",
        F.col("recipient_state_code").alias("state_code"),
        F.col("recipient_city_name").alias("city_name"),
        F.col("recipient_county_name").alias("county_name"),
        F.col("recipient_zip_code").alias("zip_code"),
        F.col("action_date").alias("_dated"),
        F.col("assistance_transaction_unique_key").alias("_key"),
    )


def _latest(rows: DataFrame) -> DataFrame:
    latest = [F.col("_dated").desc_nulls_last(), *whole_row_order(rows.drop("_dated"), ["_key"])]
    return keep_one(rows, ["recipient_uei"], latest)


def recipient_states(usaspending: DataFrame) -> DataFrame:
    """The latest row of each recipient in a part of the transactions: a state that merges with others of its kind."""
    return _latest(recipient_rows(usaspending))


def merged_recipients(states: DataFrame) -> DataFrame:
    """Recipients from the states of any parts of the transactions."""
    return finished_recipients(_latest(states))


def finished_recipients(latest: DataFrame) -> DataFrame:
    return latest.select(
        "recipient_uei",
        "recipient_name",
        F.lit(None).cast("string").alias("parent_uei"),
        "state_code",
        "city_name",
        "county_name",
        "zip_code",
    )


def opportunities(
    grants: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
    date_formats: tuple[str, ...] = DATE_FORMATS,
) -> DataFrame:
    """One row per opportunity: a synopsis before a forecast, then the newest."""
    synopsis_last = ~F.coalesce(F.lower("record_type").contains("synopsis"), F.lit(False))
    order = [
        synopsis_last.asc(),
        F.col("LastUpdatedDate").desc_nulls_last(),
        *whole_row_order(grants),
    ]
    chosen = keep_one(grants.filter(F.col("OpportunityID").isNotNull()), ["OpportunityID"], order)
    return chosen.select(
        F.col("OpportunityID").cast("string").alias("opportunity_id"),
        F.lit(cfg.agency_id).alias("agency_id"),
        F.col("OpportunityNumber").alias("opportunity_number"),
        F.col("OpportunityTitle").alias("title"),
        F.col("CFDANumbers").alias("cfda_numbers"),
        text_date(F.col("PostDate"), date_formats).alias("post_date"),
        text_date(F.col("CloseDate"), date_formats).alias("close_date"),
        text_date(F.col("ArchiveDate"), date_formats).alias("archive_date"),
        text_amount(F.col("EstimatedTotalProgramFunding")).alias("estimated_total_funding"),
        text_amount(F.col("AwardCeiling")).alias("award_ceiling"),
        text_amount(F.col("AwardFloor")).alias("award_floor"),
        F.col("Description").alias("description"),
        "is_active",
        F.lit(None).cast("int").alias("first_seen_snapshot_id"),
        F.lit(None).cast("int").alias("last_seen_snapshot_id"),
    )


ACTION_COLUMNS = [
    "assistance_transaction_unique_key",
    "assistance_award_unique_key",
    "award_id_fain",
    "recipient_uei",
    "cfda_number",
    "cfda_title",
    "action_date",
    "action_type_description",
    "federal_action_obligation",
    "total_obligated_amount",
    "total_outlayed_amount_for_overall_award",
    "period_of_performance_start_date",
    "period_of_performance_current_end_date",
    "assistance_type_description",
    "transaction_description",
]
AWARD_KEY = "assistance_award_unique_key"
# Rows of one award beyond which it is kept out of the buckets, where one task would write and read it.
HOT_AWARD_ROWS = 1_000_000


def hot_award_keys(usaspending: DataFrame, rows: int = HOT_AWARD_ROWS) -> DataFrame:
    """Awards of more than so many transactions."""
    counted = usaspending.groupBy(AWARD_KEY).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col(AWARD_KEY).isNotNull() & (F.col("n") > rows)).select(AWARD_KEY)


def award_actions(usaspending: DataFrame, hot_keys: DataFrame) -> DataFrame:
    """The transactions that can be clustered by award: those of a known and not too large award."""
    rows = usaspending.filter(F.col(AWARD_KEY).isNotNull())
    return keep_unknown(rows, AWARD_KEY, hot_keys, unique=True).select(*ACTION_COLUMNS)


def loose_actions(usaspending: DataFrame, hot_keys: DataFrame) -> DataFrame:
    """The other transactions: without an award key, or of a hot award."""
    hot = keep_known(usaspending, AWARD_KEY, hot_keys, unique=True).select(*ACTION_COLUMNS)
    return hot.unionByName(usaspending.filter(F.col(AWARD_KEY).isNull()).select(*ACTION_COLUMNS))


def award_rollup(
    usaspending: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG, clustered: bool = False
) -> DataFrame:
    """Aggregate transactions to awards.

    Attributes that may differ between an award's transactions take their
    smallest non-NULL value, which is one of the values a row-order-dependent
    choice could return. Awards without any FAIN drop.
    clustered=True is for rows bucketed by award: nothing is shuffled then, and
    one pass takes all.
    """
    return finished_awards(award_states(usaspending, clustered), cfg)


# What an award's transactions are reduced to, by output name.
AWARD_TEXTS = ["award_id_fain", "recipient_uei", "cfda_number", "cfda_title"]
AWARD_LEAST = {"period_of_perf_start": "period_of_performance_start_date"}
AWARD_MOST = {
    "total_obligated_amount": "total_obligated_amount",
    "total_outlayed_amount": "total_outlayed_amount_for_overall_award",
    "period_of_perf_end": "period_of_performance_current_end_date",
    "action_date": "action_date",
}


def award_states(usaspending: DataFrame, clustered: bool = False) -> DataFrame:
    """One row per award key with least and greatest values: a state that merges with others of its kind."""
    rows = usaspending.filter(
        F.col(AWARD_KEY).isNotNull() & flags.has_key(F.col("recipient_uei"))
    ).withColumnRenamed(AWARD_KEY, "award_unique_key")
    described = rows.withColumnRenamed("transaction_description", "description")
    ends = [*[F.min(c).alias(n) for n, c in AWARD_LEAST.items()], *[F.max(c).alias(n) for n, c in AWARD_MOST.items()]]
    if clustered:
        # The rows of a bucket are in order already, so one pass over them takes everything.
        return described.groupBy("award_unique_key").agg(*[F.min(c).alias(c) for c in [*AWARD_TEXTS, "description"]], *ends)
    # Numbers and dates are reduced by hash within the few combinations of text
    # attributes that an award has; only these are then sorted for their minima.
    combined = described.groupBy("award_unique_key", *AWARD_TEXTS).agg(*ends)
    # The widest column goes its own way, reduced to one value per award ahead of its only shuffle.
    least = described.groupBy("award_unique_key").agg(F.min("description").alias("description"))
    return merged_states(combined.withColumn("description", F.lit(None).cast("string"))).drop("description").join(
        least, "award_unique_key"
    )


def merged_states(states: DataFrame) -> DataFrame:
    """Award states of any parts of the transactions, merged to one per award."""
    return states.groupBy("award_unique_key").agg(
        *[F.min(c).alias(c) for c in [*AWARD_TEXTS, "description", *AWARD_LEAST]],
        *[F.max(c).alias(c) for c in AWARD_MOST],
    )


def finished_awards(states: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG) -> DataFrame:
    """Awards from their merged states."""
    return (
        states.withColumn("is_active", flags.period_active(F.col("period_of_perf_end"), cfg.as_of))
        .filter(F.col("award_id_fain").isNotNull())
        .select(
            "award_unique_key",
            "award_id_fain",
            "recipient_uei",
            F.lit(cfg.agency_id).alias("awarding_agency_id"),
            directorate_of(F.col("cfda_number")).alias("awarding_sub_agency_name"),
            "cfda_number",
            "cfda_title",
            "total_obligated_amount",
            "total_outlayed_amount",
            "period_of_perf_start",
            "period_of_perf_end",
            "action_date",
            "description",
            "is_active",
        )
    )


def awards(
    usaspending: DataFrame,
    recipients: DataFrame | None = None,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """One row per award, unique by award key and by FAIN.

    Awards whose recipient is not in `recipients` drop. Leave `recipients` out
    when it is built from the same transactions: every award's recipient is
    then in it, and the join would only cost a shuffle.
    """
    return unique_awards(award_rollup(usaspending, cfg), recipients, cfg)


def unique_awards(
    rollup: DataFrame, recipients: DataFrame | None = None, cfg: StudyConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Of the awards that share a FAIN, the one with the smallest key."""
    unique = keep_one(rollup, ["award_id_fain"], [F.col("award_unique_key").asc()])
    if recipients is not None:
        known = keep_known(unique, "recipient_uei", recipients, unique=True)
        unique = known.select(*unique.columns)
    return unique.withColumn("pulled_at", load_time(cfg))


def transaction_rows(usaspending: DataFrame) -> DataFrame:
    return usaspending.filter(F.col("assistance_transaction_unique_key").isNotNull()).select(
        F.col("assistance_transaction_unique_key").alias("transaction_unique_key"),
        F.col("assistance_award_unique_key").alias("award_unique_key"),
        "award_id_fain",
        "recipient_uei",
        "cfda_number",
        directorate_of(F.col("cfda_number")).alias("awarding_sub_agency_name"),
        "action_date",
        "action_type_description",
        "federal_action_obligation",
        "assistance_type_description",
        "transaction_description",
    )


def orphan_award_keys(usaspending: DataFrame, awards: DataFrame) -> DataFrame:
    """Award keys that occur in the feed but not among the awards."""
    keys = key_set(usaspending, AWARD_KEY, "award_unique_key")
    return keep_unknown(keys, "award_unique_key", awards, unique=True)


def shared_transaction_keys(*parts: DataFrame) -> DataFrame:
    """Transaction keys that occur under several awards.

    Within rows clustered by award, and between parts with different awards, a
    key's awards are found without moving the rows; the keys alone are then counted.
    """
    pairs = [
        p.filter(F.col("assistance_transaction_unique_key").isNotNull() & F.col(AWARD_KEY).isNotNull())
        .select(F.col("assistance_transaction_unique_key").alias("transaction_unique_key"), AWARD_KEY).distinct()
        for p in parts
    ]
    counted = reduce(DataFrame.unionByName, pairs).groupBy("transaction_unique_key").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > 1).select("transaction_unique_key")


def clustered_transactions(
    actions: DataFrame,
    loose: DataFrame,
    orphan_keys: DataFrame,
    shared_keys: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """The rows of transactions(), from rows clustered by award and the loose ones.

    The clustered rows stay where they are: one row per key is chosen within the
    award. Only rows whose key occurs under several awards, few as a rule, and
    the loose ones are shuffled.
    """

    def known(part: DataFrame) -> DataFrame:
        rows = transaction_rows(part).filter(F.col("award_unique_key").isNotNull())
        return keep_unknown(rows, "award_unique_key", orphan_keys, unique=True).select(*rows.columns)

    def first(rows: DataFrame, keys: list[str]) -> DataFrame:
        return keep_one(rows, keys, whole_row_order(rows, ["action_date"]))

    key = "transaction_unique_key"
    here, there = known(actions), known(loose)
    within = first(keep_unknown(here, key, shared_keys, unique=True), ["award_unique_key", key])
    rest = there.unionByName(keep_known(here, key, shared_keys, unique=True).select(*here.columns))
    return within.select(*here.columns).unionByName(first(rest, [key])).withColumn("pulled_at", load_time(cfg))


def transactions(
    usaspending: DataFrame,
    awards: DataFrame | None = None,
    cfg: StudyConfig = DEFAULT_CONFIG,
    orphan_keys: DataFrame | None = None,
) -> DataFrame:
    """One row per transaction key, for known awards only.

    Of several rows with one key the earliest is kept, ties by the other columns.

    Either `awards` or `orphan_keys` says which awards are known. Few keys are
    orphans as a rule: once stored, their size is on record and Spark broadcasts
    them, whereas a semi join with all awards shuffles every transaction row.
    """
    rows = transaction_rows(usaspending)
    if orphan_keys is not None:
        known = keep_unknown(
            rows.filter(F.col("award_unique_key").isNotNull()),
            "award_unique_key",
            orphan_keys,
            unique=True,
        )
    elif awards is not None:
        known = keep_known(rows, "award_unique_key", awards, unique=True)
    else:
        raise ValueError("give awards or orphan_keys")
    known = known.select(*rows.columns)
    return keep_one(
        known, ["transaction_unique_key"], whole_row_order(known, ["action_date"])
    ).withColumn("pulled_at", load_time(cfg))


def termination_rows(
    tracker: DataFrame, date_formats: tuple[str, ...] = DATE_FORMATS
) -> DataFrame:
    return tracker.select(
        F.col("grant_id").cast("string").alias("award_id_fain"),
        "project_title",
        F.col("status").alias("current_status"),
        text_date(F.col("termination_date"), date_formats).alias("latest_termination_date"),
        F.col("reinstated").try_cast("boolean").alias("reinstated"),
        text_date(F.col("reinstatement_date"), date_formats).alias("reinstatement_date"),
        text_amount(F.col("post_termination_deobligation")).alias("post_termination_deobligation"),
        text_amount(F.col("nsf_total_budget")).alias("nsf_total_budget"),
        text_amount(F.col("estimated_remaining")).alias("estimated_remaining"),
        "directorate",
        "division",
        "nsf_program_name",
        "abstract",
        "is_active",
    )


def terminations(
    tracker: DataFrame, awards: DataFrame, date_formats: tuple[str, ...] = DATE_FORMATS
) -> DataFrame:
    """One row per tracker row. FAINs of unknown awards become NULL."""
    keyed = with_surrogate_key(termination_rows(tracker, date_formats), "termination_id")
    return null_unmatched(keyed, "award_id_fain", awards, unique=True).select(*keyed.columns)


def with_fiscal_year(rows: DataFrame) -> DataFrame:
    """Storage layout of transaction-level tables: partitioned by fiscal year."""
    return rows.withColumn("fiscal_year", flags.fiscal_year(F.col("action_date")))

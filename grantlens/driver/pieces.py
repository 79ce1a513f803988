"""Queries for the single operators below the products."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.driver import adapter
from grantlens.driver.oracle import (
    AS_OF,
    FREEZE,
    PERIOD_STATUS,
    academic,
    canonical_name,
    cents,
    directorate,
    display_name,
    pct,
    topic,
)
from grantlens.driver.registry import CFG, query
from grantlens.functions import classify, flags, text
from grantlens.functions.numbers import count_where, money, percent, row_count, sum_where
from grantlens.operators import joins, quality
from grantlens.operators.rows import in_window, keep_one, whole_row_order, with_surrogate_key
from grantlens.plans import (
    bronze,
    changes,
    dashboard,
    distinct,
    increments,
    institutions,
    keys,
    silver,
    sql,
    tables,
    views,
)
from grantlens.sources import profile, publish, readers, schemas, writers
from grantlens.sources.store import TableSpec, TableStore

# -- sources -------------------------------------------------------------------

OLDER = "coalesce(action_date < DATE '2024-10-01', true)"


@query(
    "src1_csv_union_by_name",
    f"""
    SELECT * EXCLUDE (recipient_county_name, recipient_uei),
           nullif(recipient_uei, '') AS recipient_uei,
           if({OLDER}, recipient_county_name, NULL) AS recipient_county_name
    FROM raw_usaspending
    """,
)
def src1(s: TableStore) -> DataFrame:
    """Two CSV groups: the newer one has its columns reversed and lacks one.

    CSV cannot tell an empty text from a missing one; both are read as NULL.
    The feed as plain text would be several times as large as all tables; each task writes files of its own, so they stay small.
    """
    raw = s.table("raw_usaspending")
    older, newer = s.path("csv/fy_older"), s.path("csv/fy_newer")
    writers.write_csv(raw.filter(OLDER), older, compression="gzip")
    drifted = raw.filter(f"NOT {OLDER}").drop("recipient_county_name")
    writers.write_csv(drifted.select(*reversed(drifted.columns)), newer, compression="gzip")
    return readers.read_csv_groups(s.spark, [older, newer], schemas.USASPENDING, False).rows


SIGNED = adapter.USASPENDING["federal_action_obligation"]


@query(
    "src2_csv_quarantine",
    f"""
    SELECT 'T-' || l_orderkey || '-' || l_linenumber AS assistance_transaction_unique_key,
           CASE WHEN l_partkey % 19 = 0 THEN 'rejected' ELSE 'kept' END AS verdict,
           if(l_partkey % 17 = 0 OR l_partkey % 19 = 0, NULL, {SIGNED}) AS amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    """,
)
def src2(s: TableStore) -> DataFrame:
    """Rows with one field too many are set aside; an unreadable amount is only that.

    A folder with two column orders, grouped by the files' headers.
    """
    raw = s.table("raw_usaspending")
    zip_code = F.col("recipient_zip_code").cast("int")
    dirty = raw.select(
        "assistance_transaction_unique_key",
        "action_date",
        F.when(zip_code % 17 == 0, "twelve")
        .otherwise(F.col("federal_action_obligation").cast("string"))
        .alias("federal_action_obligation"),
        F.when(zip_code % 19 == 0, "one,two").otherwise("one").alias("transaction_description"),
    )
    path = s.path("csv/dirty")
    # No quote character: a comma inside a field splits it.
    swapped = [dirty.columns[k] for k in (0, 2, 1, 3)]
    for mode, columns, rest in (("overwrite", dirty.columns, 0), ("append", swapped, 1)):
        part = dirty.filter(F.crc32("assistance_transaction_unique_key") % 2 == rest).select(*columns)
        part.write.mode(mode).option("header", True).option("quote", "\0").csv(path)
    scan = bronze.scan_usaspending(s.spark, [path])
    key = "assistance_transaction_unique_key"
    return scan.rows.select(
        key, F.lit("kept").alias("verdict"), F.col("federal_action_obligation").alias("amount")
    ).union(scan.quarantine.select(key, F.lit("rejected"), F.lit(None).cast("double")))


@query(
    "src3_codes_stay_text",
    "SELECT cfda_number, count(*) AS n FROM raw_usaspending GROUP BY 1",
)
def src3(s: TableStore) -> DataFrame:
    """47.050 must not turn into the number 47.05 on its way through CSV."""
    path = s.path("csv/codes")
    writers.write_csv(s.table("raw_usaspending").select("cfda_number", "action_date"), path)
    rows = readers.read_csv_checked(s.spark, path, schemas.USASPENDING, multi_line=False).rows
    return rows.groupBy("cfda_number").agg(F.count("*").alias("n"))


def _profile_sql(column: str, declared: str, found: str, value: str | None = None, code: bool = False, **shapes: str) -> str:
    counts = ", ".join(f"{shapes.get(s, '0::BIGINT')} AS n_{s}" for s in profile.SHAPES)
    return (
        f"SELECT '{column}' AS column, count({value or column}) AS n_values, {counts}, '{found}' AS found, "
        f"'{declared}' AS declared, {code} AS is_code, true AS fits FROM raw_usaspending"
    )


@query(
    "src3_type_profile",
    " UNION ALL ".join(
        [
            _profile_sql("cfda_number", "string", "string", code=True, decimal="count(cfda_number)").replace(
                "0::BIGINT AS n_code", "count(cfda_number) AS n_code"
            ),
            _profile_sql("action_date", "date", "date", day="count(action_date)"),
            _profile_sql("federal_action_obligation", "double", "double", decimal="count(federal_action_obligation)"),
            _profile_sql(
                "recipient_zip_code", "string", "string", code=True, whole="count(recipient_zip_code)", decimal="count(recipient_zip_code)"
            ).replace("0::BIGINT AS n_code", "count(*) FILTER (recipient_zip_code LIKE '0%') AS n_code"),
            _profile_sql("action_type_description", "string", "string"),
        ]
    ),
)
def src3_profile(s: TableStore) -> DataFrame:
    """Two CSV folders profiled file by file in one pass each; codes are told from numbers."""
    raw, names = s.table("raw_usaspending"), ["cfda_number", "action_date", "federal_action_obligation", "recipient_zip_code", "action_type_description"]
    parts = []
    for k, where in enumerate((OLDER, f"NOT {OLDER}")):
        path = s.path(f"csv/profile{k}")
        writers.write_csv(raw.filter(where).select(*names[:: 1 - 2 * k]), path)
        text = s.spark.read.option("header", True).csv(path)
        parts.append(profile.shape_counts(text, F.col("_metadata.file_name")))
    return profile.with_types(profile.merged(*parts), schemas.USASPENDING)


@query(
    "src4_parquet_scan",
    """
    SELECT assistance_transaction_unique_key, action_date, federal_action_obligation
    FROM usaspending WHERE action_type_description = 'NEW' AND federal_action_obligation < 0
    """,
)
def src4(s: TableStore) -> DataFrame:
    return (
        s.table("usaspending")
        .filter((F.col("action_type_description") == "NEW") & (F.col("federal_action_obligation") < 0))
        .select("assistance_transaction_unique_key", "action_date", "federal_action_obligation")
    )


@query(
    "src5_sql_over_tables",
    """
    SELECT cfda_number, count(*) AS n, count(DISTINCT recipient_uei) AS n_recipients
    FROM awards GROUP BY 1
    """,
)
def src5(s: TableStore) -> DataFrame:
    s.register_views(["awards"], prefix="gl_")
    return s.spark.sql(
        "SELECT cfda_number, count(*) AS n, count(DISTINCT recipient_uei) AS n_recipients "
        "FROM gl_awards GROUP BY cfda_number"
    )


# -- sinks ---------------------------------------------------------------------


@query(
    "snk1_zstd_parquet_by_fiscal_year",
    """
    SELECT CAST(year(action_date) + if(month(action_date) >= 10, 1, 0) AS INTEGER) AS fiscal_year, count(*) AS n
    FROM transactions GROUP BY 1
    """,
)
def snk1(s: TableStore) -> DataFrame:
    return s.table("transactions").groupBy("fiscal_year").agg(F.count("*").alias("n"))


@query("snk2_csv_round_trip", "SELECT * EXCLUDE (is_active) FROM tracker")
def snk2(s: TableStore) -> DataFrame:
    """Quotes, commas and line breaks inside abstracts survive."""
    path = s.path("csv/tracker")
    writers.write_csv(s.table("tracker"), path)
    return readers.read_csv_checked(s.spark, path, schemas.TERMINATIONS).rows


@query("snk3_append", "SELECT awarding_sub_agency_name, count(*) AS n FROM awards GROUP BY 1")
def snk3(s: TableStore) -> DataFrame:
    awards, path = s.table("awards"), s.path("sinks/append")
    ended = F.coalesce(F.col("is_active"), F.lit(False))
    writers.write_parquet(awards.filter(~ended), path)
    writers.write_parquet(awards.filter(ended), path, mode="append")
    back = readers.read_parquet(s.spark, path, awards.schema)
    return back.groupBy("awarding_sub_agency_name").agg(F.count("*").alias("n"))


@query(
    "snk4_reload_partitions",
    """
    SELECT CAST(year(action_date) + if(month(action_date) >= 10, 1, 0) AS INTEGER) AS fiscal_year,
           count(*) FILTER (federal_action_obligation >= 0
                            OR year(action_date) + if(month(action_date) >= 10, 1, 0) < 2025) AS n
    FROM transactions GROUP BY 1
    """,
)
def snk4(s: TableStore) -> DataFrame:
    """A full load, then a reload of the partitions from FY2025 on."""
    rows = s.table("transactions").select("federal_action_obligation", "fiscal_year")
    path = s.path("sinks/reload")
    writers.write_parquet(rows, path, partition_by="fiscal_year")
    recent = (F.col("fiscal_year") >= 2025) & (F.col("federal_action_obligation") >= 0)
    writers.replace_partitions(rows.filter(recent), path, "fiscal_year")
    back = readers.read_parquet(s.spark, path, rows.schema)
    return back.groupBy("fiscal_year").agg(F.count("*").alias("n"))


@query("snk5_seed_ignore_existing", "SELECT * FROM recipients")
def snk5(s: TableStore) -> DataFrame:
    """Seeding a table that already holds some of the rows adds the others."""
    recipients, path = s.table("recipients"), s.path("sinks/seed")
    writers.write_parquet(recipients.filter(F.col("state_code").isNotNull()), path)
    existing = readers.read_parquet(s.spark, path, recipients.schema)
    fresh = writers.rows_to_seed(recipients, existing, "recipient_uei").select(*recipients.columns)
    writers.write_parquet(fresh, path, mode="append")
    return readers.read_parquet(s.spark, path, recipients.schema)


@query(
    "snk6_added_columns",
    """
    SELECT transaction_unique_key, action_date, CAST(NULL AS VARCHAR) AS transaction_description
    FROM transactions
    """,
)
def snk6(s: TableStore) -> DataFrame:
    """A table written before a column existed is read with it as NULL."""
    current = s.table("transactions").select(
        "transaction_unique_key", "action_date", "transaction_description"
    )
    path = s.path("sinks/evolve")
    writers.write_parquet(current.drop("transaction_description"), path)
    old = readers.read_parquet(s.spark, path, current.drop("transaction_description").schema)
    return writers.with_columns_of(old, current.schema).select(*current.columns)


@query(
    "snk7_registered_views",
    """
    SELECT 'v_active_funding' AS view_name, count(DISTINCT awarding_sub_agency_name) AS n
    FROM awards WHERE is_active
    UNION ALL SELECT 'v_awards_with_quality', count(*) FROM awards
    UNION ALL SELECT 'v_currently_open_opportunities', count(*) FROM open_now
    UNION ALL SELECT 'v_disbursement_progress', count(*) FROM awards
    WHERE total_outlayed_amount IS NOT NULL AND total_obligated_amount > 0
    UNION ALL SELECT 'v_disruption_by_recipient', count(DISTINCT a.recipient_uei)
    FROM terminations AS t JOIN awards AS a USING (award_id_fain)
    UNION ALL SELECT 'v_rescinded_opportunities', count(*) FROM old_pull
    WHERE opportunity_id NOT IN (SELECT opportunity_id FROM new_pull)
    UNION ALL SELECT 'v_disruption_by_directorate', count(*) FROM (
        SELECT DISTINCT coalesce(a.awarding_sub_agency_name, t.directorate)
        FROM terminations AS t LEFT JOIN awards AS a USING (award_id_fain))
    UNION ALL SELECT 'v_monthly_obligations', count(*) FROM (
        SELECT DISTINCT date_trunc('month', action_date), awarding_sub_agency_name FROM transactions
        WHERE action_date IS NOT NULL)
    UNION ALL SELECT 'v_directorate_resilience', count(*) FROM (
        SELECT DISTINCT awarding_sub_agency_name FROM transactions WHERE action_type_description = 'NEW'
        AND action_date BETWEEN DATE '2024-10-01' AND DATE '2025-03-31')
    """,
)
def snk7(s: TableStore) -> DataFrame:
    names = views.register_views(
        s.table("opportunities"),
        s.table("awards"),
        s.table("monthly_cube"),
        s.table("terminations"),
        s.table("recipients"),
        s.table("change_log"),
        CFG,
    )
    return s.spark.sql(
        " UNION ALL ".join(f"SELECT '{n}' AS view_name, count(*) AS n FROM {n}" for n in names)
    )


@query(
    "snk8_row_counts",
    """
    SELECT 'recipients' AS tbl, count(*) AS n FROM recipients
    UNION ALL SELECT 'agencies', count(*) FROM agencies
    UNION ALL SELECT 'opportunities', count(*) FROM opportunities
    UNION ALL SELECT 'awards', count(*) FROM awards
    UNION ALL SELECT 'transactions', count(*) FROM transactions
    UNION ALL SELECT 'terminations', count(*) FROM terminations
    UNION ALL SELECT 'snapshots', 2
    UNION ALL SELECT 'change_log', (
        SELECT count(*) FILTER (a.opportunity_id IS NULL OR b.opportunity_id IS NULL)
             + count(*) FILTER (a.title <> b.title)
             + count(*) FILTER (a.close_date IS NOT NULL AND b.opportunity_id IS NOT NULL
                                AND b.close_date IS NULL)
             + count(*) FILTER (a.estimated_total_funding <> b.estimated_total_funding)
        FROM old_pull AS a FULL JOIN new_pull AS b USING (opportunity_id))
    """,
)
def snk8(s: TableStore) -> DataFrame:
    names = [
        "recipients", "opportunities", "awards", "transactions", "terminations", "change_log",
    ]
    tables = {n: s.table(n) for n in names}
    pulls = [adapter.old_snapshot(tables["opportunities"]), adapter.new_snapshot(tables["opportunities"])]
    entries = [changes.snapshot_entry(p, i + 1, cfg=CFG) for i, p in enumerate(pulls)]
    tables["snapshots"] = reduce(DataFrame.unionByName, entries)
    tables["agencies"] = silver.agencies(s.spark)
    return quality.table_counts(tables)


@query(
    "snk9_stage_counters",
    """
    SELECT 'usaspending' AS stage, 'rows' AS counter, count(*) AS n FROM usaspending
    UNION ALL SELECT 'usaspending', 'active', count(*) FILTER (is_active) FROM usaspending
    UNION ALL SELECT 'grants', 'rows', count(*) FROM grants
    UNION ALL SELECT 'grants', 'active', count(*) FILTER (is_active) FROM grants
    UNION ALL SELECT 'tracker', 'rows', count(*) FROM tracker
    UNION ALL SELECT 'tracker', 'active', count(*) FILTER (is_active) FROM tracker
    UNION ALL SELECT 'terminations', 'rows', count(*) FROM terminations
    UNION ALL SELECT 'terminations', 'matched', count(award_id_fain) FROM terminations
    UNION ALL SELECT 'transactions', 'dropped',
        (SELECT count(*) FROM transaction_rows) - (SELECT count(*) FROM transactions)
    UNION ALL SELECT 'awards', 'dropped',
        (SELECT count(DISTINCT assistance_award_unique_key) FROM usaspending) - (SELECT count(*) FROM awards)
    """,
)
def snk9(s: TableStore) -> DataFrame:
    """Counted by the jobs that wrote the tables."""
    return tables.stage_counters(s)


@query(
    "snk10_published_version",
    """
    SELECT 'awards' AS tbl, awarding_sub_agency_name AS directorate, count(*) AS n FROM awards GROUP BY 2
    UNION ALL SELECT 'versions', NULL, 2
    """,
)
def snk10(s: TableStore) -> DataFrame:
    """Two loads are published, a third one breaks off midway: readers see the second."""
    folder, awards = s.path("sinks/published"), s.table("awards")

    def broken(_: TableStore) -> DataFrame:
        raise RuntimeError("the feed broke off")

    def specs(rows: DataFrame, last: Callable[[TableStore], DataFrame]) -> dict[str, TableSpec]:
        by_directorate = F.col("awarding_sub_agency_name")
        return {
            "awards": TableSpec(lambda _: rows, bucket_by="award_unique_key"),
            "counts": TableSpec(last or (lambda t: t.table("awards").groupBy(by_directorate.alias("directorate")).agg(F.count("*").alias("n")))),
        }

    before = len(publish.versions(s.spark, folder))
    for rows, last in ((awards.limit(0), None), (awards, None), (awards.limit(0), broken)):
        with suppress(RuntimeError):
            publish.publish(s.spark, folder, specs(rows, last), ["awards", "counts"])
    counts = publish.open_store(s.spark, folder).table("counts").select(F.lit("awards").alias("tbl"), "directorate", "n")
    n_versions = F.lit(len(publish.versions(s.spark, folder)) - before).cast("bigint")
    return counts.union(s.spark.range(1).select(F.lit("versions"), F.lit(None).cast("string"), n_versions))


# -- projections ---------------------------------------------------------------


@query("prj1_rename_and_cast", "SELECT * FROM termination_rows")
def prj1(s: TableStore) -> DataFrame:
    return silver.termination_rows(s.table("tracker"))


@query(
    "prj2_constants_and_typed_nulls",
    """
    SELECT opportunity_id, agency_id, first_seen_snapshot_id, last_seen_snapshot_id
    FROM opportunities
    """,
)
def prj2(s: TableStore) -> DataFrame:
    return s.table("opportunities").select(
        "opportunity_id", "agency_id", "first_seen_snapshot_id", "last_seen_snapshot_id"
    )


@query(
    "prj4_load_timestamp",
    "SELECT '2026-04-06 00:00:00' AS pulled_at, count(*) AS n FROM transactions",
)
def prj4(s: TableStore) -> DataFrame:
    stamp = F.date_format("pulled_at", "yyyy-MM-dd HH:mm:ss").alias("pulled_at")
    return s.table("transactions").groupBy(stamp).agg(F.count("*").alias("n"))


@query(
    "prj5_surrogate_key",
    "SELECT count(*) AS n, 1::BIGINT AS first_id, count(*) AS last_id, count(*) AS n_ids FROM tracker",
)
def prj5(s: TableStore) -> DataFrame:
    """Ids run from 1 to n without gaps, also over exact copies."""
    keyed = with_surrogate_key(silver.termination_rows(s.table("tracker")), "id")
    return keyed.agg(
        F.count("*").alias("n"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.countDistinct("id").alias("n_ids"),
    )


FIRST_LOAD = "grant_id IS NULL OR length(grant_id) + CAST(right(grant_id, 1) AS INTEGER) % 3 <> 6"


@query(
    "prj5_key_register",
    f"""
    SELECT award_id_fain, n, n AS n_ids, if(first_n > 0, first_n, NULL) AS n_kept, 0::BIGINT AS n_moved FROM (
        SELECT grant_id AS award_id_fain, count(*) AS n, count(*) FILTER ({FIRST_LOAD}) AS first_n FROM tracker GROUP BY 1
    )
    UNION ALL SELECT 'highest id', count(*), count(*), NULL, NULL FROM tracker
    """,
)
def prj5_register(s: TableStore) -> DataFrame:
    """Two loads: rows of the first keep their ids in the second, whose other columns changed."""
    tracker, by, path = s.table("tracker"), ["award_id_fain"], s.path("keys/terminations")
    first = silver.termination_rows(tracker.filter(FIRST_LOAD))
    second = silver.termination_rows(tracker).withColumn("current_status", F.upper("current_status"))
    register = keys.empty_register(first, by, "id")
    for mode, rows in (("overwrite", first), ("append", second)):
        writers.write_parquet(keys.new_keys(register, rows, by, "id"), path, mode=mode)
        register = readers.read_parquet(s.spark, path, register.schema)
    before = keys.with_registered_key(first, register, by, "id").select("award_id_fain", F.col("id").alias("old_id"))
    after = keys.with_registered_key(second, register, by, "id")
    numbered = after.join(before, after["id"] == before["old_id"], "left").select(
        after["award_id_fain"], "id", "old_id", before["award_id_fain"].alias("old_fain")
    )
    moved = F.col("old_id").isNotNull() & ~F.col("award_id_fain").eqNullSafe(F.col("old_fain"))
    kept = numbered.groupBy("award_id_fain").agg(
        F.count("*").alias("n"),
        F.countDistinct("id").alias("n_ids"),
        F.nullif(F.count("old_id"), F.lit(0)).alias("n_kept"),
        count_where(moved).alias("n_moved"),
    )
    none = F.lit(None).cast("bigint")
    return kept.union(after.agg(F.max("id").alias("n")).select(F.lit("highest id"), "n", "n", none, none))


# -- filters -------------------------------------------------------------------


@query("fil1_agency_scope", "SELECT OpportunityID, record_type FROM grants")
def fil1(s: TableStore) -> DataFrame:
    scope = flags.in_agency_scope(F.col("AgencyName"), F.col("AgencyCode"), F.col("CFDANumbers"))
    return s.table("raw_grants").filter(scope).select("OpportunityID", "record_type")


@query(
    "fil2_key_present",
    """
    SELECT recipient_uei, count(*) AS n FROM usaspending
    WHERE recipient_uei IS NOT NULL AND length(recipient_uei) > 0 GROUP BY 1
    """,
)
def fil2(s: TableStore) -> DataFrame:
    rows = s.table("usaspending").filter(flags.has_key(F.col("recipient_uei")))
    return rows.groupBy("recipient_uei").agg(F.count("*").alias("n"))


@query("fil3_academic_names", f"SELECT recipient_uei, recipient_name FROM recipients WHERE {academic('recipient_name')}")
def fil3(s: TableStore) -> DataFrame:
    return dashboard.academic_recipients(s.table("recipients"), CFG).select(
        "recipient_uei", "recipient_name"
    )


@query(
    "fil4_half_open_dates",
    """
    SELECT transaction_unique_key, action_date FROM transactions
    WHERE action_date BETWEEN DATE '2024-10-01' AND DATE '2025-03-31'
    """,
)
def fil4(s: TableStore) -> DataFrame:
    """Reads two of the fiscal-year folders only."""
    return in_window(s.table("transactions"), "action_date", CFG.prior_half).select(
        "transaction_unique_key", "action_date"
    )


@query(
    "fil5_live_on_freeze_date",
    f"""
    SELECT award_unique_key FROM awards
    WHERE {FREEZE} BETWEEN period_of_perf_start AND period_of_perf_end
    """,
)
def fil5(s: TableStore) -> DataFrame:
    return dashboard.awards_at_risk(s.table("awards"), CFG).select("award_unique_key")


@query("fil6_currently_open", "SELECT opportunity_id, close_date, post_date FROM open_now")
def fil6(s: TableStore) -> DataFrame:
    is_open = flags.currently_open(F.col("is_active"), F.col("close_date"), F.col("post_date"), CFG)
    return s.table("opportunities").filter(is_open).select("opportunity_id", "close_date", "post_date")


@query(
    "fil7_signed_amounts",
    """
    SELECT action_type_description, count(*) FILTER (federal_action_obligation < 0) AS n_negative,
           count(*) FILTER (federal_action_obligation > 0) AS n_positive
    FROM transactions GROUP BY 1
    """,
)
def fil7(s: TableStore) -> DataFrame:
    amount = F.col("federal_action_obligation")
    return (
        s.table("transactions")
        .groupBy("action_type_description")
        .agg(count_where(amount < 0).alias("n_negative"), count_where(amount > 0).alias("n_positive"))
    )


@query(
    "fil8_null_and_boolean_filters",
    """
    SELECT award_id_fain, latest_termination_date, reinstatement_date FROM terminations
    WHERE reinstated = true AND award_id_fain IS NOT NULL AND latest_termination_date IS NOT NULL
      AND trim(coalesce(project_title, '')) <> ''
    """,
)
def fil8(s: TableStore) -> DataFrame:
    return (
        s.table("terminations")
        .filter(
            F.col("reinstated")
            & F.col("award_id_fain").isNotNull()
            & F.col("latest_termination_date").isNotNull()
            & (F.trim("project_title") != "")
        )
        .select("award_id_fain", "latest_termination_date", "reinstatement_date")
    )


@query(
    "fil9_awards_of_requested_recipients",
    """
    SELECT award_unique_key, recipient_uei FROM awards
    WHERE recipient_uei IN ('0000000000U1', '0000000000U7', '000000000U13')
    """,
)
def fil9(s: TableStore) -> DataFrame:
    """The request of one institution explorer search: a list of recipient ids."""
    request = "0000000000U1,0000000000U7,000000000U13"
    return institutions.awards_of(s.table("awards"), request).select(
        "award_unique_key", "recipient_uei"
    )


@query(
    "fil11_name_search",
    """
    SELECT ueis FROM choices WHERE contains(lower(display_name), 'institute')
    ORDER BY display_name, canonical_name, state_code LIMIT 25
    """,
)
def fil11(s: TableStore) -> DataFrame:
    tables = [s.table(n) for n in ("institutions", "institution_members", "institution_grams")]
    return institutions.institution_search(*tables, "INSTITUTE", cfg=CFG).select("ueis")


# -- classification and flags --------------------------------------------------


@query(
    "cls1_directorate_of_code",
    f"SELECT assistance_transaction_unique_key, cfda_number, {directorate('cfda_number')} AS directorate FROM usaspending",
)
def cls1(s: TableStore) -> DataFrame:
    return s.table("usaspending").select(
        "assistance_transaction_unique_key",
        "cfda_number",
        classify.directorate_of(F.col("cfda_number")).alias("directorate"),
    )


@query(
    "cls2_topic_of_title",
    f"""
    SELECT p_partkey, record_type, {topic('p_name')} AS name_topic, {topic('p_type')} AS type_topic
    FROM raw_grants JOIN part ON CAST(OpportunityID AS BIGINT) = p_partkey
    """,
)
def cls2(s: TableStore) -> DataFrame:
    return s.table("raw_grants").select(
        F.col("OpportunityID").cast("long").alias("p_partkey"),
        "record_type",
        classify.topic_of(F.col("OpportunityTitle")).alias("name_topic"),
        classify.topic_of(F.split_part("Description", F.lit(","), F.lit(1))).alias("type_topic"),
    )


NAMED = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in classify.DIRECTORATE_NAMES)


@query(
    "cls3_directorate_names",
    f"""
    , named AS (
        SELECT awarding_sub_agency_name AS directorate, count(*) AS n FROM awards GROUP BY 1
    )
    SELECT directorate, CASE directorate {NAMED} END AS directorate_name, n
    FROM named
    """,
)
def cls3(s: TableStore) -> DataFrame:
    counted = (
        s.table("awards")
        .groupBy(F.col("awarding_sub_agency_name").alias("directorate"))
        .agg(F.count("*").alias("n"))
    )
    glossary = F.broadcast(silver.directorate_glossary(s.spark))
    return counted.join(glossary, "directorate", "left").select("directorate", "directorate_name", "n")


@query(
    "cls3_awards_per_agency_row",
    """
    SELECT g.agency_code, g.agency_name, count(a.award_unique_key) AS n
    FROM agencies AS g LEFT JOIN awards AS a
      ON a.awarding_sub_agency_name = replace(replace(g.agency_code, 'NSF-', ''), 'CSE', 'CISE')
    GROUP BY 1, 2
    """,
)
def cls3_agencies(s: TableStore) -> DataFrame:
    """Agency rows use other codes than awards do; both map to one vocabulary."""
    counted = (
        s.table("awards")
        .groupBy(F.col("awarding_sub_agency_name").alias("code"))
        .agg(F.count("*").alias("n"))
    )
    agencies = silver.agencies(s.spark).withColumn(
        "code", classify.directorate_code(F.col("agency_code"))
    )
    return agencies.join(counted, "code", "left").select(
        "agency_code", "agency_name", F.coalesce("n", F.lit(0)).alias("n")
    )


@query(
    "flg1_transaction_active",
    f"""
    SELECT assistance_transaction_unique_key,
           period_of_performance_current_end_date >= {AS_OF} AS is_active FROM raw_usaspending
    """,
)
def flg1(s: TableStore) -> DataFrame:
    end = F.col("period_of_performance_current_end_date")
    return s.table("raw_usaspending").select(
        "assistance_transaction_unique_key", flags.period_active(end, CFG.as_of).alias("is_active")
    )


@query(
    "flg2_opportunity_active",
    """
    SELECT OpportunityID, lower(record_type) LIKE '%synopsis%' OR lower(record_type) LIKE '%forecast%'
           AS is_active FROM raw_grants
    """,
)
def flg2(s: TableStore) -> DataFrame:
    return s.table("raw_grants").select(
        "OpportunityID", flags.opportunity_active(F.col("record_type")).alias("is_active")
    )


@query("flg3_termination_active", "SELECT grant_id, is_active FROM tracker")
def flg3(s: TableStore) -> DataFrame:
    return s.table("raw_tracker").select(
        "grant_id",
        flags.termination_active(F.col("reinstated"), F.col("terminated")).alias("is_active"),
    )


@query("flg4_award_active", "SELECT award_unique_key, is_active FROM award_rollup")
def flg4(s: TableStore) -> DataFrame:
    return silver.award_rollup(s.table("usaspending"), CFG).select("award_unique_key", "is_active")


@query(
    "flg5_outlay_status",
    """
    SELECT 'not_yet_reported' AS outlay_reporting_status, count(*) AS n FROM awards
    WHERE total_outlayed_amount IS NULL
    UNION ALL SELECT 'reported', count(total_outlayed_amount) FROM awards
    """,
)
def flg5(s: TableStore) -> DataFrame:
    status = flags.outlay_status(F.col("total_outlayed_amount")).alias("outlay_reporting_status")
    return s.table("awards").groupBy(status).agg(F.count("*").alias("n"))


@query("flg6_period_status", f"SELECT award_unique_key, {PERIOD_STATUS} AS pop_status FROM awards")
def flg6(s: TableStore) -> DataFrame:
    status = flags.period_status(F.col("period_of_perf_start"), F.col("period_of_perf_end"), CFG)
    return s.table("awards").select("award_unique_key", status.alias("pop_status"))


@query(
    "flg7_reporting_lag",
    """
    SELECT date_diff('day', action_date, DATE '2026-04-06') <= 90
           AS action_in_reporting_lag_window, count(*) AS n FROM awards GROUP BY 1
    """,
)
def flg7(s: TableStore) -> DataFrame:
    lag = flags.in_reporting_lag(F.col("action_date"), CFG).alias("action_in_reporting_lag_window")
    return s.table("awards").groupBy(lag).agg(F.count("*").alias("n"))


@query("flg8_award_status", "SELECT status, count(*) AS n FROM portfolio GROUP BY 1")
def flg8(s: TableStore) -> DataFrame:
    return s.table("portfolio").groupBy("status").agg(F.count("*").alias("n"))


@query(
    "flg9_live_flag",
    f"""
    SELECT {FREEZE} BETWEEN period_of_perf_start AND period_of_perf_end AS live_apr30, count(*) AS n
    FROM awards GROUP BY 1
    """,
)
def flg9(s: TableStore) -> DataFrame:
    live = flags.live_on(F.col("period_of_perf_start"), F.col("period_of_perf_end"), CFG.freeze_date)
    return s.table("awards").groupBy(live.alias("live_apr30")).agg(F.count("*").alias("n"))


# -- joins ---------------------------------------------------------------------


@query(
    "jn1_changes_with_opportunities",
    """
    , changed AS (
        SELECT coalesce(a.opportunity_id, b.opportunity_id) AS opportunity_id,
               CASE WHEN a.opportunity_id IS NULL OR b.opportunity_id IS NULL THEN 1 ELSE
                 CAST(a.title IS DISTINCT FROM b.title AS INTEGER)
                 + CAST(a.close_date IS DISTINCT FROM b.close_date AS INTEGER)
                 + CAST(a.estimated_total_funding IS DISTINCT FROM b.estimated_total_funding AS INTEGER)
               END AS n
        FROM old_pull AS a FULL JOIN new_pull AS b ON a.opportunity_id = b.opportunity_id
    )
    SELECT opportunity_id, title, CAST(n AS BIGINT) AS n
    FROM changed JOIN opportunities USING (opportunity_id) WHERE n > 0
    """,
)
def jn1(s: TableStore) -> DataFrame:
    log = s.table("change_log").groupBy("opportunity_id").agg(F.count("*").alias("n"))
    return log.join(s.table("opportunities"), "opportunity_id").select("opportunity_id", "title", "n")


@query(
    "jn2_list_membership",
    """
    SELECT o.opportunity_id, o.cfda_numbers, EXISTS (
        SELECT 1 FROM (SELECT DISTINCT cfda_number FROM awards) AS a
        WHERE list_contains(string_split(o.cfda_numbers, ','), a.cfda_number)
           OR list_contains(string_split(replace(o.cfda_numbers, ' ', ''), ','), a.cfda_number)
    ) AS has_matching_award FROM opportunities AS o
    """,
)
def jn2(s: TableStore) -> DataFrame:
    listed = s.table("opportunities").select("opportunity_id", "cfda_numbers")
    return joins.flag_list_overlap(
        listed, "opportunity_id", "cfda_numbers", s.table("awards"), "cfda_number", "has_matching_award"
    )


@query(
    "jn3_terminations_left_awards",
    """
    SELECT t.award_id_fain, t.directorate, a.awarding_sub_agency_name
    FROM terminations AS t LEFT JOIN awards AS a ON t.award_id_fain = a.award_id_fain
    """,
)
def jn3(s: TableStore) -> DataFrame:
    """The left side is the one with repeated keys, so hot keys can be split."""
    codes = s.table("awards").select("award_id_fain", "awarding_sub_agency_name")
    tracked = s.table("terminations").select("award_id_fain", "directorate")
    return tracked.join(codes, "award_id_fain", "left")


@query(
    "jn4_terminations_awards_recipients",
    """
    SELECT t.award_id_fain, r.recipient_uei, r.recipient_name
    FROM terminations AS t, awards AS a, recipients AS r
    WHERE t.award_id_fain = a.award_id_fain AND a.recipient_uei = r.recipient_uei
    """,
)
def jn4(s: TableStore) -> DataFrame:
    awards = s.table("awards").select("award_id_fain", "recipient_uei")
    names = s.table("recipients").select("recipient_uei", "recipient_name")
    return (
        s.table("terminations")
        .select("award_id_fain")
        .join(awards, "award_id_fain")
        .join(names, "recipient_uei")
        .select("award_id_fain", "recipient_uei", "recipient_name")
    )


@query(
    "jn6_academic_transactions",
    "SELECT transaction_unique_key, recipient_uei FROM academic_tx",
)
def jn6(s: TableStore) -> DataFrame:
    academic_keys = dashboard.academic_ueis(s.table("recipients"), CFG)
    return (
        s.table("transactions")
        .join(academic_keys, "recipient_uei", "left_semi")
        .select("transaction_unique_key", "recipient_uei")
    )


@query("jn7_academic_fains", "SELECT award_id_fain FROM academic_fains")
def jn7(s: TableStore) -> DataFrame:
    return dashboard.academic_fains(s.table("awards"), s.table("recipients"), CFG)


@query(
    "jn8_distinct_counts_over_fanout",
    """
    SELECT a.awarding_sub_agency_name AS directorate, count(DISTINCT a.award_unique_key) AS n_awards,
           count(DISTINCT t.termination_id) AS n_terms
    FROM awards AS a LEFT JOIN terminations AS t USING (award_id_fain) GROUP BY 1
    """,
)
def jn8(s: TableStore) -> DataFrame:
    per_award = dashboard.terminations_per_award(s.table("terminations"))
    return (
        s.table("awards")
        .select("award_id_fain", F.col("awarding_sub_agency_name").alias("directorate"))
        .join(per_award, "award_id_fain", "left")
        .groupBy("directorate")
        .agg(
            row_count().alias("n_awards"),
            F.coalesce(F.sum("n_terms"), F.lit(0)).alias("n_terms"),
        )
    )


@query(
    "jn13_award_termination_fanout",
    """
    SELECT a.award_id_fain, t.project_title, t.latest_termination_date
    FROM awards AS a LEFT JOIN terminations AS t USING (award_id_fain)
    """,
)
def jn13(s: TableStore) -> DataFrame:
    tracked = s.table("terminations").select(
        "award_id_fain", "project_title", "latest_termination_date"
    )
    return joins.left_join_fanout(
        s.table("awards").select("award_id_fain"), tracked, "award_id_fain"
    )


RECENT = "action_date >= DATE '2025-01-01'"


@query(
    "jn14_drop_orphan_awards",
    f"""
    , recent AS (SELECT DISTINCT recipient_uei FROM usaspending WHERE {RECENT} AND recipient_uei <> '')
    SELECT award_unique_key, recipient_uei IN (SELECT recipient_uei FROM recent) AS kept FROM awards
    """,
)
def jn14(s: TableStore) -> DataFrame:
    """Awards against a recipient table that lacks the inactive recipients."""
    awards = s.table("awards").select("award_unique_key", "recipient_uei")
    known = s.table("usaspending").filter(RECENT)
    return joins.flag_known(awards, "recipient_uei", known, "kept").drop("recipient_uei")


@query(
    "jn15_drop_orphan_transactions",
    """
    SELECT x.transaction_unique_key, x.award_unique_key, a.award_unique_key IS NOT NULL AS kept
    FROM transaction_rows AS x LEFT JOIN awards AS a USING (award_unique_key)
    """,
)
def jn15(s: TableStore) -> DataFrame:
    """Against all awards, which are clustered like the rows; p7_transactions uses the orphan keys."""

    def flagged(part: str) -> DataFrame:
        rows = silver.transaction_rows(s.table(part)).select("transaction_unique_key", "award_unique_key")
        return joins.flag_known(rows, "award_unique_key", s.table("awards"), "kept", unique=True)

    return flagged("award_actions").unionByName(flagged("loose_actions"))


@query(
    "jn16_null_unmatched_keys",
    """
    SELECT r.award_id_fain IS NULL AS unmatched, count(*) AS n FROM (
        SELECT a.award_id_fain FROM tracker AS k LEFT JOIN awards AS a ON a.award_id_fain = k.grant_id
    ) AS r GROUP BY 1
    """,
)
def jn16(s: TableStore) -> DataFrame:
    rows = silver.termination_rows(s.table("tracker")).select("award_id_fain")
    marked = joins.null_unmatched(rows, "award_id_fain", s.table("awards"))
    return marked.groupBy(F.col("award_id_fain").isNull().alias("unmatched")).agg(
        F.count("*").alias("n")
    )


# -- aggregations --------------------------------------------------------------


@query("ag1_award_rollup", "SELECT * FROM award_rollup")
def ag1(s: TableStore) -> DataFrame:
    return tables.rollup_of(s, CFG)


def _yearly(s: TableStore, name: str, build: Callable[[DataFrame], DataFrame]) -> tuple[increments.PartitionStates, list[list[str]]]:
    """States after three refreshes: of the years before 2025, with the later ones added, and once more."""
    rows, source = s.table("usaspending"), s.path(f"increments/{name}/feed")
    states = increments.PartitionStates(s.spark, s.path(f"increments/{name}"), build)
    late = F.coalesce(F.col("fiscal_year") >= 2025, F.lit(False))
    # The stored feed has a folder per year already, so its rows stay where they are.
    writers.write_parquet(rows.filter(~late), source, "fiscal_year", rebalance=False)
    read = [states.refresh(source)]
    writers.replace_partitions(rows.filter(late), source, "fiscal_year", rebalance=False)
    return states, [*read, states.refresh(source), states.refresh(source)]


@query("ag1_yearly_states", "SELECT * FROM award_rollup")
def ag1_yearly(s: TableStore) -> DataFrame:
    """The roll-up merged from yearly states; the later years were added to those of the earlier ones."""
    states, _ = _yearly(s, "awards", silver.award_states)
    return silver.finished_awards(silver.merged_states(states.states().drop("part")), CFG)


@query("ag2_yearly_states", "SELECT * FROM recipients")
def ag2_yearly(s: TableStore) -> DataFrame:
    states, _ = _yearly(s, "recipients", silver.recipient_states)
    return silver.merged_recipients(states.states().drop("part"))


@query(
    "snk4_refreshed_years",
    """
    SELECT 1 AS refresh, CAST(year(action_date) + if(month(action_date) >= 10, 1, 0) AS VARCHAR) AS part
    FROM usaspending WHERE year(action_date) + if(month(action_date) >= 10, 1, 0) < 2025 GROUP BY 2
    UNION ALL SELECT 2, CAST(year(action_date) + if(month(action_date) >= 10, 1, 0) AS VARCHAR)
    FROM usaspending WHERE year(action_date) + if(month(action_date) >= 10, 1, 0) >= 2025 GROUP BY 2
    """,
)
def snk4_years(s: TableStore) -> DataFrame:
    """Which years each refresh read: the old ones, the new ones, none."""
    _, read = _yearly(s, "counts", lambda rows: rows.agg(F.count("*").alias("n")))
    return s.spark.createDataFrame([(k, part) for k, parts in enumerate(read, 1) for part in parts], "refresh int, part string")


@query(
    "fn_sql_classification",
    f"SELECT {directorate('cfda_number')} AS directorate, NULL AS topic, count(*) AS n FROM awards GROUP BY 1 "
    f"UNION ALL SELECT NULL, {topic('project_title')}, count(*) FROM terminations GROUP BY 2",
)
def fn_sql(s: TableStore) -> DataFrame:
    """The two maps as SQL functions."""
    sql.register_functions(s.spark, s.table("portfolio"))
    s.register_views(["awards", "terminations"], prefix="gl_")
    return s.spark.sql(
        "SELECT nsf_directorate(cfda_number) AS directorate, CAST(NULL AS STRING) AS topic, count(*) AS n FROM gl_awards GROUP BY 1 "
        "UNION ALL SELECT CAST(NULL AS STRING), nsf_topic(project_title), count(*) FROM gl_terminations GROUP BY 2"
    )


@query(
    "ag5_filtered_counts",
    """
    SELECT recipient_uei, count(*) AS n, count(*) FILTER (total_outlayed_amount > 0) AS n_paid
    FROM awards GROUP BY 1
    """,
)
def ag5(s: TableStore) -> DataFrame:
    return (
        s.table("awards")
        .groupBy("recipient_uei")
        .agg(row_count().alias("n"), count_where(F.col("total_outlayed_amount") > 0).alias("n_paid"))
    )


@query(
    "ag6_conditional_sums",
    f"""
    SELECT recipient_uei, {cents("sum(federal_action_obligation) FILTER (action_type_description = 'NEW')")} AS new_amount,
           {cents('sum(federal_action_obligation) FILTER (federal_action_obligation < 0)')} AS lost_amount
    FROM transactions GROUP BY 1
    """,
)
def ag6(s: TableStore) -> DataFrame:
    amount = F.col("federal_action_obligation")
    is_new = F.col("action_type_description") == "NEW"
    return (
        s.table("transactions")
        .groupBy("recipient_uei")
        .agg(
            money(sum_where(is_new, amount)).alias("new_amount"),
            money(sum_where(amount < 0, amount)).alias("lost_amount"),
        )
    )


@query(
    "ag9_new_awards_by_half",
    f"""
    SELECT awarding_sub_agency_name AS directorate,
           count(*) FILTER (action_date < DATE '2025-04-01') AS fy25_new_count,
           {cents("sum(federal_action_obligation) FILTER (action_date < DATE '2025-04-01')")} AS fy25_new_oblig,
           count(*) FILTER (action_date >= DATE '2025-10-01') AS fy26_new_count,
           {cents("coalesce(sum(federal_action_obligation) FILTER (action_date >= DATE '2025-10-01'), 0)")} AS fy26_new_oblig
    FROM transactions
    WHERE action_type_description = 'NEW'
      AND (action_date BETWEEN DATE '2024-10-01' AND DATE '2025-03-31'
           OR action_date BETWEEN DATE '2025-10-01' AND DATE '2026-03-31')
    GROUP BY 1
    """,
)
def ag9(s: TableStore) -> DataFrame:
    return views.new_awards_by_half(s.table("monthly_cube"), CFG)


@query(
    "ag10_open_funding",
    f"""
    SELECT directorate, count(*) AS n, {cents('sum(estimated_total_funding)')} AS funding
    FROM open_now GROUP BY 1
    """,
)
def ag10(s: TableStore) -> DataFrame:
    offered = views.currently_open_opportunities(s.table("opportunities"), CFG)
    return offered.groupBy("directorate").agg(
        row_count().alias("n"), money(F.sum("estimated_total_funding")).alias("funding")
    )


@query(
    "ag11_exact_distinct_counts",
    """
    SELECT cfda_number, count(DISTINCT award_unique_key) AS n_awards,
           count(DISTINCT recipient_uei) AS n_recipients FROM transactions GROUP BY 1
    """,
)
def ag11(s: TableStore) -> DataFrame:
    return joins.distinct_counts(
        s.table("transactions"), "cfda_number", n_awards="award_unique_key", n_recipients="recipient_uei"
    )


@query(
    "ag11_merged_distinct_sets",
    """
    SELECT cfda_number, count(DISTINCT award_unique_key) AS n_awards,
           count(DISTINCT award_unique_key) FILTER (action_date >= DATE '2024-10-01' AND action_date < DATE '2025-04-01') AS n_prior,
           count(DISTINCT recipient_uei) FILTER (action_date >= DATE '2025-10-01' AND action_date < DATE '2026-04-01') AS n_current_recipients
    FROM transactions GROUP BY 1
    """,
)
def ag11_sets(s: TableStore) -> DataFrame:
    """Distinct awards and recipients of any months, from stored bitmaps."""
    by = "cfda_number"
    awards, recipients = s.table("award_sets"), s.table("recipient_sets")
    counted = distinct.distinct_in(awards, by, "n_awards")
    for sets, name, window in ((awards, "n_prior", CFG.prior_half), (recipients, "n_current_recipients", CFG.current_half)):
        part = distinct.distinct_in(sets, by, name, window).withColumnRenamed(by, "_by")
        counted = counted.join(part, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")
    return counted.fillna(0, ["n_prior", "n_current_recipients"])


@query("ag12_ordered_member_lists", "SELECT canonical_name, state_code, ueis FROM choices")
def ag12(s: TableStore) -> DataFrame:
    members = s.table("institution_members")
    return institutions.with_ueis(s.table("institutions"), members).select("canonical_name", "state_code", "ueis")


@query(
    "ag22_half_year_change",
    f"""
    , t AS (
        SELECT {cents("sum(amount) FILTER (month >= DATE '2025-01-01' AND month < DATE '2025-04-01')")} AS p3,
               {cents("sum(amount) FILTER (month >= DATE '2024-10-01' AND month < DATE '2025-04-01')")} AS p6,
               {cents("sum(amount) FILTER (month >= DATE '2025-10-01' AND month < DATE '2026-04-01')")} AS c
        FROM monthly_new
    )
    SELECT 'series' AS basis, p3 AS prior, c AS current, if(p3 > 0, {pct('(c - p3)', 'p3')}, NULL) AS change_pct FROM t
    UNION ALL SELECT 'full', p6, c, if(p6 > 0, {pct('(c - p6)', 'p6')}, NULL) FROM t
    """,
)
def ag22(s: TableStore) -> DataFrame:
    tables = [s.table(n) for n in ["monthly_cube", "terminations", "awards", "recipients"]]
    timeline = dashboard.phase_timeline(*tables, CFG)
    return dashboard.half_year_change(timeline, tables[0], tables[3], CFG)


# -- windows, order, sets ------------------------------------------------------


@query(
    "w1_keep_one_opportunity",
    "SELECT opportunity_id, title, is_active FROM opportunities",
)
def w1(s: TableStore) -> DataFrame:
    return silver.opportunities(s.table("grants"), CFG).select("opportunity_id", "title", "is_active")


@query(
    "w2_latest_row_per_recipient",
    "SELECT recipient_uei, city_name, county_name, zip_code FROM recipients",
)
def w2(s: TableStore) -> DataFrame:
    return silver.recipients(s.table("usaspending")).select(
        "recipient_uei", "city_name", "county_name", "zip_code"
    )


@query(
    "w3_keep_first_transaction",
    """
    SELECT transaction_unique_key, action_date, federal_action_obligation FROM transaction_rows
    QUALIFY row_number() OVER (PARTITION BY transaction_unique_key
        ORDER BY action_date, federal_action_obligation) = 1
    """,
)
def w3(s: TableStore) -> DataFrame:
    rows = silver.transaction_rows(s.table("usaspending")).select(
        "transaction_unique_key", "action_date", "federal_action_obligation"
    )
    return keep_one(rows, ["transaction_unique_key"], whole_row_order(rows, ["action_date"]))


@query(
    "st3_portfolio_order",
    """
    SELECT canonical_name, state_code, status, obligated, fain FROM portfolio
    ORDER BY canonical_name, state_code, CASE status WHEN 'Terminated' THEN 1 WHEN 'Reinstated' THEN 2
             ELSE 3 END, obligated DESC NULLS LAST, fain
    """,
)
def st3(s: TableStore) -> DataFrame:
    return institutions.in_display_order(s.table("portfolio")).select(
        "canonical_name", "state_code", "status", "obligated", "fain"
    )


@query(
    "so2_union_missing_columns",
    """
    SELECT award_id_fain, action_date, CAST(NULL AS DATE) AS latest_termination_date FROM awards
    UNION ALL SELECT award_id_fain, NULL, latest_termination_date FROM terminations
    """,
)
def so2(s: TableStore) -> DataFrame:
    return (
        s.table("awards")
        .select("award_id_fain", "action_date")
        .unionByName(
            s.table("terminations").select("latest_termination_date", "award_id_fain"),
            allowMissingColumns=True,
        )
    )


@query(
    "so4_topics_in_display_order",
    "SELECT position, topic FROM topic_positions WHERE topic IN (SELECT topic FROM recovery)",
)
def so4(s: TableStore) -> DataFrame:
    days = dashboard.reinstatement_days(
        s.table("terminations"), s.table("awards"), s.table("recipients"), CFG
    )
    present = F.broadcast(silver.topic_order(s.spark))
    return (
        days.select("topic").distinct().join(present, "topic").select("position", "topic").orderBy("position")
    )


@query("so5_institution_states", "SELECT DISTINCT state_code FROM choices")
def so5(s: TableStore) -> DataFrame:
    return institutions.institution_states(s.table("institutions"))


# -- scalar functions ----------------------------------------------------------


@query(
    "fn_name_cleaning",
    f"""
    SELECT recipient_uei, {display_name('recipient_name')} AS display_name,
           {canonical_name('recipient_name')} AS canonical_name FROM recipients
    """,
)
def fn_names(s: TableStore) -> DataFrame:
    name = F.col("recipient_name")
    return s.table("recipients").select(
        "recipient_uei",
        text.display_name(name).alias("display_name"),
        text.canonical_name(name).alias("canonical_name"),
    )


@query(
    "fn_strict_canonical_name",
    """
    SELECT recipient_uei, upper(trim(regexp_replace(regexp_replace(regexp_replace(recipient_name,
        '^\\s*THE\\s+', '', 'i'),
        '\\s*[,.]?\\s*\\b(?:DISTRICT|DISTRICTS|INC|LLC|LLP|FOUNDATION|CORPORATION|CORP|COMPANY|CO|LIMITED|LTD)\\.?\\s*$',
        '', 'i'), '\\s+', ' ', 'g'))) AS canonical_name
    FROM recipients
    """,
)
def fn_strict(s: TableStore) -> DataFrame:
    return s.table("recipients").select(
        "recipient_uei",
        text.canonical_name(F.col("recipient_name"), strict=True).alias("canonical_name"),
    )


@query(
    "fn_try_casts",
    """
    SELECT OpportunityID, TRY_CAST(CloseDate AS DATE) AS close_date,
           TRY_CAST(EstimatedTotalProgramFunding AS DOUBLE) AS funding,
           TRY_CAST(AwardFloor AS DOUBLE) AS award_floor FROM raw_grants
    """,
)
def fn_casts(s: TableStore) -> DataFrame:
    return s.table("raw_grants").select(
        "OpportunityID",
        silver.text_date(F.col("CloseDate")).alias("close_date"),
        silver.text_amount(F.col("EstimatedTotalProgramFunding")).alias("funding"),
        silver.text_amount(F.col("AwardFloor")).alias("award_floor"),
    )


@query(
    "fn_dates_and_lists",
    """
    SELECT OpportunityID, CAST(date_trunc('month', LastUpdatedDate) AS DATE) AS month,
           strftime(LastUpdatedDate, '%Y-%m-%d') AS day_text,
           CAST(LastUpdatedDate - DATE '2024-12-31' AS INTEGER) AS days,
           CAST(LastUpdatedDate - INTERVAL 18 MONTH AS DATE) AS earlier,
           len(string_split(CFDANumbers, ',')) AS n_codes,
           trim(string_split(CFDANumbers, ',')[-1]) AS last_code
    FROM raw_grants
    """,
)
def fn_dates(s: TableStore) -> DataFrame:
    updated = F.col("LastUpdatedDate")
    codes = F.split("CFDANumbers", ",")
    return s.table("raw_grants").select(
        "OpportunityID",
        flags.month_of(updated).alias("month"),
        F.date_format(updated, "yyyy-MM-dd").alias("day_text"),
        F.datediff(updated, F.lit("2024-12-31").cast("date")).alias("days"),
        F.add_months(updated, -18).alias("earlier"),
        F.when(codes.isNotNull(), F.size(codes)).cast("long").alias("n_codes"),
        F.trim(F.element_at(codes, -1)).alias("last_code"),
    )


@query(
    "fn_safe_division",
    f"""
    SELECT award_unique_key, {pct('total_outlayed_amount', 'total_obligated_amount')} AS pct_outlayed
    FROM awards
    """,
)
def fn_division(s: TableStore) -> DataFrame:
    share = percent(F.col("total_outlayed_amount"), F.col("total_obligated_amount"))
    return s.table("awards").select("award_unique_key", share.alias("pct_outlayed"))


# -- constraints ---------------------------------------------------------------


@query(
    "qc_constraint_report",
    """
    SELECT 'awards: award key unique' AS "check", 0 AS violations
    UNION ALL SELECT 'awards: FAIN unique', 0
    UNION ALL SELECT 'awards: recipient known', (SELECT count(*) FROM awards
        WHERE recipient_uei NOT IN (SELECT recipient_uei FROM recipients))
    UNION ALL SELECT 'transactions: key unique', 0
    UNION ALL SELECT 'transactions: award known', (SELECT count(*) FROM transactions
        WHERE award_unique_key NOT IN (SELECT award_unique_key FROM awards))
    UNION ALL SELECT 'terminations: award known', 0
    UNION ALL SELECT 'terminations: id unique', 0
    UNION ALL SELECT 'opportunities: title present', (SELECT count(*) FROM opportunities WHERE title IS NULL)
    """,
)
def qc(s: TableStore) -> DataFrame:
    awards, transactions, terminations = (
        s.table(n) for n in ["awards", "transactions", "terminations"]
    )
    return quality.constraint_report(
        {
            "awards: award key unique": quality.duplicate_keys(awards, ["award_unique_key"]),
            "awards: FAIN unique": quality.duplicate_keys(awards, ["award_id_fain"]),
            "awards: recipient known": quality.orphans(awards, "recipient_uei", s.table("recipients")),
            "transactions: key unique": quality.duplicate_keys(transactions, ["transaction_unique_key"]),
            "transactions: award known": quality.orphans(transactions, "award_unique_key", awards),
            "terminations: award known": quality.orphans(terminations, "award_id_fain", awards),
            "terminations: id unique": quality.duplicate_keys(terminations, ["termination_id"]),
            "opportunities: title present": quality.missing_keys(s.table("opportunities"), "title"),
        }
    )

"""Queries for the tables, views, dashboard analyses and extras."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.driver import adapter
from grantlens.driver.oracle import (
    FREEZE,
    PERIOD_STATUS,
    cents,
    pct,
    rounded,
    topic,
)
from grantlens.driver.registry import CFG, query
from grantlens.plans import baselines, bronze, changes, dashboard, institutions, silver, sql, tables, views
from grantlens.sources.store import TableStore


def _load_text(df: DataFrame) -> DataFrame:
    """Load timestamps as text, so that no time zone enters the comparison."""
    return df.withColumn("pulled_at", F.date_format("pulled_at", "yyyy-MM-dd HH:mm:ss"))


# -- tables --------------------------------------------------------------------


@query("p1_usaspending_bronze", "SELECT * FROM usaspending")
def p1(s: TableStore) -> DataFrame:
    return bronze.usaspending(s.table("raw_usaspending"), CFG)


@query("p2_grants_bronze", "SELECT * FROM grants")
def p2(s: TableStore) -> DataFrame:
    return bronze.grants(s.table("raw_grants"))


@query("p3_terminations_bronze", "SELECT * FROM tracker")
def p3(s: TableStore) -> DataFrame:
    return bronze.terminations(s.table("raw_tracker"))


@query("p4_recipients", "SELECT * FROM recipients")
def p4(s: TableStore) -> DataFrame:
    return silver.recipients(s.table("usaspending"))


@query("p5_opportunities", "SELECT * FROM opportunities")
def p5(s: TableStore) -> DataFrame:
    return silver.opportunities(s.table("grants"), CFG)


@query("p6_awards", "SELECT *, '2026-04-06 00:00:00' AS pulled_at FROM awards")
def p6(s: TableStore) -> DataFrame:
    return _load_text(tables.awards_of(s, CFG, s.table("recipients")))


@query("p7_transactions", "SELECT *, '2026-04-06 00:00:00' AS pulled_at FROM transactions")
def p7(s: TableStore) -> DataFrame:
    return _load_text(tables.transactions_of(s, CFG))


@query("p8_terminations", "SELECT * EXCLUDE (termination_id) FROM terminations")
def p8(s: TableStore) -> DataFrame:
    """Without the surrogate key, whose values are free; see prj5_surrogate_key."""
    return silver.terminations(s.table("tracker"), s.table("awards")).drop("termination_id")


@query(
    "p9_agencies_with_awards",
    """
    SELECT g.*, count(a.award_unique_key) AS n_awards
    FROM agencies AS g LEFT JOIN awards AS a ON a.awarding_agency_id = g.agency_id
    GROUP BY ALL
    """,
)
def p9(s: TableStore) -> DataFrame:
    per_agency = (
        s.table("awards")
        .groupBy(F.col("awarding_agency_id").alias("agency_id"))
        .agg(F.count("*").alias("n_awards"))
    )
    agencies = silver.agencies(s.spark)
    return agencies.join(per_agency, "agency_id", "left").select(
        *agencies.columns, F.coalesce("n_awards", F.lit(0)).alias("n_awards")
    )


# -- views ---------------------------------------------------------------------


@query(
    "v1_rescinded_opportunities",
    """
    SELECT o.opportunity_id, o.opportunity_number, o.title, o.estimated_total_funding,
           o.cfda_numbers, DATE '2026-04-06' AS removed_date,
           coalesce(list_has_any(
               list_concat(string_split(o.cfda_numbers, ','),
                           list_transform(string_split(o.cfda_numbers, ','), lambda c: trim(c))),
               (SELECT list(DISTINCT cfda_number) FROM awards)), false) AS has_matching_award
    FROM opportunities AS o
    WHERE o.opportunity_id IN (SELECT opportunity_id FROM old_pull)
      AND o.opportunity_id NOT IN (SELECT opportunity_id FROM new_pull)
    """,
)
def v1(s: TableStore) -> DataFrame:
    found = views.rescinded_opportunities(
        s.table("change_log"), s.table("opportunities"), s.table("awards")
    )
    return found.withColumn("removed_date", F.col("removed_date").cast("date"))


@query(
    "v2_disruption_by_directorate",
    f"""
    SELECT coalesce(t.directorate, a.awarding_sub_agency_name) AS directorate,
           count(*) AS n_terminated_awards,
           {cents('abs(coalesce(sum(t.post_termination_deobligation), 0))')} AS total_deobligated,
           {cents('coalesce(sum(t.nsf_total_budget), 0)')} AS total_at_risk_budget,
           count(*) FILTER (t.reinstated) AS n_reinstated
    FROM terminations AS t LEFT JOIN awards AS a USING (award_id_fain)
    GROUP BY 1
    """,
)
def v2(s: TableStore) -> DataFrame:
    return views.disruption_by_directorate(s.table("terminations"), s.table("awards"))


@query(
    "v3_disruption_by_recipient",
    f"""
    SELECT r.recipient_uei, r.recipient_name, r.state_code,
           count(*) AS n_terminated_awards,
           {cents('abs(coalesce(sum(t.post_termination_deobligation), 0))')} AS total_deobligated
    FROM terminations AS t
    JOIN awards AS a USING (award_id_fain)
    JOIN recipients AS r ON r.recipient_uei = a.recipient_uei
    GROUP BY ALL
    """,
)
def v3(s: TableStore) -> DataFrame:
    return views.disruption_by_recipient(
        s.table("terminations"), s.table("awards"), s.table("recipients")
    )


@query(
    "v4_awards_with_quality",
    f"""
    SELECT *,
           if(total_outlayed_amount IS NULL, 'not_yet_reported', 'reported')
               AS outlay_reporting_status,
           {PERIOD_STATUS} AS pop_status,
           action_date >= DATE '2026-01-06' AS action_in_reporting_lag_window
    FROM awards
    """,
)
def v4(s: TableStore) -> DataFrame:
    return views.awards_with_quality(s.table("awards").drop("pulled_at"), CFG)


@query(
    "v5_disbursement_progress",
    f"""
    SELECT award_unique_key, award_id_fain, awarding_sub_agency_name, total_obligated_amount,
           least(total_outlayed_amount, total_obligated_amount) AS effective_outlay,
           least(100.0::DOUBLE, {rounded(pct('least(total_outlayed_amount, total_obligated_amount)', 'total_obligated_amount'), 1)}) AS pct_disbursed
    FROM awards WHERE total_outlayed_amount IS NOT NULL AND total_obligated_amount > 0
    """,
)
def v5(s: TableStore) -> DataFrame:
    return views.disbursement_progress(s.table("awards"))


@query(
    "v6_active_funding",
    f"""
    SELECT awarding_sub_agency_name AS directorate, count(*) AS n_active_awards,
           {cents('sum(total_obligated_amount)')} AS total_obligated_active,
           count(total_outlayed_amount) AS n_with_outlay_reported,
           {cents('sum(total_outlayed_amount)')} AS total_outlaid_reported,
           {rounded(pct('count(total_outlayed_amount)', 'count(*)'), 1)} AS pct_outlay_reported
    FROM awards WHERE is_active GROUP BY 1
    """,
)
def v6(s: TableStore) -> DataFrame:
    return views.active_funding(s.table("awards"))


@query("v7_currently_open_opportunities", "SELECT * FROM open_now")
def v7(s: TableStore) -> DataFrame:
    return views.currently_open_opportunities(s.table("opportunities"), CFG)


@query(
    "v8_directorate_resilience",
    f"""
    , starts AS (
        SELECT awarding_sub_agency_name AS directorate,
               CASE WHEN action_date BETWEEN DATE '2024-10-01' AND DATE '2025-03-31' THEN 25
                    WHEN action_date BETWEEN DATE '2025-10-01' AND DATE '2026-03-31' THEN 26
               END AS half, federal_action_obligation AS amount
        FROM transactions WHERE action_type_description = 'NEW'
    ), halves AS (
        SELECT directorate, count(*) FILTER (half = 25) AS n25, count(*) FILTER (half = 26) AS n26,
               {cents('sum(amount) FILTER (half = 25)')} AS m25,
               {cents('coalesce(sum(amount) FILTER (half = 26), 0)')} AS m26
        FROM starts GROUP BY 1 HAVING count(*) FILTER (half = 25) > 0
    ), offers AS (
        SELECT directorate, count(*) AS n, sum(estimated_total_funding) AS funding
        FROM open_now GROUP BY 1
    )
    SELECT h.directorate, coalesce(f.n, 0) AS n_open_opportunities,
           {cents('coalesce(f.funding, 0)')} AS open_advertised_funding,
           h.n25 AS fy25_new_count, h.n26 AS fy26_new_count,
           {rounded(pct('h.n26', 'h.n25'), 1)} AS pct_count_retained,
           h.m25 AS fy25_new_oblig, h.m26 AS fy26_new_oblig,
           {rounded(pct('h.m26', 'h.m25'), 1)} AS pct_dollar_retained
    FROM halves AS h LEFT JOIN offers AS f USING (directorate)
    """,
)
def v8(s: TableStore) -> DataFrame:
    return views.directorate_resilience(s.table("monthly_cube"), s.table("opportunities"), CFG)


MONTHLY_SQL = f"""
    SELECT CAST(date_trunc('month', action_date) AS DATE) AS month,
           awarding_sub_agency_name AS directorate, count(*) AS n_transactions,
           {cents('sum(federal_action_obligation)')} AS net_obligation,
           {cents('sum(greatest(federal_action_obligation, 0))')} AS gross_obligated,
           {cents('abs(sum(least(federal_action_obligation, 0)))')} AS gross_deobligated,
           count(*) FILTER (federal_action_obligation < 0) AS n_deobligations
    FROM transactions WHERE action_date IS NOT NULL GROUP BY 1, 2
    """


@query("v9_monthly_obligations", MONTHLY_SQL)
def v9(s: TableStore) -> DataFrame:
    return views.monthly_obligations(s.table("monthly_cube"))


# -- dashboard -----------------------------------------------------------------


@query(
    "d1_termination_totals",
    f"""
    SELECT count(*) AS n_terms, count(*) FILTER (reinstated) AS n_reinst,
           {cents('abs(coalesce(sum(post_termination_deobligation), 0))')} AS deob
    FROM academic_terms
    """,
)
def d1(s: TableStore) -> DataFrame:
    return dashboard.termination_totals(*_scope(s), CFG)


PRE_POST_SQL = f"""
    , new_money AS (
        SELECT awarding_sub_agency_name AS dir,
               {cents("sum(federal_action_obligation) FILTER (action_date >= DATE '2024-10-01' AND action_date < DATE '2025-04-01')")} AS prior,
               {cents("coalesce(sum(federal_action_obligation) FILTER (action_date >= DATE '2025-10-01' AND action_date < DATE '2026-04-01'), 0)")} AS current
        FROM academic_tx WHERE action_type_description = 'NEW' GROUP BY 1
    ), exposure AS (
        SELECT a.awarding_sub_agency_name AS dir, count(DISTINCT a.award_unique_key) AS n_awards,
               count(DISTINCT t.termination_id) AS n_terms
        FROM awards AS a LEFT JOIN terminations AS t USING (award_id_fain)
        WHERE {FREEZE} BETWEEN a.period_of_perf_start AND a.period_of_perf_end
          AND a.recipient_uei IN (SELECT recipient_uei FROM academic)
        GROUP BY 1
    ), pre_post AS (
        SELECT p.dir, {rounded('100.0::DOUBLE * (1 - p.current / nullif(p.prior, 0))', 1)} AS pre_drop_pct,
               {rounded('p.prior / 1e6', 0)} AS fy25h1_m, e.n_awards, e.n_terms,
               {rounded(pct('e.n_terms', 'e.n_awards'), 2)} AS post_term_pct
        FROM new_money AS p LEFT JOIN exposure AS e USING (dir) WHERE p.dir <> 'OTHER'
    )
    """


@query("d2_pre_post_by_directorate", PRE_POST_SQL + "SELECT * FROM pre_post")
def d2(s: TableStore) -> DataFrame:
    terminations, awards, recipients = _scope(s)
    return dashboard.pre_post_by_directorate(
        s.table("monthly_cube"), awards, terminations, recipients, CFG, s.table("funded_directorates")
    )


TIMELINE_SQL = f"""
    , span AS (
        SELECT *, CAST(date_trunc('month', action_date) AS DATE) AS month FROM academic_tx
        WHERE action_date >= DATE '2025-01-01' AND action_date < DATE '2026-04-01'
    ), starts AS (
        SELECT month, count(*) AS n, sum(greatest(federal_action_obligation, 0)) AS gained
        FROM span WHERE action_type_description = 'NEW' GROUP BY 1
    ), losses AS (
        SELECT month, abs(sum(federal_action_obligation)) AS lost
        FROM span WHERE federal_action_obligation < 0 GROUP BY 1
    ), cuts AS (
        SELECT CAST(date_trunc('month', latest_termination_date) AS DATE) AS month, count(*) AS n
        FROM academic_terms WHERE latest_termination_date >= DATE '2025-01-01'
          AND latest_termination_date < DATE '2026-04-01' GROUP BY 1
    ), timeline AS (
        SELECT month, coalesce(starts.n, 0) AS n_new,
               {cents('coalesce(gained, 0)')} / 1e6 AS new_m,
               {cents('coalesce(lost, 0)')} / 1e6 AS clawback_m, coalesce(cuts.n, 0) AS n_terms
        FROM starts FULL JOIN losses USING (month) FULL JOIN cuts USING (month)
    )
    """


@query("d3_phase_timeline", TIMELINE_SQL + "SELECT * FROM timeline")
def d3(s: TableStore) -> DataFrame:
    return dashboard.phase_timeline(s.table("monthly_cube"), *_scope(s), CFG)


@query(
    "d4_topic_recovery",
    f"""
    SELECT {topic('project_title')} AS topic, count(*) AS n_terms,
           count(*) FILTER (reinstated) AS n_reinst,
           {rounded(pct('count(*) FILTER (reinstated)', 'count(*)'), 1)} AS pct_reinst
    FROM academic_terms GROUP BY 1
    """,
)
def d4(s: TableStore) -> DataFrame:
    return dashboard.topic_recovery(*_scope(s), CFG)


@query("d5_reinstatement_days", "SELECT days, topic FROM recovery")
def d5(s: TableStore) -> DataFrame:
    return dashboard.reinstatement_days(*_scope(s), CFG)


@query(
    "d6_reinstatement_boxplot",
    """
    SELECT p.position, h.topic, h.n, round_even(min(v.days)::DOUBLE, 1) AS low,
           round_even(h.q1, 1) AS q1, round_even(h.median, 1) AS median,
           round_even(h.q3, 1) AS q3, round_even(max(v.days)::DOUBLE, 1) AS high
    FROM recovery_hinges AS h JOIN topic_positions AS p USING (topic)
    JOIN recovery AS v ON v.topic = h.topic
      AND v.days BETWEEN h.q1 - 1.5 * (h.q3 - h.q1) AND h.q3 + 1.5 * (h.q3 - h.q1)
    GROUP BY p.position, h.topic, h.n, h.q1, h.median, h.q3
    """,
)
def d6(s: TableStore) -> DataFrame:
    return dashboard.reinstatement_boxplot(d5(s), s.spark, CFG)


@query(
    "d6_reinstatement_outliers",
    """
    SELECT v.topic, v.days FROM recovery AS v JOIN recovery_hinges AS h USING (topic)
    WHERE v.days NOT BETWEEN h.q1 - 1.5 * (h.q3 - h.q1) AND h.q3 + 1.5 * (h.q3 - h.q1)
    """,
)
def d6_outliers(s: TableStore) -> DataFrame:
    return dashboard.reinstatement_outliers(d5(s), CFG)


@query(
    "d7_top_programs",
    f"""
    SELECT coalesce(directorate, '(none)') AS directorate, nsf_program_name AS program,
           count(*) AS terms, count(*) FILTER (reinstated) AS reinst,
           {rounded(cents('abs(coalesce(sum(post_termination_deobligation), 0))') + ' / 1e6', 2)} AS deobl_m
    FROM academic_terms WHERE nsf_program_name IS NOT NULL
    GROUP BY 1, 2 HAVING count(*) >= 10
    ORDER BY terms DESC, directorate, program LIMIT 15
    """,
)
def d7(s: TableStore) -> DataFrame:
    return dashboard.top_programs(*_scope(s), CFG)


@query("d8_institution_choices", "SELECT * FROM choices")
def d8(s: TableStore) -> DataFrame:
    return institutions.institution_choices(
        s.table("recipients"), s.table("awards"), s.table("terminations"), CFG
    )


SEARCH_SQL = """
    SELECT display_name || ' — ' || state_code || if(n_terminations > 0,
           ' (' || n_terminations || ' terminated)', '') AS label, ueis
    FROM choices WHERE {where}
    ORDER BY display_name, canonical_name, state_code LIMIT 25
    """


@query(
    "d9_institution_search",
    SEARCH_SQL.format(where="n_terminations > 0 AND contains(lower(label), 'college')"),
)
def d9(s: TableStore) -> DataFrame:
    return institutions.institution_search(*_institutions(s), "College", terminations_only=True, cfg=CFG)


@query("fil10_institutions_of_state", SEARCH_SQL.format(where="state_code = 'S7'"))
def fil10(s: TableStore) -> DataFrame:
    return institutions.institution_search(*_institutions(s), state="S7", cfg=CFG)


@query("d10_institution_portfolio", "SELECT * FROM portfolio")
def d10(s: TableStore) -> DataFrame:
    return institutions.institution_portfolio(
        s.table("recipients"), s.table("awards"), s.table("terminations"), CFG
    )


@query("d8_institution_members", "SELECT * FROM members")
def d8_members(s: TableStore) -> DataFrame:
    """Recipients of each institution as rows."""
    return institutions.institution_members(s.table("recipients"), CFG)


# A fixed request, longer than what goes into a scan as literals.
ASKED = [f"{'U' + str(n):0>12}" for n in range(1, 121)]


@query(
    "d10_awards_of_listed_ids",
    "SELECT award_unique_key, recipient_uei FROM awards WHERE recipient_uei IN ("
    + ", ".join(f"'{u}'" for u in ASKED)
    + ")",
)
def d10_listed(s: TableStore) -> DataFrame:
    found = institutions.awards_of(s.table("awards"), ",".join(ASKED))
    return found.select("award_unique_key", "recipient_uei")


MINE = "portfolio WHERE recipient_uei IN (" + ", ".join(f"'{u}'" for u in ASKED) + ")"


def _asked(s: TableStore, function: str) -> DataFrame:
    sql.register_functions(s.spark, s.table("portfolio"))
    return s.spark.sql(f"SELECT * FROM {function}('{','.join(ASKED)}')")


@query("d10_sql_awards", f"SELECT * FROM {MINE}")
def d10_sql(s: TableStore) -> DataFrame:
    """D-10 to D-14 of listed recipients, as table functions."""
    return _asked(s, "institution_awards")


@query(
    "d11_sql_figures",
    f"""
    SELECT count(*) AS n_total, count(*) FILTER (status <> 'Terminated') AS n_active, count(*) FILTER (live_apr30) AS n_at_risk,
           count(*) FILTER (status <> 'Active') AS n_term, count(*) FILTER (status = 'Reinstated') AS n_reinst,
           {cents("sum(obligated) FILTER (status <> 'Terminated')")} AS active_funding, {cents('sum(deobligated)')} AS net_deob
    FROM {MINE}
    """,
)
def d11_sql(s: TableStore) -> DataFrame:
    return _asked(s, "institution_figures")


@query(
    "d12_sql_funding",
    f"""
    SELECT dir, round_even({cents('sum(obligated)')} / 1e6, 2) AS amt_m, count(*) AS n
    FROM {MINE} AND status IN ('Active', 'Reinstated') AND dir IS NOT NULL GROUP BY 1
    """,
)
def d12_sql(s: TableStore) -> DataFrame:
    return _asked(s, "institution_funding")


@query(
    "d13_sql_losses",
    f"""
    SELECT fain, coalesce(project_title, '—') AS project, dir AS directorate, coalesce(division, '—') AS division, program, status,
           round_even(obligated / 1000, 0) AS obligated_k, round_even(deobligated / 1000, 0) AS deobligated_k,
           strftime(terminated_on, '%Y-%m-%d') AS terminated, coalesce(strftime(reinstated_on, '%Y-%m-%d'), '—') AS reinstated, abstract
    FROM {MINE} AND status <> 'Active'
    """,
)
def d13_sql(s: TableStore) -> DataFrame:
    return _asked(s, "institution_losses")


@query(
    "d14_sql_largest_loss",
    f"SELECT program, obligated, fain FROM {MINE} AND status <> 'Active' AND obligated IS NOT NULL ORDER BY obligated DESC, fain, program LIMIT 1",
)
def d14_sql(s: TableStore) -> DataFrame:
    return _asked(s, "institution_largest_loss")


@query(
    "x3_change_log",
    """
    , changed AS (
        SELECT if(a.opportunity_id IS NULL, 'ADDED', 'REMOVED') AS change_type, NULL AS field_changed
        FROM old_pull AS a FULL JOIN new_pull AS b ON a.opportunity_id = b.opportunity_id
        WHERE a.opportunity_id IS NULL OR b.opportunity_id IS NULL
        UNION ALL SELECT 'MODIFIED', 'title' FROM old_pull AS a JOIN new_pull AS b USING (opportunity_id)
        WHERE a.title IS DISTINCT FROM b.title
        UNION ALL SELECT 'MODIFIED', 'close_date' FROM old_pull AS a JOIN new_pull AS b USING (opportunity_id)
        WHERE a.close_date IS DISTINCT FROM b.close_date
        UNION ALL SELECT 'MODIFIED', 'estimated_total_funding'
        FROM old_pull AS a JOIN new_pull AS b USING (opportunity_id)
        WHERE a.estimated_total_funding IS DISTINCT FROM b.estimated_total_funding
    )
    SELECT change_type, coalesce(field_changed, '-') AS field_changed, count(*) AS n FROM changed GROUP BY 1, 2
    UNION ALL SELECT 'ids', 'first', 1
    UNION ALL SELECT 'ids', 'last', count(*) FROM changed
    UNION ALL SELECT 'ids', 'distinct', count(*) FROM changed
    """,
)
def x3_log(s: TableStore) -> DataFrame:
    """The stored log by kind of change, and the range of its change_id."""
    log = s.table("change_log")
    field = F.coalesce("field_changed", F.lit("-")).alias("field_changed")
    ids = log.agg(
        F.min("change_id").alias("first"), F.max("change_id").alias("last"), F.count_distinct("change_id").alias("distinct")
    )
    shown = [ids.select(F.lit("ids"), F.lit(n), F.col(n).cast("bigint")) for n in ids.columns]
    return reduce(DataFrame.union, [log.groupBy("change_type", field).agg(F.count("*").alias("n")), *shown])


@query(
    "d10_portfolio_latest_termination",
    """
    SELECT canonical_name, state_code, recipient_uei, fain, max(terminated_on) AS terminated_on,
           any_value(obligated) AS obligated
    FROM portfolio GROUP BY 1, 2, 3, 4
    """,
)
def d10_latest(s: TableStore) -> DataFrame:
    rows = institutions.institution_portfolio(
        s.table("recipients"), s.table("awards"), s.table("terminations"), CFG, latest_only=True
    )
    return rows.select(
        "canonical_name", "state_code", "recipient_uei", "fain", "terminated_on", "obligated"
    )


SUMMARY_SQL = f"""
    , masks AS (
        SELECT *, status <> 'Active' AS cut, status <> 'Terminated' AS running,
               coalesce(live_apr30, false) AS live FROM portfolio
    ), cut_counts AS (
        SELECT canonical_name, state_code, dir, count(*) AS n FROM masks
        WHERE cut AND dir IS NOT NULL GROUP BY 1, 2, 3
        QUALIFY row_number() OVER (PARTITION BY canonical_name, state_code
                                   ORDER BY count(*) DESC, dir) = 1
    ), summary AS (
        SELECT m.canonical_name, m.state_code, count(*) AS n_total,
               {cents('coalesce(sum(obligated) FILTER (running), 0)')} AS active_funding,
               count(*) FILTER (running) AS n_active, count(*) FILTER (live) AS n_at_risk,
               count(*) FILTER (live AND cut) AS n_term_at_risk,
               {cents('coalesce(sum(obligated) FILTER (live), 0)')} AS at_risk_oblig,
               max(action_date) AS latest_action, count(*) FILTER (cut) AS n_term,
               count(*) FILTER (status = 'Reinstated') AS n_reinst,
               {cents('coalesce(sum(obligated) FILTER (cut), 0)')} AS term_funding,
               {cents('sum(deobligated)')} AS net_deob,
               coalesce({pct('count(*) FILTER (live AND cut)', 'count(*) FILTER (live)')}, 0) AS pct_term,
               coalesce(any_value(c.dir), 'None') AS most_dir, coalesce(any_value(c.n), 0) AS most_dir_n
        FROM masks AS m LEFT JOIN cut_counts AS c
          ON c.canonical_name = m.canonical_name AND c.state_code = m.state_code
        GROUP BY 1, 2
    )
    """


@query("d11_institution_summary", SUMMARY_SQL + "SELECT * FROM summary")
def d11(s: TableStore) -> DataFrame:
    return institutions.institution_summary(s.table("portfolio"))


@query(
    "d11_summary_text",
    SUMMARY_SQL
    + """
    SELECT canonical_name, state_code, if(n_term = 0,
           'No terminations recorded for this institution.',
           format('{:,}', n_term) || ' awards (' || CAST(CAST(pct_term AS DECIMAL(18,1)) AS VARCHAR)
           || '% of awards live on the freeze date) have been terminated, concentrated in '
           || most_dir || '.') AS summary_text
    FROM summary
    """,
)
def d11_text(s: TableStore) -> DataFrame:
    return institutions.summary_text(institutions.institution_summary(s.table("portfolio")))


@query(
    "d12_funding_by_directorate",
    f"""
    SELECT canonical_name, state_code, dir, round_even({cents('sum(obligated)')} / 1e6, 2) AS amt_m,
           count(*) AS n
    FROM portfolio WHERE status IN ('Active', 'Reinstated') AND dir IS NOT NULL GROUP BY 1, 2, 3
    """,
)
def d12(s: TableStore) -> DataFrame:
    return institutions.funding_by_directorate(s.table("portfolio"))


@query(
    "d13_institution_terminations",
    """
    SELECT canonical_name, state_code, fain, coalesce(project_title, '—') AS project,
           dir AS directorate, coalesce(division, '—') AS division, program, status,
           round_even(obligated / 1000, 0) AS obligated_k,
           round_even(deobligated / 1000, 0) AS deobligated_k,
           strftime(terminated_on, '%Y-%m-%d') AS terminated,
           coalesce(strftime(reinstated_on, '%Y-%m-%d'), '—') AS reinstated, abstract
    FROM portfolio WHERE status <> 'Active'
    """,
)
def d13(s: TableStore) -> DataFrame:
    return institutions.institution_terminations(s.table("portfolio"))


@query(
    "d14_largest_termination",
    """
    SELECT canonical_name, state_code, program, obligated,
           'Largest single termination: ' || program || ' ($'
           || CAST(CAST(obligated / 1e6 AS DECIMAL(18,2)) AS VARCHAR) || 'M obligated).' AS text
    FROM portfolio WHERE status <> 'Active' AND obligated IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY canonical_name, state_code
                               ORDER BY obligated DESC, fain, program) = 1
    """,
)
def d14(s: TableStore) -> DataFrame:
    return institutions.largest_termination(s.table("portfolio"))


@query(
    "d15_headline_kpis",
    PRE_POST_SQL
    + TIMELINE_SQL
    + f"""
    , money AS (
        SELECT (SELECT {cents("sum(new_m * 1e6) FILTER (month < DATE '2025-04-01')")} FROM timeline) AS p3,
               (SELECT {cents("sum(new_m * 1e6) FILTER (month >= DATE '2025-10-01')")} FROM timeline) AS c3,
               (SELECT {cents("sum(amount) FILTER (month >= DATE '2024-10-01' AND month < DATE '2025-04-01')")} FROM monthly_new) AS p6,
               (SELECT {cents("sum(amount) FILTER (month >= DATE '2025-10-01' AND month < DATE '2026-04-01')")} FROM monthly_new) AS c6
    ), totals AS (
        SELECT count(*) AS n_terms, count(*) FILTER (reinstated) AS n_reinst FROM academic_terms
    )
    SELECT {FREEZE} AS freeze_date, n_terms, n_reinst, {pct('n_reinst', 'n_terms')} AS pct_reinst,
           if(p3 > 0, {pct('(c3 - p3)', 'p3')}, NULL) AS change_series_pct,
           if(p6 > 0, {pct('(c6 - p6)', 'p6')}, NULL) AS change_full_pct,
           (SELECT post_term_pct FROM pre_post WHERE dir = 'EDU') AS edu_post_pct,
           format('{{:,}}', n_reinst) || ' reinstated ('
           || CAST(CAST({pct('n_reinst', 'n_terms')} AS DECIMAL(18,0)) AS VARCHAR) || '%)' AS reinstated_text
    FROM totals, money
    """,
)
def d15(s: TableStore) -> DataFrame:
    halves = dashboard.half_year_change(
        s.table("timeline"), s.table("monthly_cube"), s.table("recipients"), CFG
    )
    return dashboard.headline_kpis(
        s.table("termination_totals"), halves, s.table("pre_post"), CFG
    )


@query(
    "d16_dataset_counts",
    """
    SELECT (SELECT count(*) FROM transactions) AS n_tx, (SELECT count(*) FROM awards) AS n_awards,
           (SELECT count(*) FROM opportunities) AS n_opps,
           (SELECT count(*) FROM terminations) AS n_terms
    """,
)
def d16(s: TableStore) -> DataFrame:
    return dashboard.dataset_counts(
        s.table("transactions"), s.table("awards"), s.table("opportunities"), s.table("terminations")
    )


# -- extras --------------------------------------------------------------------


@query(
    "x1_same_month_baseline",
    f"""
    , base AS (
        SELECT month, {cents('sum(amount)')} / 1e6 AS m FROM monthly_new
        WHERE month >= DATE '2023-01-01' AND month < DATE '2025-05-01'
          AND NOT (directorate = 'TIP' AND month = DATE '2024-02-01') GROUP BY 1
    ), usual AS (
        SELECT month(month) AS k, count(*) AS n, avg(m) AS mean, stddev_samp(m) AS sd
        FROM base GROUP BY 1
    ), recent AS (
        SELECT month, {cents('sum(amount)')} / 1e6 AS m FROM monthly_new
        WHERE month >= DATE '2025-10-01' AND month < DATE '2026-04-01' GROUP BY 1
    )
    SELECT r.month, r.m AS total_m, u.n AS n_baseline, {cents('u.mean')} AS baseline_mean_m,
           {cents('u.sd')} AS baseline_sd_m, {cents('u.mean - u.sd')} AS lower_m,
           {cents('u.mean + u.sd')} AS upper_m,
           CASE WHEN r.m < u.mean - u.sd THEN 'below' WHEN r.m > u.mean + u.sd THEN 'above'
                WHEN u.sd IS NOT NULL THEN 'within' END AS position
    FROM recent AS r LEFT JOIN usual AS u ON u.k = month(r.month)
    """,
)
def x1(s: TableStore) -> DataFrame:
    return baselines.same_month_baseline(s.table("monthly_cube"), s.table("recipients"), CFG)


@query("x2_untracked_disruption", "SELECT * FROM untracked")
def x2(s: TableStore) -> DataFrame:
    return baselines.untracked_disruption(
        s.table("transactions"), s.table("awards"), s.table("terminations"), CFG, s.table("recipients")
    )


@query(
    "x3_snapshot_diff",
    """
    , pairs AS (
        SELECT coalesce(a.opportunity_id, b.opportunity_id) AS opportunity_id, a.opportunity_id IS NULL AS fresh,
               b.opportunity_id IS NULL AS gone, a.title AS t1, b.title AS t2,
               CAST(a.close_date AS VARCHAR) AS c1, CAST(b.close_date AS VARCHAR) AS c2,
               CAST(CAST(a.estimated_total_funding AS DECIMAL(18,2)) AS VARCHAR) AS f1,
               CAST(CAST(b.estimated_total_funding AS DECIMAL(18,2)) AS VARCHAR) AS f2
        FROM old_pull AS a FULL JOIN new_pull AS b ON a.opportunity_id = b.opportunity_id
    )
    , changed AS (
    SELECT opportunity_id, if(fresh, 'ADDED', 'REMOVED') AS change_type, NULL::VARCHAR AS field_changed,
           NULL::VARCHAR AS old_value, NULL::VARCHAR AS new_value FROM pairs WHERE fresh OR gone
    UNION ALL SELECT opportunity_id, 'MODIFIED', 'title', t1, t2 FROM pairs
    WHERE NOT fresh AND NOT gone AND t1 IS DISTINCT FROM t2
    UNION ALL SELECT opportunity_id, 'MODIFIED', 'close_date', c1, c2 FROM pairs
    WHERE NOT fresh AND NOT gone AND c1 IS DISTINCT FROM c2
    UNION ALL SELECT opportunity_id, 'MODIFIED', 'estimated_total_funding', f1, f2 FROM pairs
    WHERE NOT fresh AND NOT gone AND f1 IS DISTINCT FROM f2
    )
    SELECT c.*, CAST(2 AS INTEGER) AS snapshot_id, '2026-04-06 00:00:00' AS snapshot_date,
           '2026-04-06 00:00:00' AS detected_at FROM changed AS c
    """,
)
def x3(s: TableStore) -> DataFrame:
    opportunities = s.table("opportunities")
    changed = changes.diff_snapshots(
        adapter.old_snapshot(opportunities), adapter.new_snapshot(opportunities), 2, CFG
    )
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("snapshot_date", "detected_at")}
    return changed.withColumns(times)


@query(
    "x4_state_exposure",
    f"""
    SELECT r.state_code, count(DISTINCT a.award_unique_key) AS n_awards,
           count(DISTINCT t.termination_id) AS n_terms,
           {rounded(pct('count(DISTINCT t.termination_id)', 'count(DISTINCT a.award_unique_key)'), 2)} AS term_pct
    FROM awards AS a JOIN academic AS r USING (recipient_uei)
    LEFT JOIN terminations AS t ON t.award_id_fain = a.award_id_fain
    WHERE {FREEZE} BETWEEN a.period_of_perf_start AND a.period_of_perf_end GROUP BY 1
    """,
)
def x4(s: TableStore) -> DataFrame:
    return baselines.state_exposure(
        s.table("awards"), s.table("terminations"), s.table("recipients"), CFG
    )


@query(
    "x5_lifecycle_funnel",
    f"""
    , held AS (SELECT * FROM awards WHERE recipient_uei IN (SELECT recipient_uei FROM academic))
    , exposed AS (
        SELECT * FROM held WHERE {FREEZE} BETWEEN period_of_perf_start AND period_of_perf_end
    )
    SELECT 1 AS position, 'posted' AS stage, count(*) AS n FROM opportunities
    UNION ALL SELECT 2, 'obligated', count(*) FROM held WHERE total_obligated_amount > 0
    UNION ALL SELECT 3, 'at risk', count(*) FROM exposed
    UNION ALL SELECT 4, 'terminated', count(*) FROM terminations
    WHERE award_id_fain IN (SELECT award_id_fain FROM exposed)
    UNION ALL SELECT 5, 'reinstated', count(*) FROM terminations
    WHERE reinstated AND award_id_fain IN (SELECT award_id_fain FROM exposed)
    UNION ALL SELECT 6, 'possibly untracked', count(*) FROM untracked
    """,
)
def x5(s: TableStore) -> DataFrame:
    return baselines.lifecycle_funnel(
        s.table("opportunities"), s.table("awards"), s.table("terminations"), x2(s), s.table("recipients"), CFG
    )


@query(
    "x6_snapshot_register",
    """
    SELECT 1 AS snapshot_id, '2026-04-06 00:00:00' AS snapshot_date, 'grants.gov' AS source,
           count(*) AS record_count, 'first pull' AS notes FROM old_pull
    UNION ALL SELECT 2, '2026-04-06 00:00:00', 'grants.gov', count(*), NULL FROM new_pull
    """,
)
def x6(s: TableStore) -> DataFrame:
    opportunities = s.table("opportunities")
    first = changes.snapshot_entry(adapter.old_snapshot(opportunities), 1, "first pull", CFG)
    second = changes.snapshot_entry(adapter.new_snapshot(opportunities), 2, None, CFG)
    register = first.unionByName(second)
    return register.withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd HH:mm:ss"))


def _pull_sql(k: int) -> str:
    where, rules = adapter.PULLS[k]
    replaced = ", ".join(f"{e} AS {n}" for n, e in rules.items())
    star = f"* REPLACE ({replaced})" if rules else "*"
    return f"pull{k} AS (SELECT {star} FROM opportunities WHERE {where})"


def _step_sql(k: int) -> str:
    """Changes from pull k to the next one, field by field."""
    edits = [
        f"""SELECT opportunity_id, 'MODIFIED' AS change_type, '{name}' AS field_changed, {a} AS old_value, {b} AS new_value
        FROM both{k} WHERE NOT fresh AND NOT gone AND {a} IS DISTINCT FROM {b}"""
        for name, a, b in (("title", "t1", "t2"), ("close_date", "c1", "c2"), ("estimated_total_funding", "f1", "f2"))
    ]
    amount = "CAST(CAST({}.estimated_total_funding AS DECIMAL(18,2)) AS VARCHAR) AS {}"
    return f"""both{k} AS (
        SELECT coalesce(a.opportunity_id, b.opportunity_id) AS opportunity_id, a.opportunity_id IS NULL AS fresh,
               b.opportunity_id IS NULL AS gone, a.title AS t1, b.title AS t2, CAST(a.close_date AS VARCHAR) AS c1,
               CAST(b.close_date AS VARCHAR) AS c2, {amount.format("a", "f1")}, {amount.format("b", "f2")}
        FROM pull{k} AS a FULL JOIN pull{k + 1} AS b ON a.opportunity_id = b.opportunity_id
    ), step{k} AS (
        SELECT opportunity_id, if(fresh, 'ADDED', 'REMOVED') AS change_type, NULL::VARCHAR AS field_changed,
               NULL::VARCHAR AS old_value, NULL::VARCHAR AS new_value FROM both{k} WHERE fresh OR gone
        UNION ALL {" UNION ALL ".join(edits)}
    )"""


_STEPS = range(len(adapter.PULLS) - 1)
_PULLS_SQL = ", ".join(_pull_sql(k) for k in range(len(adapter.PULLS)))


@query(
    "x7_snapshot_chain",
    f""", {_PULLS_SQL}, {", ".join(map(_step_sql, _STEPS))}
    {" UNION ALL ".join(
        f"SELECT *, CAST({adapter.PULL_IDS[k + 1]} AS INTEGER) AS snapshot_id, '2026-04-06 00:00:00' AS snapshot_date, "
        f"'2026-04-06 00:00:00' AS detected_at FROM step{k}" for k in _STEPS)}
    """,
)
def x7(s: TableStore) -> DataFrame:
    """Four pulls, each against the one before, in one pass."""
    pulls = adapter.pulls(s.table("opportunities"))
    found = changes.chain_changes(pulls, pulls, CFG)
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("snapshot_date", "detected_at")})


@query(
    "x8_seen_snapshots",
    f""", {_PULLS_SQL}, held AS (
        {" UNION ALL ".join(f"SELECT opportunity_id, {k} AS k FROM pull{k}" for k in range(len(adapter.PULLS)))}
    ), stays AS (
        SELECT opportunity_id, k, k - row_number() OVER (PARTITION BY opportunity_id ORDER BY k) AS island FROM held
    ), seen AS (
        SELECT opportunity_id, CAST(10 * (min(k) + 1) AS INTEGER) AS first_id, CAST(10 * (max(k) + 1) AS INTEGER) AS last_id,
               count(*) AS n_pulls, count(DISTINCT island) AS n_stays
        FROM stays GROUP BY 1
    )
    SELECT o.* REPLACE (first_id AS first_seen_snapshot_id, last_id AS last_seen_snapshot_id), n_pulls, n_stays
    FROM opportunities AS o LEFT JOIN seen USING (opportunity_id)
    """,
)
def x8(s: TableStore) -> DataFrame:
    """Opportunities with the pulls that held them, and how often they came back."""
    opportunities = s.table("opportunities")
    pulls = adapter.pulls(opportunities)
    seen = changes.seen_snapshots(pulls, pulls)
    counts = seen.select("opportunity_id", "n_pulls", "n_stays")
    return changes.with_seen_snapshots(opportunities, seen).join(counts, "opportunity_id", "left")


# -- shared inputs -------------------------------------------------------------


def _institutions(s: TableStore) -> tuple[DataFrame, DataFrame, DataFrame]:
    return s.table("institutions"), s.table("institution_members"), s.table("institution_grams")


def _scope(s: TableStore) -> tuple[DataFrame, DataFrame, DataFrame]:
    return s.table("terminations"), s.table("awards"), s.table("recipients")

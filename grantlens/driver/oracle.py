"""Plain-SQL formulation of the conformed tables, as reusable CTEs.

The texts follow the definitions literally (window per key, distinct counts
after fan-out, chains of joins), not the shapes that the plans choose, so that
agreement says something about the plans.
"""

from __future__ import annotations

import re

from grantlens.driver import adapter
from grantlens.functions.classify import (
    CFDA_DIRECTORATES,
    OTHER_DIRECTORATE,
    OTHER_TOPIC,
    TOPIC_ORDER,
    TOPIC_RULES,
)
from grantlens.functions.text import NAME_SUFFIXES
from grantlens.plans.silver import AGENCY_SEED

AS_OF = "DATE '2026-04-06'"
FREEZE = "DATE '2025-04-30'"


def _select(rules: dict[str, str], source: str) -> str:
    columns = ",\n  ".join(f"{e} AS {name}" for name, e in rules.items())
    return f"SELECT\n  {columns}\nFROM {source}"


def directorate(code: str) -> str:
    arms = " ".join(f"WHEN {code} = '{k}' THEN '{v}'" for k, v in CFDA_DIRECTORATES.items())
    return f"(CASE {arms} ELSE '{OTHER_DIRECTORATE}' END)"


def topic(title: str) -> str:
    arms = " ".join(
        f"WHEN regexp_matches(lower({title}), '{pattern}') THEN '{label}'"
        for label, pattern in TOPIC_RULES
    )
    return f"(CASE {arms} ELSE '{OTHER_TOPIC}' END)"


def academic(name: str) -> str:
    return (
        f"regexp_matches(upper({name}), 'UNIVERSITY|COLLEGE|INSTITUTE OF TECHNOLOGY|POLYTECHNIC')"
    )


def rounded(expression: str, places: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def cents(expression: str) -> str:
    return rounded(expression, 2)


def pct(part: str, whole: str) -> str:
    return f"(100.0::DOUBLE * {part} / nullif({whole}, 0))"


def iso_date(text: str) -> str:
    return f"if(regexp_full_match(trim({text}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}'), TRY_CAST({text} AS DATE), NULL)"


def number(text: str) -> str:
    shape = "\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*"
    return f"if(regexp_full_match({text}, '{shape}'), TRY_CAST({text} AS DOUBLE), NULL)"


PERIOD_STATUS = f"""CASE
    WHEN period_of_perf_end IS NULL THEN 'unknown'
    WHEN period_of_perf_start > {AS_OF} THEN 'not_yet_started'
    WHEN date_diff('day', period_of_perf_end, {AS_OF}) > 365 THEN 'ended_over_1yr'
    ELSE if(period_of_perf_end < {AS_OF}, 'ended_under_1yr', 'in_progress') END"""


def display_name(name: str) -> str:
    words = f"regexp_extract_all({name}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+')"
    cased = (
        f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), '')"
    )
    return f"trim(regexp_replace({cased}, '\\s+', ' ', 'g'))"


def canonical_name(name: str) -> str:
    no_article = f"regexp_replace({name}, '^\\s*THE\\s+', '', 'i')"
    endings = "|".join(NAME_SUFFIXES)
    no_suffix = f"regexp_replace({no_article}, '\\s*[,.]?\\s*(?:{endings})\\.?\\s*$', '', 'i')"
    return f"upper(trim(regexp_replace({no_suffix}, '\\s+', ' ', 'g')))"


def _agency_rows() -> str:
    def literal(value):
        if value is None:
            return "NULL"
        return f"'{value}'" if isinstance(value, str) else str(value)

    rows = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in AGENCY_SEED)
    names = "agency_id, agency_code, agency_name, agency_level, parent_agency_id"
    return f"SELECT * FROM (VALUES {rows}) AS seed({names})"


_GRANT_VARIANTS = "\nUNION ALL\n".join(
    _select(adapter.grants_rules(kind, days), f"part WHERE {where}")
    for where, kind, days in adapter.GRANTS_VARIANTS
)
_TX_ORDER = (
    "action_date, transaction_unique_key, award_unique_key, award_id_fain, recipient_uei, "
    "cfda_number, awarding_sub_agency_name, action_type_description, "
    "federal_action_obligation, assistance_type_description, transaction_description"
)
_GRANT_COLUMNS = ", ".join(adapter.grants_rules("", 0))


def _nulls_last(columns: str) -> str:
    return ", ".join(f"{c.strip()} ASC NULLS LAST" for c in columns.split(","))


CTES: dict[str, str] = {
    "raw_usaspending": _select(
        adapter.USASPENDING,
        "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey",
    ),
    "usaspending": (
        "SELECT *, period_of_performance_current_end_date >= "
        f"{AS_OF} AS is_active FROM raw_usaspending"
    ),
    "raw_tracker": _select(
        adapter.TERMINATIONS,
        f"(SELECT * FROM orders WHERE {adapter.TERMINATIONS_WHERE} UNION ALL "
        f"SELECT * FROM orders WHERE {adapter.TERMINATIONS_WHERE} "
        f"AND {adapter.TERMINATIONS_COPIED}) AS picked",
    ),
    "tracker": (
        "SELECT *, (coalesce(lower(reinstated), '') = 'true' "
        "OR coalesce(lower(terminated), '') = 'false') AS is_active FROM raw_tracker"
    ),
    "raw_grants": _GRANT_VARIANTS,
    "grants": (
        "SELECT *, regexp_matches(lower(coalesce(record_type, '')), 'synopsis|forecast') "
        "AS is_active FROM raw_grants "
        "WHERE coalesce(contains(lower(AgencyName), 'national science foundation'), false) "
        "OR coalesce(AgencyCode ^@ 'NSF', false) "
        "OR coalesce(regexp_matches(CFDANumbers, '(^|,)47[.]'), false)"
    ),
    "recipients": (
        "SELECT recipient_uei, recipient_name, CAST(NULL AS VARCHAR) AS parent_uei, "
        "recipient_state_code AS state_code, recipient_city_name AS city_name, "
        "recipient_county_name AS county_name, recipient_zip_code AS zip_code "
        "FROM usaspending WHERE coalesce(recipient_uei, '') <> '' "
        "QUALIFY row_number() OVER (PARTITION BY recipient_uei ORDER BY "
        "action_date DESC NULLS LAST, "
        + _nulls_last(
            "assistance_transaction_unique_key, recipient_name, recipient_state_code, "
            "recipient_city_name, recipient_county_name, recipient_zip_code"
        )
        + ") = 1"
    ),
    "opportunities": (
        "SELECT OpportunityID AS opportunity_id, 1 AS agency_id, "
        "OpportunityNumber AS opportunity_number, OpportunityTitle AS title, "
        f"CFDANumbers AS cfda_numbers, {iso_date('PostDate')} AS post_date, "
        f"{iso_date('CloseDate')} AS close_date, "
        f"{iso_date('ArchiveDate')} AS archive_date, "
        f"{number('EstimatedTotalProgramFunding')} AS estimated_total_funding, "
        f"{number('AwardCeiling')} AS award_ceiling, "
        f"{number('AwardFloor')} AS award_floor, Description AS description, is_active, "
        "CAST(NULL AS INTEGER) AS first_seen_snapshot_id, "
        "CAST(NULL AS INTEGER) AS last_seen_snapshot_id "
        "FROM grants WHERE OpportunityID IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY OpportunityID ORDER BY "
        "if(contains(lower(record_type), 'synopsis'), 0, 1), LastUpdatedDate DESC NULLS LAST, "
        + _nulls_last(_GRANT_COLUMNS)
        + ") = 1"
    ),
    "award_groups": (
        "SELECT assistance_award_unique_key AS award_unique_key, "
        "min(award_id_fain) AS award_id_fain, min(recipient_uei) AS recipient_uei, "
        "min(cfda_number) AS cfda_number, min(cfda_title) AS cfda_title, "
        "max(total_obligated_amount) AS total_obligated_amount, "
        "max(total_outlayed_amount_for_overall_award) AS total_outlayed_amount, "
        "min(period_of_performance_start_date) AS period_of_perf_start, "
        "max(period_of_performance_current_end_date) AS period_of_perf_end, "
        "max(action_date) AS action_date, min(transaction_description) AS description "
        "FROM usaspending WHERE assistance_award_unique_key IS NOT NULL "
        "AND coalesce(recipient_uei, '') <> '' GROUP BY ALL"
    ),
    "award_rollup": (
        "SELECT award_unique_key, award_id_fain, recipient_uei, 1 AS awarding_agency_id, "
        f"{directorate('cfda_number')} AS awarding_sub_agency_name, cfda_number, cfda_title, "
        "total_obligated_amount, total_outlayed_amount, period_of_perf_start, "
        "period_of_perf_end, action_date, description, "
        f"period_of_perf_end >= {AS_OF} AS is_active "
        "FROM award_groups WHERE award_id_fain IS NOT NULL"
    ),
    "awards": (
        "SELECT * FROM (SELECT * FROM award_rollup QUALIFY row_number() OVER "
        "(PARTITION BY award_id_fain ORDER BY award_unique_key) = 1) AS firsts "
        "WHERE recipient_uei IN (SELECT recipient_uei FROM recipients)"
    ),
    "transaction_rows": (
        "SELECT assistance_transaction_unique_key AS transaction_unique_key, "
        "assistance_award_unique_key AS award_unique_key, award_id_fain, recipient_uei, "
        f"cfda_number, {directorate('cfda_number')} AS awarding_sub_agency_name, action_date, "
        "action_type_description, federal_action_obligation, assistance_type_description, "
        "transaction_description FROM usaspending "
        "WHERE assistance_transaction_unique_key IS NOT NULL"
    ),
    "transactions": (
        "SELECT * FROM transaction_rows "
        "WHERE award_unique_key IN (SELECT award_unique_key FROM awards) "
        "QUALIFY row_number() OVER (PARTITION BY transaction_unique_key ORDER BY "
        f"{_nulls_last(_TX_ORDER)}) = 1"
    ),
    "termination_rows": (
        "SELECT grant_id AS award_id_fain, project_title, status AS current_status, "
        f"{iso_date('termination_date')} AS latest_termination_date, "
        "TRY_CAST(reinstated AS BOOLEAN) AS reinstated, "
        f"{iso_date('reinstatement_date')} AS reinstatement_date, "
        f"{number('post_termination_deobligation')} AS post_termination_deobligation, "
        f"{number('nsf_total_budget')} AS nsf_total_budget, "
        f"{number('estimated_remaining')} AS estimated_remaining, "
        "directorate, division, nsf_program_name, abstract, is_active FROM tracker"
    ),
    "terminations": (
        "SELECT row_number() OVER () AS termination_id, r.* REPLACE "
        "(if(r.award_id_fain IN (SELECT award_id_fain FROM awards), r.award_id_fain, NULL) "
        "AS award_id_fain) FROM termination_rows AS r"
    ),
    "agencies": _agency_rows(),
    "academic": f"SELECT * FROM recipients WHERE {academic('recipient_name')}",
    "academic_fains": (
        "SELECT award_id_fain FROM awards "
        "WHERE recipient_uei IN (SELECT recipient_uei FROM academic)"
    ),
    "academic_tx": (
        "SELECT * FROM transactions WHERE recipient_uei IN (SELECT recipient_uei FROM academic)"
    ),
    "academic_terms": (
        "SELECT * FROM terminations "
        "WHERE award_id_fain IN (SELECT award_id_fain FROM academic_fains)"
    ),
    "open_now": (
        "SELECT opportunity_id, opportunity_number, title, cfda_numbers, "
        f"{directorate('string_split(cfda_numbers, chr(44))[1]')} AS directorate, post_date, "
        "close_date, estimated_total_funding, award_ceiling, award_floor, description "
        f"FROM opportunities WHERE is_active AND (close_date >= {AS_OF} OR (close_date IS NULL "
        "AND post_date >= DATE '2024-10-06'))"
    ),
    "old_pull": f"SELECT * FROM opportunities WHERE {adapter.OLD_SNAPSHOT}",
    "new_pull": (
        f"SELECT * REPLACE ({adapter.NEW_TITLE} AS title, "
        f"{adapter.NEW_CLOSE_DATE} AS close_date, "
        f"{adapter.NEW_FUNDING} AS estimated_total_funding) "
        f"FROM opportunities WHERE {adapter.NEW_SNAPSHOT}"
    ),
    "members": (
        f"SELECT recipient_uei, {canonical_name('recipient_name')} AS canonical_name, "
        f"coalesce(state_code, '?') AS state_code, {display_name('recipient_name')} AS display_name "
        f"FROM academic WHERE trim(recipient_name) <> '' "
        f"AND {canonical_name('recipient_name')} <> ''"
    ),
    "choices": (
        "SELECT m.canonical_name, m.state_code, min(m.display_name) AS display_name, "
        "string_agg(DISTINCT m.recipient_uei, ',' ORDER BY m.recipient_uei) AS ueis, "
        "count(DISTINCT m.recipient_uei) AS n_variants, "
        "count(DISTINCT t.termination_id) AS n_terminations "
        "FROM members AS m JOIN awards AS a USING (recipient_uei) "
        "LEFT JOIN terminations AS t ON t.award_id_fain = a.award_id_fain GROUP BY 1, 2"
    ),
    "portfolio": (
        "SELECT m.canonical_name, m.state_code, a.recipient_uei, a.award_id_fain AS fain, "
        "t.project_title, a.awarding_sub_agency_name AS dir, t.division, "
        "coalesce(t.nsf_program_name, a.cfda_title, '(unknown)') AS program, "
        "if(t.termination_id IS NULL, 'Active', "
        "if(coalesce(t.reinstated, false), 'Reinstated', 'Terminated')) AS status, "
        "a.period_of_perf_start AS pop_start, a.period_of_perf_end AS pop_end, a.action_date, "
        "a.total_obligated_amount AS obligated, "
        "abs(coalesce(t.post_termination_deobligation, 0)) AS deobligated, "
        "t.latest_termination_date AS terminated_on, t.reinstatement_date AS reinstated_on, "
        f"t.abstract, {FREEZE} BETWEEN a.period_of_perf_start AND a.period_of_perf_end "
        "AS live_apr30 FROM members AS m JOIN awards AS a USING (recipient_uei) "
        "LEFT JOIN terminations AS t ON t.award_id_fain = a.award_id_fain"
    ),
    "recovery": (
        f"SELECT CAST(reinstatement_date - latest_termination_date AS INTEGER) AS days, "
        f"{topic('project_title')} AS topic FROM academic_terms "
        "WHERE reinstated AND reinstatement_date IS NOT NULL "
        "AND latest_termination_date IS NOT NULL"
    ),
    "recovery_ranked": (
        "SELECT topic, days, row_number() OVER (PARTITION BY topic ORDER BY days) AS r, "
        "count(*) OVER (PARTITION BY topic) AS n FROM recovery"
    ),
    "recovery_hinges": (
        "SELECT topic, n, (lo + hi) / 2 AS q1, (m1 + m2) / 2 AS median, (up1 + up2) / 2 AS q3 "
        "FROM (SELECT topic, n, "
        "max(days) FILTER (r = floor(floor((n + 3) / 2) / 2)) AS lo, "
        "max(days) FILTER (r = ceil(floor((n + 3) / 2) / 2)) AS hi, "
        "max(days) FILTER (r = floor((n + 1) / 2)) AS m1, "
        "max(days) FILTER (r = ceil((n + 1) / 2)) AS m2, "
        "max(days) FILTER (r = floor(n + 1 - floor((n + 3) / 2) / 2)) AS up1, "
        "max(days) FILTER (r = ceil(n + 1 - floor((n + 3) / 2) / 2)) AS up2 "
        "FROM recovery_ranked WHERE n >= 3 GROUP BY topic, n) AS ranks"
    ),
    "topic_positions": "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{t}')" for i, t in enumerate(TOPIC_ORDER))
    + ") AS listed(position, topic)",
    "monthly_new": (
        "SELECT CAST(date_trunc('month', action_date) AS DATE) AS month, "
        "awarding_sub_agency_name AS directorate, federal_action_obligation AS amount "
        "FROM academic_tx WHERE action_type_description = 'NEW' "
        "AND federal_action_obligation > 0"
    ),
    "untracked": (
        "SELECT a.award_unique_key, a.award_id_fain, a.recipient_uei, "
        "a.awarding_sub_agency_name AS directorate, "
        f"{cents('sum(x.federal_action_obligation)')} AS net_after_freeze "
        "FROM transactions AS x JOIN awards AS a USING (award_unique_key) "
        f"WHERE x.action_date > {FREEZE} "
        "AND a.recipient_uei IN (SELECT recipient_uei FROM academic) AND NOT EXISTS (SELECT 1 FROM terminations AS t "
        "WHERE t.award_id_fain = a.award_id_fain) GROUP BY 1, 2, 3, 4 "
        "HAVING sum(CAST(x.federal_action_obligation AS DECIMAL(28,6))) < -100000"
    ),
}


def with_tables(body: str) -> str:
    """Prefix a query with the CTEs it needs, directly or through other CTEs."""
    names = list(CTES)
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in names:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    parts = [f"{name} AS (\n{CTES[name]}\n)" for name in names if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()

"""SQL functions: the two classification maps, and the products of listed recipients.

All are built-in expressions behind a name, so a query that calls them is
planned like one that spells them out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grantlens.functions.classify import CFDA_DIRECTORATES, OTHER_DIRECTORATE, OTHER_TOPIC, TOPIC_RULES
from grantlens.plans.institutions import UEI_SHAPE

PORTFOLIO = "grantlens_portfolio"
# What the functions of listed recipients see of the request.
ASKED = "split(regexp_replace(ueis, ',$', ''), ',')"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def dash(value: str) -> str:
    """A long dash for missing text."""
    return f"coalesce({value}, '—')"


def scalar_functions() -> dict[str, str]:
    """Definitions of nsf_directorate(code) and nsf_topic(title)."""
    codes = " ".join(f"WHEN {literal(c)} THEN {literal(d)}" for c, d in CFDA_DIRECTORATES.items())
    topics = " ".join(f"WHEN lower(title) RLIKE {literal(p)} THEN {literal(t)}" for t, p in TOPIC_RULES)
    return {
        "nsf_directorate(code STRING) RETURNS STRING": f"CASE code {codes} ELSE {literal(OTHER_DIRECTORATE)} END",
        "nsf_topic(title STRING) RETURNS STRING": f"CASE {topics} ELSE {literal(OTHER_TOPIC)} END",
    }


def table_functions(portfolio: DataFrame) -> dict[str, str]:
    """Definitions of the products of the recipients in a comma-separated request.

    One malformed id voids the request, as everywhere.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in portfolio.schema.fields)
    # One pattern for the whole request: a lambda over its ids would be evaluated for every row of the portfolio.
    one = f"(?:{UEI_SHAPE.strip('^$')})"
    valid = f"regexp_replace(ueis, ',$', '') RLIKE {literal(f'^{one}(?:,{one})*$')}"
    mine = f"{PORTFOLIO} WHERE {valid} AND array_contains({ASKED}, recipient_uei)"
    return {
        f"institution_awards(ueis STRING) RETURNS TABLE ({columns})": f"SELECT * FROM {mine}",
        "institution_funding(ueis STRING) RETURNS TABLE (dir STRING, amt_m DOUBLE, n BIGINT)": f"""
            SELECT dir, bround(CAST(round(CAST(sum(obligated) AS DECIMAL(38,10)), 2) AS DOUBLE) / 1e6, 2), count(*)
            FROM {mine} AND status IN ('Active', 'Reinstated') AND dir IS NOT NULL GROUP BY dir""",
        """institution_figures(ueis STRING) RETURNS TABLE (n_total BIGINT, n_active BIGINT, n_at_risk BIGINT,
            n_term BIGINT, n_reinst BIGINT, active_funding DOUBLE, net_deob DOUBLE)""": f"""
            SELECT count(*), count_if(status <> 'Terminated'), count_if(live_apr30), count_if(status <> 'Active'),
                   count_if(status = 'Reinstated'),
                   CAST(round(CAST(coalesce(sum(obligated) FILTER (WHERE status <> 'Terminated'), 0) AS DECIMAL(38,10)), 2) AS DOUBLE),
                   CAST(round(CAST(coalesce(sum(deobligated), 0) AS DECIMAL(38,10)), 2) AS DOUBLE)
            FROM {mine}""",
        """institution_losses(ueis STRING) RETURNS TABLE (fain STRING, project STRING, directorate STRING, division STRING,
            program STRING, status STRING, obligated_k DOUBLE, deobligated_k DOUBLE, terminated STRING, reinstated STRING,
            abstract STRING)""": f"""
            SELECT fain, {dash('project_title')}, dir, {dash('division')}, program, status, bround(obligated / 1000, 0),
                   bround(deobligated / 1000, 0), date_format(terminated_on, 'yyyy-MM-dd'),
                   {dash("date_format(reinstated_on, 'yyyy-MM-dd')")}, abstract
            FROM {mine} AND status <> 'Active' ORDER BY deobligated DESC, fain""",
        "institution_largest_loss(ueis STRING) RETURNS TABLE (program STRING, obligated DOUBLE, fain STRING)": f"""
            SELECT program, obligated, fain FROM {mine} AND status <> 'Active' AND obligated IS NOT NULL
            ORDER BY obligated DESC, fain, program LIMIT 1""",
    }


def register_functions(spark: SparkSession, portfolio: DataFrame) -> list[str]:
    """Create or replace the functions in the session, over a stored portfolio; returns their names."""
    portfolio.createOrReplaceTempView(PORTFOLIO)
    made = {**scalar_functions(), **table_functions(portfolio)}
    for head, body in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in made]

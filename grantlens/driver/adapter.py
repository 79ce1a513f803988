"""Raw feeds derived from the test tables.

The rules are SQL expressions that Spark and the checking engine both accept,
so both sides start from the same rows. Each rule plants an edge case that a
plan has to handle: repeated transaction keys, missing FAINs and recipients,
shared FAINs, NULL states, unparsable dates and amounts, exact copies.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def cents(expression: str) -> str:
    return f"round(CAST({expression} AS DECIMAL(18,4)), 2)"


USASPENDING_FROM = ["lineitem", "orders", "customer"]
USASPENDING = {
    "assistance_transaction_unique_key": (
        f"'T-' || {text('l_orderkey')} || '-' || {text('l_linenumber')}"
    ),
    "assistance_award_unique_key": f"'A-' || {text('l_orderkey')}",
    "award_id_fain": (
        "CASE WHEN l_linenumber = 6 THEN NULL "
        f"WHEN l_orderkey % 50 = 7 THEN 'F' || {text('l_orderkey - 1')} "
        f"ELSE 'F' || {text('l_orderkey')} END"
    ),
    "recipient_uei": (
        "CASE WHEN o_custkey % 53 = 0 AND l_linenumber = 3 THEN '' "
        f"ELSE lpad('U' || {text('o_custkey')}, 12, '0') END"
    ),
    "recipient_name": (
        "CASE o_custkey % 6 "
        f"WHEN 0 THEN 'THE UNIVERSITY OF NATION ' || {text('c_nationkey')} "
        f"WHEN 1 THEN 'NATION ' || {text('c_nationkey')} || ' COMMUNITY COLLEGE DISTRICT' "
        f"WHEN 2 THEN 'Nation  ' || {text('c_nationkey')} || ' Community College' "
        f"WHEN 3 THEN 'NATION ' || {text('c_nationkey')} || ' INSTITUTE OF TECHNOLOGY, INC.' "
        "WHEN 4 THEN c_mktsegment || ' HOLDINGS LLC' "
        "ELSE 'university of new mexico' END"
    ),
    "recipient_state_code": (
        f"CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE 'S' || {text('c_nationkey')} END"
    ),
    "recipient_city_name": f"'CITY ' || {text('l_orderkey % 5')}",
    "recipient_county_name": (
        f"CASE WHEN l_linenumber = 7 THEN NULL ELSE 'COUNTY ' || {text('l_linenumber')} END"
    ),
    "recipient_zip_code": f"lpad({text('l_partkey % 100000')}, 5, '0')",
    "cfda_number": (
        "CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE CASE l_orderkey % 12 WHEN 0 THEN '47.041' WHEN 1 THEN '47.049' WHEN 2 THEN '47.050' "
        "WHEN 3 THEN '47.070' WHEN 4 THEN '47.074' WHEN 5 THEN '47.075' WHEN 6 THEN '47.076' "
        "WHEN 7 THEN '47.078' WHEN 8 THEN '47.079' WHEN 9 THEN '47.083' WHEN 10 THEN '47.084' "
        "ELSE '47.999' END END"
    ),
    "cfda_title": f"CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE 'Title ' || {text('l_orderkey % 12')} END",
    "action_date": "CAST(l_shipdate + INTERVAL '300' MONTH AS DATE)",
    "action_type_description": (
        "CASE l_linenumber WHEN 1 THEN 'NEW' WHEN 2 THEN 'CONTINUATION' ELSE 'REVISION' END"
    ),
    "federal_action_obligation": (
        "CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END"
    ),
    "total_obligated_amount": "o_totalprice",
    "total_outlayed_amount_for_overall_award": (
        "CASE WHEN l_orderkey % 4 = 0 THEN NULL "
        f"ELSE CAST({cents('o_totalprice * (l_orderkey % 120) / 100')} AS DOUBLE) END"
    ),
    "period_of_performance_start_date": "CAST(o_orderdate + INTERVAL '300' MONTH AS DATE)",
    "period_of_performance_current_end_date": (
        "CASE WHEN l_orderkey % 41 = 0 THEN NULL "
        "ELSE CAST(o_orderdate + INTERVAL '300' MONTH AS DATE) "
        "+ CAST(365 + o_orderkey % 1500 AS INT) END"
    ),
    "assistance_type_description": "'PROJECT GRANT ' || o_orderstatus",
    "transaction_description": f"'Action ' || {text('l_linenumber')} || ' for ' || o_orderpriority",
}

TERMINATIONS_WHERE = "o_orderkey % 7 = 3"
# These rows occur twice.
TERMINATIONS_COPIED = "o_orderkey % 91 = 3"
TERMINATIONS = {
    "grant_id": (
        f"CASE WHEN o_orderkey % 77 = 3 THEN 'X' || {text('o_orderkey')} "
        f"ELSE 'F' || {text('o_orderkey')} END"
    ),
    "project_title": (
        "CASE o_orderkey % 70 WHEN 3 THEN 'Climate resilience' "
        "WHEN 10 THEN 'Broadening participation' WHEN 17 THEN 'Teacher training' "
        "WHEN 24 THEN 'Cancer imaging' WHEN 31 THEN 'Civic networks' "
        "WHEN 38 THEN 'Quantum algorithms' WHEN 45 THEN 'Solar battery' "
        "WHEN 52 THEN 'Nano materials' WHEN 59 THEN 'Fossil birds' ELSE NULL END"
    ),
    "status": "CASE WHEN o_orderkey % 3 = 0 THEN 'Reinstated' ELSE 'Terminated' END",
    "termination_date": (
        "CASE WHEN o_orderkey % 101 = 0 THEN 'unknown' WHEN o_orderkey % 103 = 0 THEN '2025' "
        "WHEN o_orderkey % 107 = 0 THEN '2025-04' WHEN o_orderkey % 109 = 0 THEN '04/18/2025' "
        f"ELSE {text('DATE ' + chr(39) + '2025-04-18' + chr(39) + ' + CAST(o_orderkey % 300 AS INT)')} END"
    ),
    "reinstated": (
        "CASE o_orderkey % 6 WHEN 0 THEN 'true' WHEN 3 THEN 'TRUE' "
        "WHEN 1 THEN 'false' WHEN 4 THEN 'False' ELSE NULL END"
    ),
    "reinstatement_date": (
        "CASE WHEN o_orderkey % 3 = 0 THEN "
        + text(
            "DATE '2025-04-18' + CAST(o_orderkey % 300 + 13 + o_orderkey % 97 "
            "+ CASE WHEN o_orderkey % 131 = 0 THEN 400 ELSE 0 END AS INT)"
        )
        + " ELSE NULL END"
    ),
    "terminated": (
        "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'FALSE' ELSE 'true' END"
    ),
    "post_termination_deobligation": (
        "CASE WHEN o_orderkey % 43 = 0 THEN 'n/a' WHEN o_orderkey % 47 = 0 THEN '5d' "
        f"ELSE {text(cents('-o_totalprice / 4'))} END"
    ),
    "nsf_total_budget": text(cents("o_totalprice")),
    "estimated_remaining": text(cents("o_totalprice / 2")),
    "directorate": (
        "CASE WHEN o_orderkey % 5 = 0 THEN NULL "
        f"ELSE 'Directorate ' || {text('o_orderkey % 4')} END"
    ),
    "division": f"CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE 'Division ' || {text('o_orderkey % 9')} END",
    "nsf_program_name": (
        f"CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'Program ' || {text('o_orderkey % 37')} END"
    ),
    "abstract": (
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL "
        f"ELSE 'On \"grants\", part ' || {text('o_orderkey')} || chr(10) || 'Second line' END"
    ),
}

_SYNOPSIS = "CASE WHEN p_partkey % 23 = 0 THEN 'archived' ELSE 'Synopsis' END"
GRANTS_VARIANTS = [
    # (row filter, record type, days the update is later)
    ("p_partkey >= 0", _SYNOPSIS, 0),
    ("p_partkey % 5 = 0", "'forecast'", 100),
]


def grants_rules(record_type: str, days_later: int) -> dict[str, str]:
    return {
        "OpportunityID": text("p_partkey"),
        "OpportunityNumber": f"'26-' || {text('p_partkey')}",
        "OpportunityTitle": "p_name",
        "CFDANumbers": (
            "CASE p_partkey % 4 WHEN 0 THEN '47.041' WHEN 1 THEN '47.050,47.070' "
            "WHEN 2 THEN '10.001, 47.076' ELSE NULL END"
        ),
        "PostDate": text("DATE '2024-06-01' + CAST(p_partkey % 700 AS INT)"),
        "CloseDate": (
            "CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 29 = 0 THEN 'to be announced' "
            f"ELSE {text('DATE ' + chr(39) + '2025-06-01' + chr(39) + ' + CAST(p_partkey % 600 AS INT)')} END"
        ),
        "ArchiveDate": (
            "CASE WHEN p_partkey % 2 = 0 THEN NULL "
            f"ELSE {text('DATE ' + chr(39) + '2027-01-01' + chr(39) + ' + CAST(p_partkey % 90 AS INT)')} END"
        ),
        "EstimatedTotalProgramFunding": (
            f"CASE WHEN p_partkey % 31 = 0 THEN 'varies' ELSE {text(cents('p_retailprice * 1000'))} END"
        ),
        "AwardCeiling": text(cents("p_retailprice * 100")),
        "AwardFloor": f"CASE WHEN p_partkey % 37 = 0 THEN 'none' ELSE {text(cents('p_retailprice'))} END",
        "Description": "p_type || ', ' || p_brand",
        "AgencyName": (
            "CASE WHEN p_partkey % 20 = 3 THEN 'U.S. National Science Foundation' "
            "ELSE 'Department of Energy' END"
        ),
        "AgencyCode": "CASE WHEN p_partkey % 2 = 0 THEN 'NSF-BIO' ELSE 'DOE' END",
        "record_type": record_type,
        "LastUpdatedDate": f"DATE '2025-01-01' + CAST(p_size + {days_later} AS INT)",
    }


def scan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _apply(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(name) for name, e in rules.items()])


def usaspending(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders, customers = (scan(spark, sf_dir, t) for t in USASPENDING_FROM)
    # Orders get their customers first, so that the far more lines are shuffled once.
    owned = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return _apply(lines.join(owned, F.col("l_orderkey") == F.col("o_orderkey")), USASPENDING)


def terminations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(spark, sf_dir, "orders").filter(TERMINATIONS_WHERE)
    return _apply(rows.union(rows.filter(TERMINATIONS_COPIED)), TERMINATIONS)


def grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = scan(spark, sf_dir, "part")
    first, second = (
        _apply(parts.filter(where), grants_rules(kind, days))
        for where, kind, days in GRANTS_VARIANTS
    )
    return first.unionByName(second)


# The two pulls that the snapshot diff compares, as changes to opportunities.
OLD_SNAPSHOT = "CAST(opportunity_id AS BIGINT) % 11 <> 0"
NEW_SNAPSHOT = "CAST(opportunity_id AS BIGINT) % 13 <> 0"
NEW_TITLE = "CASE WHEN CAST(opportunity_id AS BIGINT) % 17 = 0 THEN upper(title) ELSE title END"
NEW_CLOSE_DATE = (
    "CASE WHEN CAST(opportunity_id AS BIGINT) % 19 = 0 THEN NULL ELSE close_date END"
)
NEW_FUNDING = (
    "CASE WHEN CAST(opportunity_id AS BIGINT) % 23 = 0 THEN estimated_total_funding + 5 "
    "ELSE estimated_total_funding END"
)


def old_snapshot(opportunities: DataFrame) -> DataFrame:
    return opportunities.filter(OLD_SNAPSHOT)


def new_snapshot(opportunities: DataFrame) -> DataFrame:
    return opportunities.filter(NEW_SNAPSHOT).withColumns(
        {
            "title": F.expr(NEW_TITLE),
            "close_date": F.expr(NEW_CLOSE_DATE),
            "estimated_total_funding": F.expr(NEW_FUNDING),
        }
    )


# Four pulls in a row, each (row filter, changed columns). Some opportunities vanish and return.
PULLS = [
    (OLD_SNAPSHOT, {}),
    (NEW_SNAPSHOT, {"title": NEW_TITLE, "close_date": NEW_CLOSE_DATE, "estimated_total_funding": NEW_FUNDING}),
    (f"{OLD_SNAPSHOT} AND CAST(opportunity_id AS BIGINT) % 7 <> 0", {"title": NEW_TITLE}),
    ("CAST(opportunity_id AS BIGINT) % 5 <> 0 OR CAST(opportunity_id AS BIGINT) % 13 = 0", {"close_date": NEW_CLOSE_DATE}),
]
# Pulls are numbered 10, 20, ...: ids say their order, not their distance.
PULL_IDS = [10 * (k + 1) for k in range(len(PULLS))]


def pulls(opportunities: DataFrame) -> DataFrame:
    """The rows of all four pulls, with their snapshot_id."""
    parts = [
        opportunities.filter(where).withColumns({n: F.expr(e) for n, e in rules.items()}).withColumn("snapshot_id", F.lit(k))
        for k, (where, rules) in zip(PULL_IDS, PULLS)
    ]
    return reduce(DataFrame.unionByName, parts)

"""Explicit schemas. Codes such as 47.050 are text and must never be inferred."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    """Schema from 'name type' pairs; works before a session exists."""
    pairs = [field.split() for field in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Raw feeds, in the column names they are published with.
USASPENDING = _struct(
    "assistance_transaction_unique_key string, assistance_award_unique_key string,"
    "award_id_fain string, recipient_uei string, recipient_name string,"
    "recipient_state_code string, recipient_city_name string,"
    "recipient_county_name string, recipient_zip_code string, cfda_number string,"
    "cfda_title string, action_date date, action_type_description string,"
    "federal_action_obligation double, total_obligated_amount double,"
    "total_outlayed_amount_for_overall_award double,"
    "period_of_performance_start_date date,"
    "period_of_performance_current_end_date date,"
    "assistance_type_description string, transaction_description string"
)

GRANTS = _struct(
    "OpportunityID string, OpportunityNumber string, OpportunityTitle string,"
    "CFDANumbers string, PostDate string, CloseDate string, ArchiveDate string,"
    "EstimatedTotalProgramFunding string, AwardCeiling string, AwardFloor string,"
    "Description string, AgencyName string, AgencyCode string, record_type string,"
    "LastUpdatedDate date"
)

TERMINATIONS = _struct(
    "grant_id string, project_title string, status string, termination_date string,"
    "reinstated string, reinstatement_date string, terminated string,"
    "post_termination_deobligation string, nsf_total_budget string,"
    "estimated_remaining string, directorate string, division string,"
    "nsf_program_name string, abstract string"
)

# Conformed tables.
AGENCIES_TABLE = _struct(
    "agency_id int, agency_code string, agency_name string, agency_level string,"
    "parent_agency_id int"
)

SNAPSHOTS_TABLE = _struct(
    "snapshot_id int, snapshot_date timestamp, source string, record_count bigint,"
    "notes string"
)

TOPICS_TABLE = _struct("position int, topic string")

GLOSSARY_TABLE = _struct("directorate string, directorate_name string")

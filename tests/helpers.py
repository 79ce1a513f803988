"""Small frames for tests: rows are dicts, missing fields are NULL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from grantlens.sources import schemas

RECIPIENTS = "recipient_uei string, recipient_name string, parent_uei string, state_code string, city_name string, county_name string, zip_code string"
AWARDS = "award_unique_key string, award_id_fain string, recipient_uei string, awarding_agency_id int, awarding_sub_agency_name string, cfda_number string, cfda_title string, total_obligated_amount double, total_outlayed_amount double, period_of_perf_start date, period_of_perf_end date, action_date date, description string, is_active boolean"
TRANSACTIONS = "transaction_unique_key string, award_unique_key string, award_id_fain string, recipient_uei string, cfda_number string, awarding_sub_agency_name string, action_date date, action_type_description string, federal_action_obligation double, assistance_type_description string, transaction_description string"
TERMINATIONS = "termination_id long, award_id_fain string, project_title string, current_status string, latest_termination_date date, reinstated boolean, reinstatement_date date, post_termination_deobligation double, nsf_total_budget double, estimated_remaining double, directorate string, division string, nsf_program_name string, abstract string, is_active boolean"
OPPORTUNITIES = "opportunity_id string, agency_id int, opportunity_number string, title string, cfda_numbers string, post_date date, close_date date, archive_date date, estimated_total_funding double, award_ceiling double, award_floor double, description string, is_active boolean, first_seen_snapshot_id int, last_seen_snapshot_id int"


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def frame(spark, schema, rows: list[dict]) -> DataFrame:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def recipients(spark, *rows):
    return frame(spark, RECIPIENTS, rows)


def awards(spark, *rows):
    return frame(spark, AWARDS, rows)


def transactions(spark, *rows):
    return frame(spark, TRANSACTIONS, rows)


def terminations(spark, *rows):
    numbered = [{"termination_id": i + 1, **r} for i, r in enumerate(rows)]
    return frame(spark, TERMINATIONS, numbered)


def opportunities(spark, *rows):
    return frame(spark, OPPORTUNITIES, rows)


def usaspending(spark, *rows):
    return frame(spark, schemas.USASPENDING, rows)


def column(df: DataFrame, name: str) -> list:
    return [r[name] for r in df.collect()]


def records(df: DataFrame, *names: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

"""Analytical views over the conformed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.config import DEFAULT_CONFIG, StudyConfig
from grantlens.functions import flags
from grantlens.functions.classify import directorate_of
from grantlens.functions.numbers import (
    count_where,
    money,
    percent_rounded,
    row_count,
    sum_or_zero,
    sum_where,
)
from grantlens.operators.joins import flag_list_overlap
from grantlens.operators.rows import in_any_window
from grantlens.plans.cube import actions


def rescinded_opportunities(
    change_log: DataFrame, opportunities: DataFrame, awards: DataFrame
) -> DataFrame:
    """Opportunities that left the listing, flagged when an award shares a code."""
    removed = change_log.filter(F.col("change_type") == "REMOVED").select(
        "change_id", "opportunity_id", F.col("detected_at").alias("removed_date")
    )
    described = removed.join(
        opportunities.select(
            "opportunity_id",
            "opportunity_number",
            "title",
            "estimated_total_funding",
            "cfda_numbers",
        ),
        "opportunity_id",
    )
    flagged = flag_list_overlap(
        described, "change_id", "cfda_numbers", awards, "cfda_number", "has_matching_award"
    )
    return flagged.select(
        "opportunity_id",
        "opportunity_number",
        "title",
        "estimated_total_funding",
        "cfda_numbers",
        "removed_date",
        "has_matching_award",
    )


def disruption_by_directorate(terminations: DataFrame, awards: DataFrame) -> DataFrame:
    """Terminations per directorate, unmatched ones included.

    Summed per FAIN and tracker directorate ahead of the join, so that the many
    rows without a FAIN, or with one FAIN, meet the awards as a few rows.
    """
    per_fain = terminations.groupBy("award_id_fain", "directorate").agg(
        row_count().alias("n"),
        F.sum("post_termination_deobligation").alias("deobligated"),
        F.sum("nsf_total_budget").alias("budget"),
        count_where(F.col("reinstated")).alias("reinstated"),
    )
    codes = awards.select("award_id_fain", "awarding_sub_agency_name")
    return (
        per_fain.join(codes, "award_id_fain", "left")
        .groupBy(F.coalesce("directorate", "awarding_sub_agency_name").alias("directorate"))
        .agg(
            F.sum("n").alias("n_terminated_awards"),
            money(F.abs(sum_or_zero("deobligated"))).alias("total_deobligated"),
            money(sum_or_zero("budget")).alias("total_at_risk_budget"),
            F.sum("reinstated").alias("n_reinstated"),
        )
        .orderBy(F.desc_nulls_last("total_deobligated"))
    )


def disruption_by_recipient(
    terminations: DataFrame, awards: DataFrame, recipients: DataFrame
) -> DataFrame:
    """Terminations per institution; rows without an award drop."""
    per_fain = (
        terminations.filter(F.col("award_id_fain").isNotNull())
        .groupBy("award_id_fain")
        .agg(row_count().alias("n"), F.sum("post_termination_deobligation").alias("deobligated"))
    )
    per_recipient = (
        per_fain.join(awards.select("award_id_fain", "recipient_uei"), "award_id_fain")
        .groupBy("recipient_uei")
        .agg(
            F.sum("n").alias("n_terminated_awards"),
            money(F.abs(sum_or_zero("deobligated"))).alias("total_deobligated"),
        )
    )
    return (
        recipients.select("recipient_uei", "recipient_name", "state_code")
        .join(per_recipient, "recipient_uei")
        .orderBy(F.desc_nulls_last("total_deobligated"))
    )


def awards_with_quality(awards: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG) -> DataFrame:
    """Awards plus outlay, period and reporting-lag flags."""
    return awards.withColumns(
        {
            "outlay_reporting_status": flags.outlay_status(F.col("total_outlayed_amount")),
            "pop_status": flags.period_status(
                F.col("period_of_perf_start"), F.col("period_of_perf_end"), cfg
            ),
            "action_in_reporting_lag_window": flags.in_reporting_lag(F.col("action_date"), cfg),
        }
    )


def disbursement_progress(awards: DataFrame) -> DataFrame:
    """Share of each award paid out, at most 100; a negative outlay stays negative."""
    obligated = F.col("total_obligated_amount")
    effective = F.least("total_outlayed_amount", "total_obligated_amount")
    return awards.filter(F.col("total_outlayed_amount").isNotNull() & (obligated > 0)).select(
        "award_unique_key",
        "award_id_fain",
        "awarding_sub_agency_name",
        "total_obligated_amount",
        effective.alias("effective_outlay"),
        F.least(F.lit(100.0), percent_rounded(effective, obligated, 1)).alias("pct_disbursed"),
    )


def active_funding(awards: DataFrame) -> DataFrame:
    """Portfolio in progress, per directorate."""
    return (
        awards.filter(F.col("is_active"))
        .groupBy(F.col("awarding_sub_agency_name").alias("directorate"))
        .agg(
            row_count().alias("n_active_awards"),
            money(F.sum("total_obligated_amount")).alias("total_obligated_active"),
            F.count("total_outlayed_amount").alias("n_with_outlay_reported"),
            money(F.sum("total_outlayed_amount")).alias("total_outlaid_reported"),
            percent_rounded(F.count("total_outlayed_amount"), row_count(), 1).alias(
                "pct_outlay_reported"
            ),
        )
        .orderBy(F.desc_nulls_last("total_obligated_active"))
    )


def currently_open_opportunities(
    opportunities: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Open opportunities; the first listing code gives the directorate."""
    is_open = flags.currently_open(
        F.col("is_active"), F.col("close_date"), F.col("post_date"), cfg
    )
    first_code = F.split_part("cfda_numbers", F.lit(","), F.lit(1))
    return opportunities.filter(is_open).select(
        "opportunity_id",
        "opportunity_number",
        "title",
        "cfda_numbers",
        directorate_of(first_code).alias("directorate"),
        "post_date",
        "close_date",
        "estimated_total_funding",
        "award_ceiling",
        "award_floor",
        "description",
    )


def new_awards_by_half(transactions: DataFrame, cfg: StudyConfig) -> DataFrame:
    """Counts and sums of NEW actions in both half-years, in one pass."""
    prior = flags.within(F.col("action_date"), cfg.prior_half)
    current = flags.within(F.col("action_date"), cfg.current_half)
    amount = F.col("federal_action_obligation")
    new = transactions.filter(F.col("action_type_description") == "NEW")
    return (
        in_any_window(new, "action_date", cfg.prior_half, cfg.current_half)
        .groupBy(F.col("awarding_sub_agency_name").alias("directorate"))
        .agg(
            actions(transactions, prior).alias("fy25_new_count"),
            money(sum_where(prior, amount)).alias("fy25_new_oblig"),
            actions(transactions, current).alias("fy26_new_count"),
            money(F.coalesce(sum_where(current, amount), F.lit(0))).alias("fy26_new_oblig"),
        )
    )


def directorate_resilience(
    transactions: DataFrame, opportunities: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG
) -> DataFrame:
    """NEW awards of two half-years and open opportunities, per directorate.

    Directorates without NEW awards in the prior half-year are left out.
    """
    halves = new_awards_by_half(transactions, cfg).filter(F.col("fy25_new_count") > 0)
    offered = (
        currently_open_opportunities(opportunities, cfg)
        .groupBy("directorate")
        .agg(row_count().alias("_n"), F.sum("estimated_total_funding").alias("_funding"))
    )
    return (
        halves.join(offered, "directorate", "left")
        .select(
            "directorate",
            F.coalesce("_n", F.lit(0)).alias("n_open_opportunities"),
            money(F.coalesce("_funding", F.lit(0))).alias("open_advertised_funding"),
            "fy25_new_count",
            "fy26_new_count",
            percent_rounded(F.col("fy26_new_count"), F.col("fy25_new_count"), 1).alias(
                "pct_count_retained"
            ),
            "fy25_new_oblig",
            "fy26_new_oblig",
            percent_rounded(F.col("fy26_new_oblig"), F.col("fy25_new_oblig"), 1).alias(
                "pct_dollar_retained"
            ),
        )
        .orderBy(F.desc_nulls_last("pct_dollar_retained"))
    )


def monthly_obligations(transactions: DataFrame) -> DataFrame:
    """Monthly totals per directorate; new money and clawbacks stay apart."""
    amount = F.col("federal_action_obligation")
    gained = F.when(amount >= 0, amount).otherwise(0)
    lost = F.when(amount < 0, amount).otherwise(0)
    return (
        transactions.filter(F.col("action_date").isNotNull())
        .groupBy(
            flags.month_of(F.col("action_date")).alias("month"),
            F.col("awarding_sub_agency_name").alias("directorate"),
        )
        .agg(
            actions(transactions).alias("n_transactions"),
            money(F.sum(amount)).alias("net_obligation"),
            money(F.sum(gained)).alias("gross_obligated"),
            money(F.abs(F.sum(lost))).alias("gross_deobligated"),
            actions(transactions, amount < 0).alias("n_deobligations"),
        )
        .orderBy("month", "directorate")
    )


def register_views(
    opportunities: DataFrame,
    awards: DataFrame,
    transactions: DataFrame,
    terminations: DataFrame,
    recipients: DataFrame,
    change_log: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> list[str]:
    """Create or replace the nine views as temporary views; returns their names."""
    frames = {
        "v_rescinded_opportunities": rescinded_opportunities(change_log, opportunities, awards),
        "v_disruption_by_directorate": disruption_by_directorate(terminations, awards),
        "v_disruption_by_recipient": disruption_by_recipient(terminations, awards, recipients),
        "v_awards_with_quality": awards_with_quality(awards, cfg),
        "v_disbursement_progress": disbursement_progress(awards),
        "v_active_funding": active_funding(awards),
        "v_currently_open_opportunities": currently_open_opportunities(opportunities, cfg),
        "v_directorate_resilience": directorate_resilience(transactions, opportunities, cfg),
        "v_monthly_obligations": monthly_obligations(transactions),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)

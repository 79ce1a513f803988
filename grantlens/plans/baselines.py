"""Baselines, exposure rates, untracked disruption and the lifecycle funnel."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.config import DEFAULT_CONFIG, StudyConfig
from grantlens.functions import flags
from grantlens.functions.numbers import (
    count_where,
    millions,
    money,
    percent_rounded,
    row_count,
)
from grantlens.operators.joins import keep_known, key_set
from grantlens.operators.rows import in_window
from grantlens.plans.dashboard import (
    academic_recipients,
    academic_transactions,
    academic_ueis,
    awards_at_risk,
    terminations_per_award,
)


def same_month_baseline(
    transactions: DataFrame, recipients: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Recent monthly totals against the same calendar month before the freeze.

    Totals are positive NEW obligations in $M; the spread is the sample standard
    deviation. Excluded (directorate, month) pairs leave the baseline only, and
    months after the freeze never enter it.
    """
    first = min(cfg.baseline[0], cfg.comparison[0])
    last = max(cfg.baseline[1], cfg.comparison[1])
    new_money = in_window(
        transactions.filter(
            (F.col("action_type_description") == "NEW")
            & (F.col("federal_action_obligation") > 0)
        ),
        "action_date",
        (first, last),
    )
    scoped = academic_transactions(
        new_money,
        recipients,
        {
            "directorate": F.col("awarding_sub_agency_name"),
            "month": flags.month_of(F.col("action_date")),
        },
        [F.sum("federal_action_obligation").alias("amount")],
        cfg,
    )
    excluded = F.lit(False)
    for directorate, month in cfg.baseline_exclusions:
        excluded = excluded | ((F.col("directorate") == directorate) & (F.col("month") == month))
    in_baseline = flags.within(F.col("month"), cfg.baseline) & ~F.coalesce(excluded, F.lit(False))
    in_comparison = flags.within(F.col("month"), cfg.comparison)
    monthly = scoped.groupBy("month").agg(
        millions(F.sum(F.when(in_baseline, F.col("amount")))).alias("baseline_m"),
        millions(F.sum(F.when(in_comparison, F.col("amount")))).alias("total_m"),
    )
    # One row per month from here on.
    usual = (
        monthly.filter(F.col("baseline_m").isNotNull())
        .groupBy(F.month("month").alias("calendar_month"))
        .agg(
            F.count("baseline_m").alias("n_baseline"),
            F.avg("baseline_m").alias("mean"),
            F.stddev_samp("baseline_m").alias("sd"),
        )
    )
    recent = monthly.filter(F.col("total_m").isNotNull()).select(
        "month", F.month("month").alias("calendar_month"), "total_m"
    )
    return (
        recent.join(usual, "calendar_month", "left")
        .select(
            "month",
            "total_m",
            "n_baseline",
            money(F.col("mean")).alias("baseline_mean_m"),
            money(F.col("sd")).alias("baseline_sd_m"),
            money(F.col("mean") - F.col("sd")).alias("lower_m"),
            money(F.col("mean") + F.col("sd")).alias("upper_m"),
            F.when(F.col("total_m") < F.col("mean") - F.col("sd"), "below")
            .when(F.col("total_m") > F.col("mean") + F.col("sd"), "above")
            .when(F.col("sd").isNotNull(), "within")
            .alias("position"),
        )
        .orderBy("month")
    )


def academic_awards(
    awards: DataFrame, recipients: DataFrame | None, cfg: StudyConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Awards of academic recipients; all awards where no recipients are given."""
    if recipients is None:
        return awards
    return awards.join(academic_ueis(recipients, cfg), "recipient_uei", "left_semi")


def untracked_disruption(
    transactions: DataFrame,
    awards: DataFrame,
    terminations: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
    recipients: DataFrame | None = None,
) -> DataFrame:
    """Awards that lost much money after the freeze but are not in the tracker.

    With `recipients`, only awards of the academic ones among them.
    """
    after = transactions.filter(F.col("action_date") > F.lit(cfg.freeze_date))
    if "fiscal_year" in transactions.columns:
        day_after = cfg.freeze_date + dt.timedelta(days=1)
        after = after.filter(
            F.col("fiscal_year") >= flags.fiscal_years_of((day_after, dt.date.max))[0]
        )
    lost = (
        after.groupBy("award_unique_key")
        .agg(F.sum(F.col("federal_action_obligation").cast("decimal(28,6)")).alias("net"))
        .filter(F.col("net") < cfg.untracked_threshold)
        .select("award_unique_key", money(F.col("net")).alias("net_after_freeze"))
    )
    described = academic_awards(awards, recipients, cfg).select(
        "award_unique_key",
        "award_id_fain",
        "recipient_uei",
        F.col("awarding_sub_agency_name").alias("directorate"),
    )
    return (
        described.join(lost, "award_unique_key")
        .join(key_set(terminations, "award_id_fain"), "award_id_fain", "left_anti")
        .select(
            "award_unique_key", "award_id_fain", "recipient_uei", "directorate", "net_after_freeze"
        )
    )


def state_exposure(
    awards: DataFrame,
    terminations: DataFrame,
    recipients: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Terminations per 100 academic awards live on the freeze date, by state."""
    per_recipient = (
        awards_at_risk(awards, cfg)
        .select("recipient_uei", "award_id_fain")
        .join(terminations_per_award(terminations), "award_id_fain", "left")
        .groupBy("recipient_uei")
        .agg(row_count().alias("n_awards"), F.sum("n_terms").alias("n_terms"))
    )
    return (
        academic_recipients(recipients, cfg)
        .select("recipient_uei", "state_code")
        .join(per_recipient, "recipient_uei")
        .groupBy("state_code")
        .agg(
            F.sum("n_awards").alias("n_awards"),
            F.coalesce(F.sum("n_terms"), F.lit(0)).alias("n_terms"),
        )
        .withColumn("term_pct", percent_rounded(F.col("n_terms"), F.col("n_awards"), 2))
        .orderBy("state_code")
    )


def lifecycle_funnel(
    opportunities: DataFrame,
    awards: DataFrame,
    terminations: DataFrame,
    untracked: DataFrame,
    recipients: DataFrame | None = None,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Counts along the life of a grant, plus the untracked segment.

    Terminations count for awards live on the freeze date only. With
    `recipients`, awards are those of the academic ones among them.
    """
    scope = academic_awards(awards, recipients, cfg)
    exposed = awards_at_risk(scope, cfg)
    tracked = keep_known(terminations, "award_id_fain", exposed, unique=True).agg(
        row_count().alias("n"), count_where(F.col("reinstated")).alias("back")
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit(4).alias("position"), F.lit("terminated").alias("stage"), "n"),
                F.struct(
                    F.lit(5).alias("position"),
                    F.lit("reinstated").alias("stage"),
                    F.col("back").alias("n"),
                ),
            )
        )
    )

    def stage(position: int, name: str, df: DataFrame) -> DataFrame:
        return df.agg(row_count().alias("n")).select(
            F.lit(position).alias("position"), F.lit(name).alias("stage"), "n"
        )

    obligated = scope.filter(F.col("total_obligated_amount") > 0)
    parts = [
        stage(1, "posted", opportunities),
        stage(2, "obligated", obligated),
        stage(3, "at risk", exposed),
        tracked,
        stage(6, "possibly untracked", untracked),
    ]
    return reduce(DataFrame.union, parts).orderBy("position")

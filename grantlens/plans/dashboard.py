"""Academic-sector analyses around the freeze date.

Everything here is limited to academic recipients. Facts are first summed per
recipient or per FAIN and only then joined with the academic scope: the joins
then move small partial sums, and a recipient with a large share of all rows
is reduced before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.config import DEFAULT_CONFIG, StudyConfig
from grantlens.functions import flags
from grantlens.functions.classify import topic_of
from grantlens.functions.numbers import (
    count_where,
    millions,
    money,
    percent,
    percent_rounded,
    round_half_up,
    row_count,
    sum_or_zero,
    sum_where,
)
from grantlens.functions.text import is_academic
from grantlens.operators.boxplot import box_stats, outliers
from grantlens.operators.joins import key_set
from grantlens.operators.quality import side_by_side, table_counts
from grantlens.operators.rows import in_any_window, in_window
from grantlens.plans.cube import actions
from grantlens.plans.silver import topic_order

NO_VALUE = "(none)"


def academic_recipients(recipients: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG) -> DataFrame:
    return recipients.filter(is_academic(F.col("recipient_name"), cfg.academic_keywords))


def academic_ueis(recipients: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG) -> DataFrame:
    return key_set(academic_recipients(recipients, cfg), "recipient_uei", unique=True)


def academic_fains(
    awards: DataFrame, recipients: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG
) -> DataFrame:
    """FAINs of awards to academic recipients."""
    held = awards.select("award_id_fain", "recipient_uei")
    return held.join(academic_ueis(recipients, cfg), "recipient_uei", "left_semi").select(
        "award_id_fain"
    )


def per_academic_fain(
    terminations: DataFrame,
    awards: DataFrame,
    recipients: DataFrame,
    keys: dict[str, Column],
    measures: list[Column],
    cfg: StudyConfig,
) -> DataFrame:
    """Termination measures per (FAIN, keys), academic FAINs only.

    FAINs are unique among awards, so the recipient comes from a 1:1 join.
    """
    partial = (
        terminations.filter(F.col("award_id_fain").isNotNull())
        .groupBy("award_id_fain", *[c.alias(n) for n, c in keys.items()])
        .agg(*measures)
    )
    owned = partial.join(awards.select("award_id_fain", "recipient_uei"), "award_id_fain")
    return owned.join(academic_ueis(recipients, cfg), "recipient_uei", "left_semi")


def academic_transactions(
    transactions: DataFrame,
    recipients: DataFrame,
    keys: dict[str, Column],
    measures: list[Column],
    cfg: StudyConfig,
) -> DataFrame:
    """Transaction measures per (recipient, keys), academic recipients only."""
    partial = transactions.groupBy(
        "recipient_uei", *[c.alias(n) for n, c in keys.items()]
    ).agg(*measures)
    return partial.join(academic_ueis(recipients, cfg), "recipient_uei", "left_semi")


def termination_totals(
    terminations: DataFrame,
    awards: DataFrame,
    recipients: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """One row: terminations, reinstated ones, dollars taken back."""
    measures = [
        row_count().alias("n"),
        count_where(F.col("reinstated")).alias("back"),
        F.sum("post_termination_deobligation").alias("amount"),
    ]
    scoped = per_academic_fain(terminations, awards, recipients, {}, measures, cfg)
    return scoped.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_terms"),
        F.sum("back").alias("n_reinst"),
        money(F.abs(sum_or_zero("amount"))).alias("deob"),
    )


def terminations_per_award(terminations: DataFrame) -> DataFrame:
    """Number of terminations per FAIN."""
    return (
        terminations.filter(F.col("award_id_fain").isNotNull())
        .groupBy("award_id_fain")
        .agg(row_count().alias("n_terms"))
    )


def awards_at_risk(awards: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG) -> DataFrame:
    """Awards whose period of performance spans the freeze date."""
    return awards.filter(
        flags.live_on(F.col("period_of_perf_start"), F.col("period_of_perf_end"), cfg.freeze_date)
    )


def funded_directorates(
    transactions: DataFrame, recipients: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Directorates with any NEW action of an academic recipient, whenever it was."""
    new = transactions.filter(F.col("action_type_description") == "NEW")
    key = {"dir": F.col("awarding_sub_agency_name")}
    return academic_transactions(new, recipients, key, [row_count().alias("n")], cfg).select("dir").distinct()


def pre_post_by_directorate(
    transactions: DataFrame,
    awards: DataFrame,
    terminations: DataFrame,
    recipients: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
    directorates: DataFrame | None = None,
) -> DataFrame:
    """Drop in NEW obligations, and share of at-risk awards terminated.

    `directorates` is funded_directorates, where it is stored: only the two
    half-years of the transactions are then read. Award keys and termination ids are unique, so their distinct counts are
    plain counts once terminations are counted per award.
    """
    amount = F.col("federal_action_obligation")
    day = F.col("action_date")
    new_actions = transactions.filter(F.col("action_type_description") == "NEW")
    if directorates is None:
        directorates = funded_directorates(transactions, recipients, cfg)
    halves = in_any_window(new_actions, "action_date", cfg.prior_half, cfg.current_half)
    new_money = academic_transactions(
        halves,
        recipients,
        {"dir": F.col("awarding_sub_agency_name")},
        [
            sum_where(flags.within(day, cfg.prior_half), amount).alias("prior"),
            sum_where(flags.within(day, cfg.current_half), amount).alias("current"),
        ],
        cfg,
    )
    pre = (
        new_money.select("dir", "prior", "current")
        .unionByName(directorates.select("dir"), allowMissingColumns=True)
        .groupBy("dir")
        .agg(money(F.sum("prior")).alias("prior"), money(sum_or_zero("current")).alias("current"))
        .filter(F.col("dir") != "OTHER")
        .select(
            "dir",
            round_half_up(
                100.0 * (1 - F.try_divide(F.col("current"), F.col("prior"))), 1
            ).alias("pre_drop_pct"),
            round_half_up(F.col("prior") / F.lit(1e6), 0).alias("fy25h1_m"),
        )
    )

    academic = academic_ueis(recipients, cfg)
    exposed = (
        awards_at_risk(awards, cfg)
        .select("recipient_uei", "award_id_fain", F.col("awarding_sub_agency_name").alias("dir"))
        .join(terminations_per_award(terminations), "award_id_fain", "left")
        .groupBy("recipient_uei", "dir")
        .agg(row_count().alias("n_awards"), F.sum("n_terms").alias("n_terms"))
        .join(academic, "recipient_uei", "left_semi")
    )
    post = exposed.groupBy("dir").agg(
        F.sum("n_awards").alias("n_awards"),
        F.coalesce(F.sum("n_terms"), F.lit(0)).alias("n_terms"),
    )
    return (
        pre.join(post, "dir", "left")
        .withColumn("post_term_pct", percent_rounded(F.col("n_terms"), F.col("n_awards"), 2))
        .orderBy(F.desc_nulls_last("pre_drop_pct"))
    )


def phase_timeline(
    transactions: DataFrame,
    terminations: DataFrame,
    awards: DataFrame,
    recipients: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Monthly NEW awards, clawbacks and terminations; gaps are zeros.

    The three series are stacked and summed per month: one pass over the
    transactions and no chain of outer joins.
    """
    amount = F.col("federal_action_obligation")
    is_new = F.coalesce(F.col("action_type_description") == "NEW", F.lit(False))
    lost = F.coalesce(amount < 0, F.lit(False))
    rows = in_window(transactions, "action_date", cfg.timeline).filter(is_new | lost)
    money_side = academic_transactions(
        rows,
        recipients,
        {"month": flags.month_of(F.col("action_date"))},
        [
            actions(transactions, is_new).alias("n_new"),
            sum_where(is_new & (amount > 0), amount).alias("new_amount"),
            sum_where(lost, amount).alias("clawback"),
        ],
        cfg,
    ).select("month", "n_new", "new_amount", "clawback", F.lit(0).cast("long").alias("n_terms"))

    term_side = per_academic_fain(
        in_window(terminations, "latest_termination_date", cfg.timeline),
        awards,
        recipients,
        {"month": flags.month_of(F.col("latest_termination_date"))},
        [row_count().alias("n_terms")],
        cfg,
    ).select(
        "month",
        F.lit(0).cast("long").alias("n_new"),
        *[F.lit(None).cast(money_side.schema[c].dataType).alias(c) for c in ("new_amount", "clawback")],
        "n_terms",
    )
    return (
        money_side.unionByName(term_side)
        .groupBy("month")
        .agg(
            F.sum("n_new").alias("n_new"),
            millions(sum_or_zero("new_amount")).alias("new_m"),
            millions(F.abs(sum_or_zero("clawback"))).alias("clawback_m"),
            F.sum("n_terms").alias("n_terms"),
        )
        .orderBy("month")
    )


def topic_recovery(
    terminations: DataFrame,
    awards: DataFrame,
    recipients: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Terminations and share reinstated per topic."""
    scoped = per_academic_fain(
        terminations,
        awards,
        recipients,
        {"topic": topic_of(F.col("project_title"))},
        [row_count().alias("n"), count_where(F.col("reinstated")).alias("back")],
        cfg,
    )
    return (
        scoped.groupBy("topic")
        .agg(F.sum("n").alias("n_terms"), F.sum("back").alias("n_reinst"))
        .withColumn("pct_reinst", percent_rounded(F.col("n_reinst"), F.col("n_terms"), 1))
        .orderBy(F.desc("n_terms"), "topic")
    )


def reinstatement_days(
    terminations: DataFrame,
    awards: DataFrame,
    recipients: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Days from termination to reinstatement, one row per reinstated tracker row."""
    back = terminations.filter(
        F.col("reinstated")
        & F.col("reinstatement_date").isNotNull()
        & F.col("latest_termination_date").isNotNull()
    ).select(
        "award_id_fain",
        F.datediff("reinstatement_date", "latest_termination_date").alias("days"),
        topic_of(F.col("project_title")).alias("topic"),
    )
    owned = back.join(awards.select("award_id_fain", "recipient_uei"), "award_id_fain")
    return owned.join(academic_ueis(recipients, cfg), "recipient_uei", "left_semi").select(
        "days", "topic"
    )


def reinstatement_boxplot(
    days: DataFrame, spark: SparkSession, cfg: StudyConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Five-number summary per topic, in display order."""
    stats = box_stats(days, "topic", "days", cfg.boxplot_min_group, cfg.whisker_factor)
    return (
        stats.join(F.broadcast(topic_order(spark)), "topic")
        .select(
            "position",
            "topic",
            "n",
            *[
                F.bround(F.col(c), 1).alias(c)
                for c in ["low", "q1", "median", "q3", "high"]
            ],
        )
        .orderBy("position")
    )


def reinstatement_outliers(days: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG) -> DataFrame:
    """Every value beyond its topic's fences.

    There are nine topics at most, so the fences go to the rows.
    """
    stats = box_stats(days, "topic", "days", cfg.boxplot_min_group, cfg.whisker_factor)
    return outliers(days, F.broadcast(stats), "topic", "days")


def top_programs(
    terminations: DataFrame,
    awards: DataFrame,
    recipients: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Programs with the most terminations; ties by directorate and program."""
    scoped = per_academic_fain(
        terminations.filter(F.col("nsf_program_name").isNotNull()),
        awards,
        recipients,
        {
            "directorate": F.coalesce("directorate", F.lit(NO_VALUE)),
            "program": F.col("nsf_program_name"),
        },
        [
            row_count().alias("n"),
            count_where(F.col("reinstated")).alias("back"),
            F.sum("post_termination_deobligation").alias("amount"),
        ],
        cfg,
    )
    return (
        scoped.groupBy("directorate", "program")
        .agg(
            F.sum("n").alias("terms"),
            F.sum("back").alias("reinst"),
            round_half_up(millions(F.abs(sum_or_zero("amount"))), 2).alias("deobl_m"),
        )
        .filter(F.col("terms") >= cfg.program_min_terminations)
        .orderBy(F.desc("terms"), "directorate", "program")
        .limit(cfg.program_top_k)
    )


def half_year_change(
    timeline: DataFrame, transactions: DataFrame, recipients: DataFrame, cfg: StudyConfig
) -> DataFrame:
    """NEW dollars of both half-years and their change in percent.

    The `series` columns add up the monthly timeline, which starts after the
    prior half-year does and so misses its first months. The `full` columns
    add up the transactions of both whole half-years.
    """
    month = F.col("month")

    def change(prior: Column, current: Column) -> Column:
        return F.when(prior > 0, percent(current - prior, prior))

    series = timeline.agg(
        money(sum_or_zero(F.when(flags.within(month, cfg.prior_half), F.col("new_m") * 1e6))).alias(
            "prior"
        ),
        money(
            sum_or_zero(F.when(flags.within(month, cfg.current_half), F.col("new_m") * 1e6))
        ).alias("current"),
    )
    amount = F.col("federal_action_obligation")
    new_money = transactions.filter((F.col("action_type_description") == "NEW") & (amount > 0))
    both = in_window(new_money, "action_date", (cfg.prior_half[0], cfg.current_half[1]))
    day = F.col("action_date")
    full = academic_transactions(
        both,
        recipients,
        {},
        [
            sum_where(flags.within(day, cfg.prior_half), amount).alias("prior"),
            sum_where(flags.within(day, cfg.current_half), amount).alias("current"),
        ],
        cfg,
    ).agg(
        money(sum_or_zero("prior")).alias("prior"), money(sum_or_zero("current")).alias("current")
    )
    stacked = series.withColumn("basis", F.lit("series")).unionByName(
        full.withColumn("basis", F.lit("full"))
    )
    return stacked.select(
        "basis", "prior", "current", change(F.col("prior"), F.col("current")).alias("change_pct")
    )


def headline_kpis(
    totals: DataFrame, halves: DataFrame, pre_post: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG
) -> DataFrame:
    """One row of headline figures.

    Inputs are results of termination_totals, half_year_change and
    pre_post_by_directorate, at most a dozen rows each; they are stacked and
    folded into one row.
    """

    def rows(df: DataFrame, **columns: Column) -> DataFrame:
        return df.select(*[c.cast("double").alias(n) for n, c in columns.items()])

    basis = F.col("basis")
    stacked = (
        rows(totals, terminated=F.col("n_terms"), reinstated=F.col("n_reinst"))
        .unionByName(
            rows(
                halves,
                change_series_pct=F.when(basis == "series", F.col("change_pct")),
                change_full_pct=F.when(basis == "full", F.col("change_pct")),
            ),
            allowMissingColumns=True,
        )
        .unionByName(
            rows(pre_post.filter(F.col("dir") == "EDU"), edu_post_pct=F.col("post_term_pct")),
            allowMissingColumns=True,
        )
    )
    folded = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    share = percent(F.col("reinstated"), F.col("terminated"))
    return folded.select(
        F.lit(cfg.freeze_date).alias("freeze_date"),
        F.col("terminated").cast("long").alias("n_terms"),
        F.col("reinstated").cast("long").alias("n_reinst"),
        share.alias("pct_reinst"),
        F.col("change_series_pct"),
        F.col("change_full_pct"),
        F.col("edu_post_pct"),
        F.concat(
            F.format_number(F.col("reinstated").cast("long"), 0),
            F.format_string(" reinstated (%.0f%%)", share),
        ).alias("reinstated_text"),
    )


def dataset_counts(
    transactions: DataFrame, awards: DataFrame, opportunities: DataFrame, terminations: DataFrame
) -> DataFrame:
    counts = table_counts(
        {
            "transactions": transactions,
            "awards": awards,
            "opportunities": opportunities,
            "terminations": terminations,
        }
    )
    return side_by_side(
        counts,
        {
            "transactions": "n_tx",
            "awards": "n_awards",
            "opportunities": "n_opps",
            "terminations": "n_terms",
        },
    )

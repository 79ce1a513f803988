"""Institution explorer, computed for every institution in one job.

An institution is a (canonical_name, state_code) group of recipients. The
`ueis` argument narrows a result to the given recipients.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlens.config import DEFAULT_CONFIG, StudyConfig
from grantlens.functions import flags
from grantlens.functions.numbers import (
    count_where,
    millions,
    money,
    percent,
    row_count,
    sum_or_zero,
)
from grantlens.functions.text import (
    UEI_SHAPE,
    canonical_name,
    display_name,
    institution_label,
    text_or_dash,
)
from grantlens.operators.joins import left_join_fanout
from grantlens.operators.rows import keep_one
from grantlens.plans.dashboard import academic_recipients, terminations_per_award

INSTITUTION = ["canonical_name", "state_code"]
UNKNOWN_STATE = "?"


def institution_members(recipients: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG) -> DataFrame:
    """Academic recipients with the institution they belong to."""
    named = academic_recipients(recipients, cfg).filter(F.trim("recipient_name") != "")
    return named.select(
        "recipient_uei",
        canonical_name(F.col("recipient_name"), cfg.strict_names).alias("canonical_name"),
        F.coalesce("state_code", F.lit(UNKNOWN_STATE)).alias("state_code"),
        display_name(F.col("recipient_name")).alias("display_name"),
    ).filter(F.col("canonical_name") != "")


def institutions_with_awards(
    recipients: DataFrame,
    awards: DataFrame,
    terminations: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """(institution, recipient_uei, display_name, n_terms): the members that hold awards, as rows.

    Awards are reduced to one row per recipient first.
    """
    per_recipient = (
        awards.select("award_id_fain", "recipient_uei")
        .join(terminations_per_award(terminations), "award_id_fain", "left")
        .groupBy("recipient_uei")
        .agg(F.coalesce(F.sum("n_terms"), F.lit(0)).alias("n_terms"))
    )
    return institution_members(recipients, cfg).join(per_recipient, "recipient_uei")


def institution_list(members: DataFrame) -> DataFrame:
    """One row of fixed width per institution of institutions_with_awards, with its label."""
    listed = members.groupBy(*INSTITUTION).agg(
        F.min("display_name").alias("display_name"),
        row_count().alias("n_variants"),
        F.sum("n_terms").alias("n_terminations"),
    )
    label = institution_label(F.col("display_name"), F.col("state_code"), F.col("n_terminations"))
    return listed.withColumn("label", label)


def with_ueis(listed: DataFrame, members: DataFrame) -> DataFrame:
    """Institutions with the ids of their members as one text each."""
    ids = F.array_join(F.sort_array(F.collect_list("recipient_uei")), ",").alias("ueis")
    mine = members.select(*INSTITUTION, "recipient_uei").join(listed.select(*INSTITUTION), INSTITUTION, "left_semi")
    return listed.join(mine.groupBy(*INSTITUTION).agg(ids), INSTITUTION)


def institution_choices(
    recipients: DataFrame,
    awards: DataFrame,
    terminations: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Institutions with at least one award: names, members, terminations.

    The member list is one text per institution because that is the result asked
    for. What is stored is institutions_with_awards, with a row per member.
    """
    members = institutions_with_awards(recipients, awards, terminations, cfg)
    return members.groupBy(*INSTITUTION).agg(
        F.min("display_name").alias("display_name"),
        F.array_join(F.sort_array(F.collect_list("recipient_uei")), ",").alias("ueis"),
        row_count().alias("n_variants"),
        F.sum("n_terms").alias("n_terminations"),
    )


GRAM = 3


def grams_of(text: str) -> list[str]:
    """The distinct runs of GRAM characters of a lower-cased text, in order."""
    low = text.lower()
    return list(dict.fromkeys(low[i : i + GRAM] for i in range(len(low) - GRAM + 1)))


def label_grams(listed: DataFrame) -> DataFrame:
    """Postings of the institution list: each row once for every run of GRAM characters of its label."""
    low = F.lower("label")
    places = F.sequence(F.lit(1), F.char_length(low) - GRAM + 1)
    grams = F.array_distinct(F.transform(places, lambda i: F.substring(low, i, GRAM)))
    return listed.filter(F.char_length(low) >= GRAM).select(F.explode(grams).alias("gram"), *listed.columns)


# Runs of the searched text whose postings are intersected; the label itself is checked for the rest.
ASKED_GRAMS = 3


def labels_with(listed: DataFrame, postings: DataFrame, text: str) -> DataFrame:
    """The institutions whose label contains the text in any case.

    Reads the postings of a few of the text's runs only; texts too short for a
    run are looked for in the list.
    """
    contains = F.lower("label").contains(text.lower())
    grams = grams_of(text)
    if not grams:
        return listed.filter(contains)
    step = max(1, (len(grams) - 1) // (ASKED_GRAMS - 1))
    some = list(dict.fromkeys([*grams[::step][: ASKED_GRAMS - 1], grams[-1]]))
    found = postings.filter(F.col("gram").isin(some) & contains)
    return found.groupBy(*listed.columns).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(some)).drop("_n")


def institution_states(choices: DataFrame) -> DataFrame:
    return choices.select("state_code").distinct().orderBy("state_code")


def institution_search(
    listed: DataFrame,
    members: DataFrame,
    postings: DataFrame,
    text: str = "",
    state: str | None = None,
    terminations_only: bool = False,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Type-ahead: the first institutions whose label contains the text, in the order of their names.

    listed, members and postings are institution_list, institutions_with_awards
    and label_grams. Ids are put together for the hits alone.
    """
    found = labels_with(listed, postings, text)
    if state and state != "ALL":
        found = found.filter(F.col("state_code") == state)
    if terminations_only:
        found = found.filter(F.col("n_terminations") > 0)
    hits = found.orderBy("display_name", *INSTITUTION).limit(cfg.search_limit)
    return with_ueis(hits, F.broadcast(hits).select(*INSTITUTION).join(members, INSTITUTION)).orderBy(
        "display_name", *INSTITUTION
    ).select("label", "ueis")


def valid_ueis(text: str) -> list[str]:
    """Split a comma-separated request; one malformed id voids all of it."""
    ids = text.removesuffix(",").split(",") if text else []
    return ids if all(re.fullmatch(UEI_SHAPE, i) for i in ids) else []


# Ids that a request may have as literals of a filter, which reaches the scan.
FILTER_IDS = 50


def awards_of(awards: DataFrame, ueis: str) -> DataFrame:
    """Awards of the recipients in a validated, comma-separated request.

    Longer lists become a table for a semi join; the rows are the same.
    """
    ids = valid_ueis(ueis)
    if len(ids) <= FILTER_IDS:
        return awards.filter(F.col("recipient_uei").isin(ids))
    asked = awards.sparkSession.createDataFrame([(i,) for i in sorted(set(ids))], "recipient_uei string")
    return awards.join(asked, "recipient_uei", "left_semi").select(*awards.columns)


def institution_portfolio(
    recipients: DataFrame,
    awards: DataFrame,
    terminations: DataFrame,
    cfg: StudyConfig = DEFAULT_CONFIG,
    ueis: str | None = None,
    latest_only: bool = False,
) -> DataFrame:
    """Award x termination rows of every institution.

    An award with several tracker rows appears once per row, and sums over the
    portfolio count it as often; latest_only=True keeps its latest termination.
    """
    held = awards if ueis is None else awards_of(awards, ueis)
    held = held.select(
        "recipient_uei",
        "award_id_fain",
        F.col("awarding_sub_agency_name").alias("dir"),
        "cfda_title",
        F.col("period_of_perf_start").alias("pop_start"),
        F.col("period_of_perf_end").alias("pop_end"),
        "action_date",
        F.col("total_obligated_amount").alias("obligated"),
    )
    tracked = terminations.select(
        "award_id_fain",
        "termination_id",
        "project_title",
        "division",
        "nsf_program_name",
        "reinstated",
        "post_termination_deobligation",
        F.col("latest_termination_date").alias("terminated_on"),
        F.col("reinstatement_date").alias("reinstated_on"),
        "abstract",
    )
    if latest_only:
        latest = [F.col("terminated_on").desc_nulls_last(), F.col("termination_id").asc()]
        tracked = keep_one(
            tracked.filter(F.col("award_id_fain").isNotNull()), ["award_id_fain"], latest
        )
    members = institution_members(recipients, cfg).drop("display_name")
    rows = left_join_fanout(held, tracked, "award_id_fain").join(members, "recipient_uei")
    return rows.select(
        *INSTITUTION,
        "recipient_uei",
        F.col("award_id_fain").alias("fain"),
        "project_title",
        "dir",
        "division",
        F.coalesce("nsf_program_name", "cfda_title", F.lit("(unknown)")).alias("program"),
        flags.award_status(F.col("termination_id"), F.col("reinstated")).alias("status"),
        "pop_start",
        "pop_end",
        "action_date",
        "obligated",
        F.abs(F.coalesce("post_termination_deobligation", F.lit(0))).alias("deobligated"),
        "terminated_on",
        "reinstated_on",
        "abstract",
        flags.live_on(F.col("pop_start"), F.col("pop_end"), cfg.freeze_date).alias("live_apr30"),
    )


def of_institution(rows: DataFrame, name: str, state: str) -> DataFrame:
    """One institution's rows of any of the results below."""
    return rows.filter((F.col("canonical_name") == name) & (F.col("state_code") == state))


def in_display_order(portfolio: DataFrame) -> DataFrame:
    """By institution: terminated, reinstated, active; larger awards first.

    A sort of all rows given. What is shown is one institution's (of_institution).
    """
    return portfolio.orderBy(
        *INSTITUTION, flags.status_rank(F.col("status")), F.desc_nulls_last("obligated"), "fain"
    )


def largest_loss_first(terminations: DataFrame) -> DataFrame:
    """Order of institution_terminations, for the rows of one institution."""
    return terminations.orderBy(F.desc("deobligated_k"), "fain")


def largest_amount_first(funding: DataFrame) -> DataFrame:
    """Order of funding_by_directorate, for the rows of one institution."""
    return funding.orderBy(F.desc_nulls_last("amt_m"), "dir")


def is_terminated() -> Column:
    return F.col("status").isin("Terminated", "Reinstated")


def institution_summary(portfolio: DataFrame) -> DataFrame:
    """Counts, sums and most affected directorate per institution.

    Rows are summed per directorate first; the second step sees about a dozen
    rows per institution. Ties for the most affected directorate go by name.
    """
    cut = is_terminated()
    running = F.col("status").isin("Active", "Reinstated")
    live = F.coalesce(F.col("live_apr30"), F.lit(False))
    obligated = F.col("obligated")
    per_directorate = portfolio.groupBy(*INSTITUTION, "dir").agg(
        row_count().alias("n_total"),
        F.sum(F.when(running, obligated)).alias("active_funding"),
        count_where(running).alias("n_active"),
        count_where(live).alias("n_at_risk"),
        count_where(live & cut).alias("n_term_at_risk"),
        F.sum(F.when(live, obligated)).alias("at_risk_oblig"),
        F.max("action_date").alias("latest_action"),
        count_where(cut).alias("n_term"),
        count_where(F.col("status") == "Reinstated").alias("n_reinst"),
        F.sum(F.when(cut, obligated)).alias("term_funding"),
        F.sum("deobligated").alias("net_deob"),
    )
    hit = (F.col("n_term") > 0) & F.col("dir").isNotNull()
    most = F.min(F.when(hit, F.struct((-F.col("n_term")).alias("rank"), F.col("dir"))))

    def total(name: str) -> Column:
        return F.sum(name).alias(name)

    def dollars(name: str) -> Column:
        return money(sum_or_zero(name)).alias(name)

    summed = per_directorate.groupBy(*INSTITUTION).agg(
        total("n_total"),
        dollars("active_funding"),
        total("n_active"),
        total("n_at_risk"),
        total("n_term_at_risk"),
        dollars("at_risk_oblig"),
        F.max("latest_action").alias("latest_action"),
        total("n_term"),
        total("n_reinst"),
        dollars("term_funding"),
        dollars("net_deob"),
        most.alias("_most"),
    )
    return summed.select(
        "*",
        F.coalesce(percent(F.col("n_term_at_risk"), F.col("n_at_risk")), F.lit(0.0)).alias(
            "pct_term"
        ),
        F.coalesce("_most.dir", F.lit("None")).alias("most_dir"),
        F.coalesce(-F.col("_most.rank"), F.lit(0)).alias("most_dir_n"),
    ).drop("_most")


def summary_text(summary: DataFrame) -> DataFrame:
    """The sentence shown next to an institution's figures."""
    sentence = F.concat(
        F.format_number("n_term", 0),
        F.format_string(
            " awards (%.1f%% of awards live on the freeze date) have been terminated, "
            "concentrated in %s.",
            F.col("pct_term"),
            F.col("most_dir"),
        ),
    )
    return summary.select(
        *INSTITUTION,
        F.when(F.col("n_term") == 0, "No terminations recorded for this institution.")
        .otherwise(sentence)
        .alias("summary_text"),
    )


def funding_by_directorate(portfolio: DataFrame) -> DataFrame:
    """Active funding in $M per institution and directorate, in no order: the reader sorts what it shows."""
    return (
        portfolio.filter(F.col("status").isin("Active", "Reinstated") & F.col("dir").isNotNull())
        .groupBy(*INSTITUTION, "dir")
        .agg(F.sum("obligated").alias("amount"), row_count().alias("n"))
        .select(*INSTITUTION, "dir", F.bround(millions(F.col("amount")), 2).alias("amt_m"), "n")
    )


def institution_terminations(portfolio: DataFrame) -> DataFrame:
    """Terminated and reinstated awards with amounts in $K, in no order: the reader sorts what it shows."""
    return (
        portfolio.filter(is_terminated())
        .select(
            *INSTITUTION,
            "fain",
            text_or_dash(F.col("project_title")).alias("project"),
            F.col("dir").alias("directorate"),
            text_or_dash(F.col("division")).alias("division"),
            "program",
            "status",
            F.bround(F.col("obligated") / 1000, 0).alias("obligated_k"),
            F.bround(F.col("deobligated") / 1000, 0).alias("deobligated_k"),
            F.date_format("terminated_on", "yyyy-MM-dd").alias("terminated"),
            text_or_dash(F.date_format("reinstated_on", "yyyy-MM-dd")).alias("reinstated"),
            "abstract",
        )
    )


def largest_termination(portfolio: DataFrame) -> DataFrame:
    """Per institution, the terminated award with the largest obligation."""
    lost = portfolio.filter(is_terminated() & F.col("obligated").isNotNull())
    top = keep_one(
        lost.select(*INSTITUTION, "program", "obligated", "fain"),
        INSTITUTION,
        [F.col("obligated").desc(), F.col("fain").asc(), F.col("program").asc()],
    )
    return top.select(
        *INSTITUTION,
        "program",
        "obligated",
        F.format_string(
            "Largest single termination: %s ($%.2fM obligated).",
            F.col("program"),
            F.col("obligated") / F.lit(1e6),
        ).alias("text"),
    )

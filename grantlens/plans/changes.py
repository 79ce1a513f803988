"""Opportunity snapshots: register of pulls and field-level differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantlens.config import DEFAULT_CONFIG, StudyConfig
from grantlens.functions.numbers import row_count
from grantlens.operators.rows import with_surrogate_key
from grantlens.plans.silver import load_time

ADDED, REMOVED, MODIFIED = "ADDED", "REMOVED", "MODIFIED"

TRACKED_FIELDS = [
    "opportunity_number",
    "title",
    "cfda_numbers",
    "post_date",
    "close_date",
    "archive_date",
    "estimated_total_funding",
    "award_ceiling",
    "award_floor",
    "description",
    "is_active",
]


def _as_text(value: Column, kind: T.DataType) -> Column:
    """Amounts with cents if that is all they have, in full otherwise."""
    if not isinstance(kind, T.DoubleType):
        return value.cast("string")
    cents = value.try_cast("decimal(38,2)")
    return F.when(cents.cast("double") == value, cents.cast("string")).otherwise(value.cast("string"))


CHANGE = ["change_type", "field_changed", "old_value", "new_value"]


def _change(kind: str, field: str | None = None, before: Column | None = None, after: Column | None = None) -> Column:
    values = [F.lit(kind), F.lit(field), before, after]
    none = F.lit(None).cast("string")
    return F.struct(*[(none if v is None else v.cast("string")).alias(n) for n, v in zip(CHANGE, values)])


def _edits(before: str, after: str, schema: T.StructType) -> Column:
    """Changes of single fields between two structs of the tracked ones.

    Values are compared as they are; only the reported ones are text. NULL
    against NULL is no change, NULL against a value is one.
    """

    def text(side: str, field: str) -> Column:
        return _as_text(F.col(f"{side}.{field}"), schema[field].dataType)

    changed = [
        F.when(
            ~F.col(f"{before}.{f}").eqNullSafe(F.col(f"{after}.{f}")),
            _change(MODIFIED, f, text(before, f), text(after, f)),
        )
        for f in TRACKED_FIELDS
    ]
    return F.array_compact(F.array(*changed))


def diff_snapshots(
    old: DataFrame,
    new: DataFrame,
    snapshot_id: int,
    cfg: StudyConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Changes from one de-duplicated snapshot to the next.

    One row per added or removed opportunity and one per changed field.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("opportunity_id", F.struct(*TRACKED_FIELDS).alias(name))

    both = side(old, "_old").join(side(new, "_new"), "opportunity_id", "full_outer")
    changes = (
        F.when(F.col("_old").isNull(), F.array(_change(ADDED)))
        .when(F.col("_new").isNull(), F.array(_change(REMOVED)))
        .otherwise(_edits("_old", "_new", old.schema))
    )
    found = both.select("opportunity_id", F.inline(changes))
    return _dated(found.withColumn("snapshot_id", F.lit(snapshot_id)), cfg)


def _dated(changes: DataFrame, cfg: StudyConfig) -> DataFrame:
    return changes.select(
        "opportunity_id", "snapshot_id", load_time(cfg).alias("snapshot_date"), *CHANGE, load_time(cfg).alias("detected_at")
    )


def pull_positions(register: DataFrame) -> DataFrame:
    """(snapshot_id, position, last): pulls numbered in order of their ids. One row per pull."""
    ids = register.select("snapshot_id").distinct()
    position = F.row_number().over(W.orderBy("snapshot_id"))
    return ids.select("snapshot_id", position.alias("position"), F.count(F.lit(1)).over(W.partitionBy()).alias("last"))


def _in_sequence(pulls: DataFrame, positions: DataFrame) -> DataFrame:
    """Each opportunity's rows in order of the pulls, with the positions of the rows before and after."""
    rows = pulls.join(F.broadcast(positions), "snapshot_id")
    order = W.partitionBy("opportunity_id").orderBy("position")
    return rows.select(
        "opportunity_id",
        "snapshot_id",
        "position",
        "last",
        F.struct(*TRACKED_FIELDS).alias("_new"),
        F.lag(F.struct(*TRACKED_FIELDS)).over(order).alias("_old"),
        F.lag("position").over(order).alias("_before"),
        F.lead("position").over(order).alias("_after"),
    )


def chain_changes(
    pulls: DataFrame, register: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Changes between any number of pulls, each against the one before, in one pass.

    pulls holds the de-duplicated rows of all pulls with their snapshot_id; the
    register names the pulls, those without rows too. The first pull is where
    the comparison starts. An opportunity that is missing for some pulls is
    REMOVED with the first of them and ADDED when it returns.
    """
    positions = pull_positions(register)
    rows = _in_sequence(pulls, positions)
    begins = F.col("_before").isNull() | (F.col("_before") < F.col("position") - 1)
    here = (
        F.when(begins, F.when(F.col("position") > 1, F.array(_change(ADDED))))
        .otherwise(_edits("_old", "_new", pulls.schema))
    )
    ends = (F.col("position") < F.col("last")) & (F.col("_after").isNull() | (F.col("_after") > F.col("position") + 1))
    made = rows.select("opportunity_id", F.col("position").alias("at"), F.inline(here)).unionByName(
        rows.filter(ends).select("opportunity_id", (F.col("position") + 1).alias("at"), F.inline(F.array(_change(REMOVED))))
    )
    named = F.broadcast(positions.select(F.col("position").alias("at"), "snapshot_id"))
    return _dated(made.join(named, "at"), cfg)


def seen_snapshots(pulls: DataFrame, register: DataFrame) -> DataFrame:
    """(opportunity_id, first_seen_snapshot_id, last_seen_snapshot_id, n_pulls, n_stays) of each opportunity.

    A stay is a run of pulls in a row that hold it.
    """
    rows = _in_sequence(pulls, pull_positions(register))
    begins = F.col("_before").isNull() | (F.col("_before") < F.col("position") - 1)
    return rows.groupBy("opportunity_id").agg(
        F.min("snapshot_id").alias("first_seen_snapshot_id"),
        F.max("snapshot_id").alias("last_seen_snapshot_id"),
        row_count().alias("n_pulls"),
        F.count_if(begins).alias("n_stays"),
    )


def with_seen_snapshots(opportunities: DataFrame, seen: DataFrame) -> DataFrame:
    """Opportunities with the pulls that held them first and last, instead of NULL."""
    found = seen.select("opportunity_id", "first_seen_snapshot_id", "last_seen_snapshot_id")
    names = found.columns[1:]
    joined = opportunities.drop(*names).join(found, "opportunity_id", "left")
    return joined.select(*opportunities.columns)


def change_log(differences: DataFrame) -> DataFrame:
    """Differences with their row number as change_id."""
    return with_surrogate_key(differences, "change_id")


def snapshot_entry(
    snapshot: DataFrame,
    snapshot_id: int,
    notes: str | None = None,
    cfg: StudyConfig = DEFAULT_CONFIG,
    source: str = "grants.gov",
) -> DataFrame:
    """The register row of one pull."""
    return snapshot.agg(row_count().alias("record_count")).select(
        F.lit(snapshot_id).alias("snapshot_id"),
        load_time(cfg).alias("snapshot_date"),
        F.lit(source).alias("source"),
        "record_count",
        F.lit(notes).cast("string").alias("notes"),
    )

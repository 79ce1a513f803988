"""Monthly cube: transactions added up by recipient, month, directorate, kind of action and sign.

The cube has the columns of the transactions that monthly analyses read. Each of
its rows stands for many transactions: action_date is the first of their month,
federal_action_obligation their sum, n_actions their number. Amounts of unlike
sign never meet in a row, so new money and clawbacks can still be told apart.
Plans that add up whole months give the same results on either table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlens.functions import flags
from grantlens.functions.numbers import count_where, row_count
from grantlens.operators.rows import ACTIONS


def monthly_cube(transactions: DataFrame) -> DataFrame:
    """Undated transactions have a month of their own, NULL amounts a sign of their own."""
    amount = F.col("federal_action_obligation")
    return (
        transactions.groupBy(
            "recipient_uei",
            "awarding_sub_agency_name",
            "action_type_description",
            flags.month_of(F.col("action_date")).alias("action_date"),
            F.signum(amount).alias("_sign"),
        )
        .agg(row_count().alias(ACTIONS), F.sum(amount).alias("federal_action_obligation"))
        .drop("_sign")
    )


def actions(df: DataFrame, condition: Column | None = None) -> Column:
    """Number of transactions, of those that meet a condition if given, in transactions or in a cube."""
    if ACTIONS not in df.columns:
        return row_count() if condition is None else count_where(condition)
    counted = F.col(ACTIONS) if condition is None else F.when(condition, F.col(ACTIONS))
    return F.coalesce(F.sum(counted), F.lit(0))

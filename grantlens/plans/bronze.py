"""Raw feeds with their activity flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.config import DEFAULT_CONFIG, StudyConfig
from grantlens.functions import flags
from grantlens.sources import schemas
from grantlens.sources.readers import CheckedScan, read_csv_files


def usaspending(raw: DataFrame, cfg: StudyConfig = DEFAULT_CONFIG) -> DataFrame:
    """Award transactions of all fiscal years; active while the period runs."""
    end = F.col("period_of_performance_current_end_date")
    return raw.withColumn("is_active", flags.period_active(end, cfg.as_of))


def grants(raw: DataFrame) -> DataFrame:
    """Funding opportunities of the agency only."""
    in_scope = flags.in_agency_scope(F.col("AgencyName"), F.col("AgencyCode"), F.col("CFDANumbers"))
    return raw.filter(in_scope).withColumn(
        "is_active", flags.opportunity_active(F.col("record_type"))
    )


def terminations(raw: DataFrame) -> DataFrame:
    """All tracker rows."""
    return raw.withColumn(
        "is_active", flags.termination_active(F.col("reinstated"), F.col("terminated"))
    )


def scan_usaspending(
    spark: SparkSession, paths: list[str], multi_line: bool = False
) -> CheckedScan:
    """Folders or files, each file with its own column order; large files are split."""
    return read_csv_files(spark, paths, schemas.USASPENDING, multi_line)


def scan_grants(spark: SparkSession, path: str, multi_line: bool = True) -> CheckedScan:
    return read_csv_files(spark, path, schemas.GRANTS, multi_line)


def scan_terminations(spark: SparkSession, path: str, multi_line: bool = True) -> CheckedScan:
    return read_csv_files(spark, path, schemas.TERMINATIONS, multi_line)

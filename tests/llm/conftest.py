from __future__ import annotations

import pytest


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """The tables are small and the jobs many."""
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")

"""Small constant tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Region -> (state, communities).
REGIONS = {
    "Pacific Northwest": ("OR", ("C001", "C002", "C003", "C004")),
    "Southwest": ("AZ", ("C005", "C006", "C007", "C008")),
    "South": ("TX", ("C009", "C010", "C011", "C012", "C013", "C014")),
}


def dim_community_region(spark: SparkSession) -> DataFrame:
    """``(community_id, state, region)`` of the mapped communities; unlisted communities have no region."""
    rows = [(c, state, region) for region, (state, communities) in REGIONS.items() for c in communities]
    return spark.createDataFrame(rows, "community_id string, state string, region string")

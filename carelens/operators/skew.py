"""Finding keys that hold too many rows for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more rows than this is split before its rows are sorted for a window.
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys: list[str], threshold: int = HOT_ROWS) -> DataFrame:
    """The keys with more than ``threshold`` rows, one row each.

    Counting is combined before the shuffle, so a hot key costs one row per input task. At most
    ``rows / threshold`` keys come back.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > threshold).select(*keys)

"""Previous and next row of the same key, safe when one key holds a large share of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelens.operators.keys import slot, slot_part
from carelens.operators.skew import HOT_ROWS, hot_keys
from carelens.session import materialise


def with_neighbour(
    df: DataFrame,
    keys: list[str],
    at: str,
    columns: list[str],
    into: str,
    direction: str = "next",
    ties: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add struct column ``into`` with ``columns`` of the next or previous row of the same key.

    Rows are ordered by ``at`` (NULLs last), then by ``ties``. ``into`` is NULL where there is no such row. NULL is a key like
    any other.

    An ordinary key is one window group. Rows of keys with more than ``hot_rows`` rows are dealt by ranges of the whole order
    instead, whatever makes them many: a key without a value, a single day, rows without a date. Neighbours are then found
    within each range, and the first or last row of a range in the range beside it: one row per range.
    """
    if direction not in ("next", "previous"):
        raise ValueError(f"direction must be 'next' or 'previous', got {direction!r}")
    ties = ties or []
    order = [F.col(at).asc_nulls_last(), *[F.col(c).asc_nulls_first() for c in ties]]
    step = F.lead if direction == "next" else F.lag

    def one_group_per_key(rows: DataFrame) -> DataFrame:
        return rows.withColumn(into, step(F.struct(*columns)).over(W.partitionBy(*keys).orderBy(*order)))

    hot = materialise(hot_keys(df, keys, hot_rows), "hot_keys")
    if not hot.limit(1).count():
        return one_group_per_key(df)
    hot = hot.toDF(*[f"_hot_{k}" for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    ranged = _by_ranges(df.join(hot, same, "left_semi"), keys, order, columns, into, direction)
    return one_group_per_key(df.join(hot, same, "left_anti")).unionByName(ranged)


def _by_ranges(df: DataFrame, keys: list[str], order: list[Column], columns: list[str], into: str, direction: str) -> DataFrame:
    """The same over ranges of (keys, order); rows that are equal in these are told apart by their content."""
    step, edge = (F.lead, F.min_by) if direction == "next" else (F.lag, F.max_by)
    whole_order = [*[F.col(k).asc_nulls_first() for k in keys], *order, F.xxhash64(*df.columns).asc()]
    placed = slot(df, whole_order, "ranges").withColumn("_part", slot_part())
    seen = F.struct(F.struct(*keys).alias("key"), F.struct(*columns).alias("row"))
    inside = placed.withColumn("_inside", step(seen).over(W.partitionBy("_part").orderBy("_slot")))
    # one row per range
    edges = placed.groupBy("_part").agg(edge(seen, "_slot").alias("_edge"))
    edges = edges.select("_part", step("_edge").over(W.orderBy("_part")).alias("_across"))
    found = F.coalesce("_inside", "_across")
    own = F.struct(*keys)
    return inside.join(edges, "_part", "left").withColumn(into, F.when(found["key"].eqNullSafe(own), found["row"])).select(*df.columns, into)

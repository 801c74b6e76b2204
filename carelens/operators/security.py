"""Row-level security."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Principal:
    role: str
    region: str | None = None
    community_id: str | None = None


# Roles.
CORPORATE = "corporate_admin"
REGIONAL = "regional_director"
EXECUTIVE = "executive_director"


def resolve_principal(access_key: str | None, directory: dict[str, Principal]) -> Principal:
    """The principal of an access key in the caller's directory; a missing or unknown key is refused."""
    if not access_key:
        raise PermissionError("missing access key")
    if access_key not in directory:
        raise PermissionError("invalid access key")
    return directory[access_key]


def apply_row_security(
    df: DataFrame,
    principal: Principal,
    regions: DataFrame,
    key: str = "community_id",
    region: str = "region",
) -> DataFrame:
    """Keep the rows a principal may see.

    Corporate sees all rows, a regional director those of the region's keys (a semi join, so a key listed
    twice does not repeat rows), an executive director one key. Any other role is refused.
    """
    if principal.role == CORPORATE:
        return df
    if principal.role == REGIONAL:
        scope = regions.filter(F.col(region) == principal.region).select(key)
        return df.join(scope, key, "left_semi")
    if principal.role == EXECUTIVE:
        return df.filter(F.col(key) == principal.community_id)
    raise PermissionError(f"unknown role {principal.role!r}")


def entitlements(principals: DataFrame, communities: DataFrame, regions: DataFrame) -> DataFrame:
    """``(principal, community_id)`` pairs for a table of principals (principal, role, region, community_id).

    Corporate principals get one row with a NULL community, which stands for "all", instead of a product of
    principals and communities.
    """
    corporate = principals.filter(F.col("role") == CORPORATE).select(
        "principal", F.lit(None).cast("string").alias("community_id")
    )
    regional = (
        principals.filter(F.col("role") == REGIONAL)
        .select("principal", "region")
        .join(regions.select("community_id", "region"), "region")
        .select("principal", "community_id")
    )
    executive = (
        principals.filter(F.col("role") == EXECUTIVE)
        .select("principal", "community_id")
        .join(communities.select("community_id"), "community_id", "left_semi")
        .select("principal", "community_id")
    )
    return corporate.unionByName(regional).unionByName(executive).distinct()


def rows_by_principal(df: DataFrame, granted: DataFrame, key: str = "community_id") -> DataFrame:
    """Every row once for each principal that may see it, with ``principal``, in one scan of ``df``.

    Grants are gathered per key, so the join meets one row per key; those for "all" are one list for the whole table.
    """
    everywhere = granted.filter(F.col(key).isNull()).agg(F.collect_set("principal")).scalar()
    listed = granted.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.collect_set("principal").alias("_seen_by"))
    none = F.array().cast("array<string>")
    seen_by = F.array_union(F.coalesce("_seen_by", none), F.coalesce(everywhere, none))
    return df.join(listed, F.col(key) == F.col("_key"), "left").select(*df.columns, F.explode(seen_by).alias("principal"))


def rows_for(df: DataFrame, granted: DataFrame, principal: str, key: str = "community_id") -> DataFrame:
    """Rows one principal may see, looked up in an entitlement table."""
    return rows_by_principal(df, granted.filter(F.col("principal") == principal), key).drop("principal")

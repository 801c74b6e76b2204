"""Text cleaning and canonical spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical care level -> accepted spellings (compared after trim + upper case).
CARE_LEVELS = {
    "Independent Living": ("IL", "INDEPENDENT", "INDEPENDENT LIVING"),
    "Assisted Living": ("AL", "ASSISTED", "ASSISTED LIVING"),
    "Memory Care": ("MC", "MEMORY", "MEMORY CARE"),
}

# Role names as they are spelled inside the pay-rate dictionary.
ROLES = ("Med Tech", "Maintenance", "Caregiver", "Dining", "Admin", "RN", "LPN")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c) -> Column:
    """Strip leading and trailing spaces (spaces only; tabs are content)."""
    return F.trim(_col(c))


def clean_upper(c) -> Column:
    return F.upper(clean(c))


def has_text(c) -> Column:
    """True when the value is neither NULL nor blank; never NULL."""
    return F.coalesce(clean(c) != "", F.lit(False))


def present_flag(c) -> Column:
    """1 when the value is present, else 0."""
    return _col(c).isNotNull().cast("int")


def same_text(c, value: str) -> Column:
    """Case-insensitive equality with a literal."""
    return F.upper(_col(c)) == value.upper()


def canonical(c, spellings: dict[str, tuple[str, ...]], otherwise: Column | None = None) -> Column:
    """Map accepted spellings to their canonical name; anything else becomes ``otherwise``."""
    key = clean_upper(c)
    expr = None
    for name, accepted in spellings.items():
        expr = (F if expr is None else expr).when(key.isin(*accepted), F.lit(name))
    return expr.otherwise(otherwise) if otherwise is not None else expr


def care_level(c) -> Column:
    """Canonical care level; unknown levels are kept, trimmed."""
    return canonical(c, CARE_LEVELS, clean(c))


def role_name(c) -> Column:
    """Role as spelled in the pay-rate dictionary, or NULL for a role it does not list."""
    return canonical(c, {role: (role.upper(),) for role in ROLES})

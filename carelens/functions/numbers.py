"""Numeric casts, ratios and rounding."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decimal_number(c) -> Column:
    """Strict cast of text to DOUBLE; unreadable text fails the job under ANSI mode."""
    return F.trim(_col(c)).cast("double")


def whole_number(c) -> Column:
    """Strict cast of text to INT, rounding halves away from zero (``'4.5'`` -> 5)."""
    return F.round(decimal_number(c)).cast("int")


def lenient_decimal(c) -> Column:
    """Like :func:`decimal_number`, but unreadable text becomes NULL."""
    return F.trim(_col(c)).try_cast("double")


def lenient_whole(c) -> Column:
    """Like :func:`whole_number`, but unreadable text becomes NULL."""
    return F.round(lenient_decimal(c)).cast("int")


def round2(c) -> Column:
    """Round to two places by scaling the double, as SQL engines that round binary doubles do.

    ``F.round(x, 2)`` rounds the shortest decimal text instead, and differs for values such as 1.005.
    """
    return F.round(_col(c) * 100) / 100


def ratio(numerator, denominator) -> Column:
    """``numerator / denominator``; NULL when the denominator is zero."""
    return _col(numerator).cast("double") / F.nullif(_col(denominator).cast("double"), F.lit(0.0))


def percent(part, whole) -> Column:
    """``100 * part / whole`` to two places; NULL when ``whole`` is zero."""
    return round2(ratio(_col(part).cast("double") * 100.0, whole))


def positive_flag(c) -> Column:
    """1 when the value is above zero, else 0 (also for NULL)."""
    return F.when(_col(c) > 0, 1).otherwise(0)


def is_unreadable(c, kind: str) -> Column:
    """True for text that is present but is no finite number, or for kind ``"int"`` none that rounds into the range of INT."""
    number = F.trim(_col(c)).try_cast("double")  # used once, because filters work out each use anew; NaN is above all numbers
    if kind == "int":
        right = F.round(number).between(-(2**31), 2**31 - 1)
    else:
        right = F.abs(number) <= sys.float_info.max
    return _col(c).isNotNull() & ~F.coalesce(right, F.lit(False))


def rate_entries(text) -> Column:
    """Parse a flat rate dictionary such as ``{'RN': 46, 'Med Tech': None}`` to a map of strings; unreadable text gives NULL."""
    flat = _col(text).rlike(r"^\s*\{[^{}]*\}\s*$")
    as_json = F.regexp_replace(_col(text), r":\s*None\b", ": null")
    return F.when(flat, F.from_json(as_json, "map<string,string>", {"allowSingleQuotes": "true"}))


#: Dictionaries whose entries are all readable, as they are usually written: plain numbers of at most 15 digits on either side, or None.
_READABLE = r"^\{'[A-Za-z ]+': ?(?:None|(?:0|[1-9]\d{0,14})(?:\.\d{1,15})?)(?:, ?'[A-Za-z ]+': ?(?:None|(?:0|[1-9]\d{0,14})(?:\.\d{1,15})?))*\}$"
_PLAIN = r"^\{'[A-Za-z ]+': \d+(?:\.\d+)?(?:, '[A-Za-z ]+': \d+(?:\.\d+)?)*\}$"


def _cut_rate(text: Column, key: Column) -> tuple[Column, Column]:
    """Whether a dictionary has only names and plain numbers or None, the key once at most, so that it can be cut instead of parsed; and the cut.

    Quotes stand only around names there, so the quoted key with its colon can only be found where an entry begins.
    """
    quoted = F.concat(F.lit("'"), key, F.lit("':"))
    at = F.position(quoted, text)
    number = F.substring_index(F.substring_index(F.substr(text, at + F.length(quoted)), ",", 1), "}", 1)
    once = (at == 0) | (F.position(quoted, text, at + 1) == 0)
    return (text.rlike(_READABLE) | text.rlike(_PLAIN)) & once, F.when(at > 0, number.try_cast("double"))


def rate_for(text, key, lenient: bool = False) -> Column:
    """The entry of a rate dictionary for a per-row key, as DOUBLE. A missing entry or ``None`` gives NULL.

    Text that is not a dictionary, and an entry that is not a number, fail the job; with ``lenient`` they give NULL.
    """
    whole, name = _col(text), _col(key)

    entries = rate_entries(whole)
    if not lenient:
        refuse = F.raise_error(F.concat(F.lit("unreadable rate: "), whole)).cast("map<string,string>")
        entries = F.coalesce(entries, F.when(whole.isNotNull(), refuse))  # parsed once, without a lambda that is not compiled
    value = F.trim(F.try_element_at(entries, name))
    plain, cut = _cut_rate(whole, name)
    return F.when(plain, cut).otherwise(value.try_cast("double") if lenient else value.cast("double"))


def rate_is_unreadable(text, key=None) -> Column:
    """True for rate text that is present but is not a dictionary, or whose entry for ``key`` is no finite number.

    A dictionary in the usual spelling, with nothing but readable entries, need not be parsed.
    """

    def wrong(entries: Column) -> Column:
        if key is None:
            return entries.isNull()
        return entries.isNull() | F.coalesce(is_unreadable(F.try_element_at(entries, _col(key)), "double"), F.lit(False))

    usual = F.coalesce(_col(text).rlike(_READABLE), F.lit(True))  # absent text is not unreadable
    parsed = F.get(F.transform(F.array(rate_entries(text)), wrong), F.lit(0))  # parsed once, used twice
    return F.when(usual, False).otherwise(parsed)

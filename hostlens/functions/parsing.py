"""Column -> Column parsers for the raw listing / calendar text fields.

All of them are built-in expressions (JVM side, inside whole-stage codegen).
``try_cast`` keeps the lenient results of the old non-ANSI casts under
Spark 4's ANSI mode (a bad number becomes NULL instead of failing the job).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

MONEY_STRIP = "[$]"            # only the currency sign (comma kept -> NULL)
MONEY_STRIP_THOUSANDS = "[$,]"  # also the thousands separator
BREAK_TAG = r"<br/?\s*>"       # case-sensitive; '<br />' and '<BR>' survive
NUMBER_IN_TEXT = r"(\d+\.?\d*)"
AMENITY_JUNK = r"[\[\]\"]"


def parse_flag(c) -> Column:
    """'t' -> true, 'f' -> false, anything else (incl. NULL) -> NULL."""
    c = col_of(c)
    return F.when(c == "t", F.lit(True)).when(c == "f", F.lit(False)).otherwise(F.lit(None).cast("boolean"))


def parse_money(c, strip: str = MONEY_STRIP) -> Column:
    """'$80.00' -> 80.0 (float).  With the default strip '$1,200.00' -> NULL."""
    return F.regexp_replace(col_of(c), strip, "").try_cast("float")


def parse_money_thousands(c) -> Column:
    """Like :func:`parse_money` but drops thousands commas: '$1,200.00' -> 1200.0."""
    return parse_money(c, MONEY_STRIP_THOUSANDS)


def strip_breaks(c) -> Column:
    """Remove ``<br>``, ``<br/>`` and ``<br/ >``-style break tags."""
    return F.regexp_replace(col_of(c), BREAK_TAG, "")


def bathroom_count(c) -> Column:
    """First number in the bathrooms text as float; no digit -> NULL."""
    return F.regexp_extract(col_of(c), NUMBER_IN_TEXT, 1).try_cast("float")


def contains_flag(c, needle: str) -> Column:
    """1 when the text contains ``needle`` (case-sensitive LIKE), else 0."""
    return F.when(col_of(c).like(f"%{needle}%"), 1).otherwise(0)


def empty_list_to_null(c, sentinel: str = "[]") -> Column:
    """Sentinel text (default ``'[]'``) -> NULL, other values unchanged."""
    c = col_of(c)
    return F.when(c == sentinel, F.lit(None).cast("string")).otherwise(c)


def null_to_empty(c) -> Column:
    """NULL -> '' (text columns)."""
    return F.coalesce(col_of(c), F.lit(""))


def amenity_list(c) -> Column:
    """'["Wifi", "TV"]' -> ['Wifi', 'TV'] by stripping ``[ ] "`` and splitting on ', '.

    A name that itself holds ', ' is split in two (text semantics).
    """
    return F.split(F.regexp_replace(empty_list_to_null(c), AMENITY_JUNK, ""), ", ")


def amenity_list_json(c) -> Column:
    """JSON parse of the amenity text; names holding ', ' stay whole."""
    return F.from_json(empty_list_to_null(c), "array<string>")


def amenity_count(c, json: bool = False) -> Column:
    """Number of amenities; empty list or NULL -> -1 (as the non-ANSI ``size``)."""
    arr = amenity_list_json(c) if json else amenity_list(c)
    return F.coalesce(F.size(arr), F.lit(-1))

"""Identifier lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: placeholder written by older exports instead of an empty id.
EMPTY_USER = "empty_user_id"


def clean_ids(ids: Column) -> Column:
    """Distinct ids in first-seen order without nulls, blanks and the placeholder."""
    return F.filter(
        F.array_distinct(ids), lambda x: x.isNotNull() & (x != "") & (x != EMPTY_USER)
    )


def split_ids(text: Column) -> Column:
    """A comma separated text as an array; an empty or missing text is an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda x: x != "")


def parse_pg_array(literal: Column) -> Column:
    """``{a,b}`` as written by PostgreSQL exports to an array; ``{}`` is an empty array."""
    return split_ids(F.regexp_replace(literal, r"^\{|\}$", ""))


def first_numeric_id(ids: Column) -> Column:
    """Digits of the first element, null when there is no element or no digit in it."""
    digits = F.regexp_extract(F.try_element_at(ids, F.lit(1)), "([0-9]+)", 1)
    return F.when(digits != "", digits)

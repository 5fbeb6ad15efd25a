"""Text expressions: stripping, keys, name parts, principal keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes. Spark's own trim removes spaces only.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def non_blank(c: Column) -> Column:
    """Stripped text, with blank text turned into null."""
    s = strip(c)
    return F.when(s != "", s)


def normalize_name(c: Column) -> Column:
    return F.lower(strip(F.coalesce(c, F.lit(""))))


def short_id(c: Column) -> Column:
    """First ten hex digits of the SHA-256 of the normalised text."""
    return F.substring(F.sha2(normalize_name(c), 256), 1, 10)


def joined_name(first: Column, last: Column) -> Column:
    """Stripped first and last name with one space between; a missing part is skipped."""
    return F.concat_ws(" ", strip(first), strip(last))


def first_name(full_name: Column) -> Column:
    return F.get(F.split(strip(full_name), r"\s+"), F.lit(0))


def last_name(full_name: Column) -> Column:
    parts = F.split(strip(full_name), r"\s+")
    return F.array_join(F.slice(parts, F.lit(2), F.size(parts)), " ")


def principal_key(c: Column) -> Column:
    """Login key of a person: name without spaces, lower case."""
    return F.lower(F.regexp_replace(c, " ", ""))

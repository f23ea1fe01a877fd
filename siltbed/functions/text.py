"""String expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Every character that counts as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Remove white space of every kind at both ends (``trim`` removes blanks only).

    Looks at the ends only; a regular expression would walk through the whole text.
    """
    return F.btrim(value, F.lit(WHITE_SPACE))


def is_blank(value: Column) -> Column:
    return value.isNull() | (F.length(strip(value)) == 0)


def digest(value: Column) -> Column:
    """Hex SHA-256 of a string."""
    return F.sha2(value, 256)


def short_digest(value: Column, size: int = 24) -> Column:
    return F.substring(digest(value), 1, size)


def words(value: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(value), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def word_line(value: Column) -> Column:
    """The same words in one string, with a blank between them; empty where there are none."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(value, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def iso_utc(value: Column) -> Column:
    """Timestamp as an ISO-8601 UTC string; the stored type stays TIMESTAMP."""
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")

"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space of all scripts, plus the four separator control codes, as a regex class body.
WHITE = r"\s\x1c-\x1f"
UNICODE = "(?U)"


def titled(c: Column) -> Column:
    """Trim spaces, then capitalise each space-separated word."""
    return F.initcap(F.trim(c))


def coded(c: Column) -> Column:
    """Trim spaces, then upper-case: the form of all code columns."""
    return F.upper(F.trim(c))


def stripped(c: Column) -> Column:
    """Drop white space of any kind (tabs too, unlike ``trim``) from both ends."""
    return F.regexp_replace(c, f"{UNICODE}^[{WHITE}]+|[{WHITE}]+$", "")


def words(c: Column) -> Column:
    """The white-space separated tokens; an empty array for blank text."""
    return F.array_remove(F.split(c, f"{UNICODE}[{WHITE}]+"), "")


def first_word(c: Column) -> Column:
    return F.regexp_extract(c, f"{UNICODE}[^{WHITE}]+", 0)


def callsign(c: Column) -> Column:
    """Radio callsign of an airline name: no spaces, upper case, eight characters."""
    return F.substring(F.upper(F.replace(c, F.lit(" "), F.lit(""))), 1, 8)


def base_name(path: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(path, "/", -1)

"""Text expressions: trimming, title case, status names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space, in code point order.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# Spelling found in source files -> status name.
STATUS_NAMES = {
    "lead": "Lead",
    "qualification": "Qualification",
    "qualified": "Qualification",
    "proposal": "Proposal",
    "proposed": "Proposal",
    "negotiation": "Negotiation",
    "negotiating": "Negotiation",
    "submitted": "Submitted",
    "won": "Won",
    "closed won": "Won",
    "awarded": "Won",
    "lost": "Lost",
    "closed lost": "Lost",
    "declined": "Declined",
    "cancelled": "Cancelled",
    "on hold": "On Hold",
    "in progress": "In Progress",
    "active": "In Progress",
}

# Statuses of an opportunity that is still open.
OPEN_STATUSES = ("Open", "In Progress", "Qualified")

UNKNOWN = "Unknown"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim all white space at both ends; null stays null."""
    return F.btrim(as_column(c).cast("string"), F.lit(WHITESPACE))


def clean_string(c: Column | str) -> Column:
    """Trimmed text; null becomes the empty string."""
    return F.coalesce(strip(c), F.lit(""))


def title_case(c: Column | str) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others.

    ``initcap`` only breaks words at blanks, so runs of letters are cut out instead.
    """
    runs = F.regexp_extract_all(as_column(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    cased = F.transform(
        runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substr(r, F.lit(2))))
    )
    return F.array_join(cased, "")


def lookup(c: Column, names: dict[str, str]) -> Column:
    """Value of a small literal map, null where the key is missing."""
    entries = [F.lit(part) for pair in names.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), c)


def standardize_status(c: Column | str, names: dict[str, str] | None = None) -> Column:
    """Status name for a spelling; unlisted spellings get title case, blanks ``Unknown``."""
    c = as_column(c)
    known = lookup(strip(F.lower(c)), names or STATUS_NAMES)
    return F.when(c.isNull() | (c == ""), F.lit(UNKNOWN)).otherwise(F.coalesce(known, title_case(c)))


def statecode(c: Column | str) -> Column:
    """0 for an open-like opportunity status, 1 for any other."""
    return F.when(F.coalesce(as_column(c).isin(*OPEN_STATUSES), F.lit(False)), 0).otherwise(1)

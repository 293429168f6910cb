"""Numbers out of text: amounts, percentages, size tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabprep.functions.text import as_column, strip

MONEY = "decimal(38,10)"

# Characters dropped from an amount before it is parsed.
AMOUNT_NOISE = ", $€£"

# Lower bound -> tier name, highest first.
VALUE_TIERS = (
    (5_000_000, "5M+"),
    (1_000_000, "1M-5M"),
    (500_000, "500K-1M"),
    (100_000, "100K-500K"),
)
LOWEST_TIER = "<100K"
NO_TIER = "Unknown"


def clean_numeric(c: Column | str) -> Column:
    """Decimal from an amount with currency signs and separators; null where unparsable."""
    return F.translate(as_column(c).cast("string"), AMOUNT_NOISE, "").try_cast(MONEY)


def parse_currency(c: Column | str) -> Column:
    """As :func:`clean_numeric`, with 0 for null and unparsable amounts."""
    return F.coalesce(clean_numeric(c), F.lit(0).cast(MONEY))


def parse_probability(c: Column | str) -> Column:
    """Share from ``80%``, ``0,8`` or ``50``: text above 1 is a percentage, numbers stay as they are.

    ``typeof`` is folded at analysis, so only the branch for the column's type is left in the plan.
    """
    c = as_column(c)
    text = strip(F.translate(c.cast("string"), ",%", ".")).try_cast(MONEY)
    share = F.when(text > 1, (text * F.lit(0.01).cast("decimal(3,2)")).cast(MONEY)).otherwise(text)
    parsed = F.when(F.typeof(c) == "string", share).otherwise(c.try_cast(MONEY))
    return F.coalesce(parsed, F.lit(0).cast(MONEY))


def value_tier(c: Column | str) -> Column:
    """Size class of an amount."""
    c = as_column(c).try_cast("double")
    tier = F.when(c.isNull(), NO_TIER)
    for bound, name in VALUE_TIERS:
        tier = tier.when(c >= bound, name)
    return tier.otherwise(LOWEST_TIER)

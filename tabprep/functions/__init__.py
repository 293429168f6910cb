from tabprep.functions.dates import as_date, clean_date, duration_months, duration_months_avg
from tabprep.functions.numeric import (
    MONEY,
    clean_numeric,
    parse_currency,
    parse_probability,
    value_tier,
)
from tabprep.functions.text import (
    clean_string,
    standardize_status,
    statecode,
    strip,
    title_case,
)

__all__ = [
    "MONEY",
    "as_date",
    "clean_date",
    "clean_numeric",
    "clean_string",
    "duration_months",
    "duration_months_avg",
    "parse_currency",
    "parse_probability",
    "standardize_status",
    "statecode",
    "strip",
    "title_case",
    "value_tier",
]

"""Sensitive data: dropping columns, redacting text, counting matches."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that are always dropped.
SENSITIVE_COLUMNS = (
    "_source_file",
    "_extracted_at",
    "_generated_at",
    "_quarantine_reason",
    "_quarantined_at",
    "client_id",
    "client_secret",
    "tenant_id",
    "password",
    "api_key",
    "access_token",
    "email",
    "phone",
    "address",
    "ssn",
    "cpf",
    "cnpj",
)

# Parts of a column name that make it sensitive.
SENSITIVE_NAME_PARTS = ("password", "secret", "token", "key", "email", "phone", "cpf", "cnpj")

# Patterns of sensitive text.
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE = r"(\+?\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}"
CPF = r"\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b"
CNPJ = r"\b\d{2}\.?\d{3}\.?\d{3}/\d{4}-?\d{2}\b"
API_KEY = r"sk-[a-zA-Z0-9]{48}"
BEARER = r"Bearer\s+[a-zA-Z0-9._-]+"
CREDENTIAL_NAMES = r"(password|secret|token|key|api_key|client_secret)"
CREDENTIAL = CREDENTIAL_NAMES + r"\s*[:=]\s*\S+"

# Pattern and replacement, in order. The order matters: a bare 11-digit CPF also has
# the shape of a phone number and is taken as one.
REDACTIONS = (
    (EMAIL, "[EMAIL REDACTED]"),
    (PHONE, "[PHONE REDACTED]"),
    (CPF, "[CPF REDACTED]"),
    (CNPJ, "[CNPJ REDACTED]"),
    (API_KEY, "[API KEY REDACTED]"),
    (BEARER, "[TOKEN REDACTED]"),
)
CREDENTIAL_REDACTIONS = (
    (CREDENTIAL_NAMES + r"\s*:\s*\S+", "$1: [REDACTED]"),
    (CREDENTIAL_NAMES + r"\s*=\s*\S+", "$1=[REDACTED]"),
    (EMAIL, "[EMAIL REDACTED]"),
)
# Labels of the scan.
SCAN_LABELS = {
    "Email": EMAIL,
    "Phone": PHONE,
    "CPF": CPF,
    "CNPJ": CNPJ,
    "API Key": API_KEY,
    "Credential": CREDENTIAL,
}


def _may_match(pattern: str, c: Column) -> Column:
    """A cheap test that every text with a match passes. Most text has none, and searching it for
    a few plain characters costs far less than trying the pattern at each position."""

    def holds(*parts: str) -> Column:
        found = [F.contains(F.lower(c), F.lit(p)) for p in parts]
        return reduce(or_, found)

    if pattern == EMAIL:
        return F.contains(c, F.lit("@"))
    if pattern == PHONE:
        return c.rlike(r"\d{3}[-.\s]?\d{4}")
    if pattern == CPF:
        return c.rlike(r"\d{3}-?\d{2}")
    if pattern == CNPJ:
        return F.contains(c, F.lit("/"))
    if pattern == API_KEY:
        return holds("sk-")
    if pattern == BEARER:
        return F.contains(c, F.lit("Bearer"))
    return holds("password", "secret", "token", "key")


def drop_sensitive_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that are known to be sensitive."""
    return df.drop(*SENSITIVE_COLUMNS)


def drop_sensitive_like(df: DataFrame) -> DataFrame:
    """Drop every column whose name contains a sensitive word, in any case."""
    keep = [c for c in df.columns if not any(part in c.lower() for part in SENSITIVE_NAME_PARTS)]
    return df.select(*keep)


def _replace_all(df: DataFrame, columns: Sequence[str], steps: Sequence[tuple[str, str]], flags: str = "") -> DataFrame:
    """Replacements one after the other, each a projection of its own over the one before."""
    for pattern, replacement in steps:
        replaced = {}
        for name in columns:
            c = F.col(f"`{name}`")
            done = F.regexp_replace(c, flags + pattern, replacement)
            replaced[name] = F.when(_may_match(pattern, c), done).otherwise(c)
        df = df.withColumns(replaced)
    return df


def redact(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Redact all string columns, or the given ones; nulls stay null.

    Replaced are e-mail addresses, phone numbers, CPF and CNPJ numbers, API keys and bearer tokens.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return _replace_all(df, texts if columns is None else columns, REDACTIONS)


def redact_credentials(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Blank the values of credential settings (``name: value``, ``name=value``) and e-mail addresses."""
    return _replace_all(df, columns, CREDENTIAL_REDACTIONS, "(?i)")


def scan_sensitive(df: DataFrame, text_column: str, id_column: str) -> DataFrame:
    """Matches per row and label over whole texts, rows without matches left out."""
    text = F.col(text_column)
    found = [
        F.struct(
            F.lit(label).alias("label"),
            F.when(_may_match(pattern, text), F.regexp_count(text, F.lit("(?i)" + pattern)))
            .otherwise(0)
            .cast("bigint")
            .alias("matches"),
        )
        for label, pattern in SCAN_LABELS.items()
    ]
    return df.select(id_column, F.inline(F.array(*found))).where(F.col("matches") > 0)


def suffix_of(path: str) -> str:
    """Lower-case file suffix without the dot."""
    match = re.search(r"\.([^./]+)/?$", path)
    return match.group(1).lower() if match else ""

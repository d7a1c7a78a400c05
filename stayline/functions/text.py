"""Tokens, n-grams and small text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: runs of two or more word characters.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), F.lit(0))


def bigrams(toks: Column) -> Column:
    """Neighbouring pairs; zip of two slices so that no lambda re-reads the regex."""
    n = F.size(toks)
    return F.when(
        n >= 2,
        F.zip_with(
            F.slice(toks, F.lit(1), n - 1),
            F.slice(toks, F.lit(2), n - 1),
            lambda a, b: F.concat(a, F.lit(" "), b),
        ),
    ).otherwise(F.array().cast("array<string>"))


def uni_bigrams(toks: Column) -> Column:
    return F.concat(toks, bigrams(toks))


def tag(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


def fixed(c: Column, decimals: int) -> Column:
    """Text with a fixed number of decimals, half-up."""
    return F.format_string(f"%.{decimals}f", c.cast("double"))


def join_parts(*parts: Column) -> Column:
    """Join with spaces, skipping NULL and empty parts."""
    return F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts])

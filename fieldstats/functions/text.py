"""Cleaning of labels and numbers that come as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Subtotal words dropped from record sheets, and the code form
# (one capital letter and three digits at the start of the label).
SUBTOTAL_PATTERN = "소계|계"
CODE_PATTERN = r"^([A-Z]\d{3})"


def without_match(text: Column, pattern: str) -> Column:
    """True unless the pattern occurs; missing text is kept."""
    return ~F.coalesce(F.rlike(text, F.lit(pattern)), F.lit(False))


def extract_or_null(text: Column, pattern: str) -> Column:
    """First group of the pattern, NULL where it does not match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def stripped(text: Column) -> Column:
    """Without white space at both ends, tabs, line breaks and no-break spaces included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def leading_code(label: Column) -> Column:
    return F.upper(extract_or_null(label, CODE_PATTERN))


def plain_integer(text: Column, strict: bool = True) -> Column:
    """Integer of ``'1,234'``; a lone ``'-'`` is 0, other text raises or, if not strict, is NULL."""
    bare = F.regexp_replace(text, ",", "")
    digits = F.when(bare == "-", "0").otherwise(bare)
    return digits.cast("bigint") if strict else digits.try_cast("bigint")


def first_like(text: Column, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first LIKE pattern that fits; the order of the rules counts."""
    label = F.lit(default).cast("string")
    for pattern, name in reversed(rules):
        label = F.when(text.like(pattern), F.lit(name)).otherwise(label)
    return label


def in_class(parts: Sequence[Column], members: Sequence[str], hit: str, miss: str) -> Column:
    """``hit`` where the joined parts are a member; a missing part gives ``miss``."""
    return F.when(F.concat(*parts).isin(list(dict.fromkeys(members))), F.lit(hit)).otherwise(F.lit(miss))

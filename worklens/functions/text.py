"""Text cleaning and pt-BR formatting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeeze(col: Column | str) -> Column:
    """One space between words, none at the edges, empty text as NULL.

    Whitespace is collapsed before trimming, so a tab or newline at an edge leaves nothing behind.
    """
    words = F.trim(F.regexp_replace(col, r"\s+", " "))
    return F.nullif(words, F.lit(""))


def capitalised(col: Column | str) -> Column:
    return F.initcap(F.lower(squeeze(col)))


def in_domain(col: Column | str, domain: Sequence[str], otherwise: str) -> Column:
    """Capitalised text when it belongs to a closed domain, else one default (NULL included)."""
    value = capitalised(col)
    return F.when(value.isin(list(domain)), value).otherwise(F.lit(otherwise))


def joined(labels: Column | str) -> Column:
    return F.array_join(labels, ", ")


def empty_labels(labels: Column | str) -> Column:
    """NULL label list as an empty list."""
    return F.coalesce(labels, F.array().cast("array<string>"))


def number_br(value: Column, digits: int = 0) -> Column:
    """``1.234,5``: half rounds away from zero before formatting."""
    return F.translate(F.format_number(F.round(value, digits), digits), ",.", ".,")


def percent_br(share: Column, digits: int = 0) -> Column:
    """``12,3%``. The share is rounded as written, so 0.285 is 29 % and not 28.4999."""
    return F.concat(number_br(F.round(share, digits + 2) * 100, digits), F.lit("%"))


def signed(value: Column, digits: int, text: Column) -> Column:
    """Prefix ``+`` when the value is still positive after rounding to ``digits``."""
    return F.concat(F.when(F.round(value, digits) > 0, F.lit("+")).otherwise(F.lit("")), text)


def signed_percent_br(share: Column, digits: int = 0) -> Column:
    return signed(share, digits + 2, percent_br(share, digits))


def whole_br(value: Column) -> Column:
    """A count as text, BLANK shown as zero."""
    return number_br(F.coalesce(value, F.lit(0)))

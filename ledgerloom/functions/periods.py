"""Fiscal period keys as columns: FY2024, Q3-2024, H1-2024; 9M-2024 is year-to-date and takes no part in metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_type(key: Column) -> Column:
    k = F.upper(F.trim(key))
    return (
        F.when(k.rlike(r"^FY\d{4}$"), "annual")
        .when(k.rlike(r"^Q[1-4]-\d{4}$"), "quarterly")
        .when(k.rlike(r"^H[12]-\d{4}$"), "semestral")
        .when(k.rlike(r"^9M-\d{4}$"), "ytd")
        .otherwise("unknown")
    )


def period_year(key: Column) -> Column:
    return F.regexp_extract(key, r"(\d{4})$", 1).try_cast("int")


def period_ordinal(key: Column) -> Column:
    """Quarter or half within the year; 1 for a year."""
    k = F.upper(F.trim(key))
    return F.when(k.rlike(r"^FY\d{4}$"), F.lit(1)).otherwise(F.regexp_extract(k, r"^[QH](\d)-", 1).try_cast("int"))


def period_end(key: Column, explicit: Column | None = None) -> Column:
    """The given date if it can be read, else the last day that the key names (calendar year)."""
    kind, year, ordinal = period_type(key), period_year(key), period_ordinal(key)
    month = F.when(kind == "annual", F.lit(12)).when(kind == "quarterly", ordinal * 3).when(kind == "semestral", ordinal * 6).when(kind == "ytd", F.lit(9))
    named = F.when(month.isNotNull() & year.between(1, 9999), F.last_day(F.make_date(year, month, F.lit(1))))
    return named if explicit is None else F.coalesce(explicit.try_cast("date"), named)

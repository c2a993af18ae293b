"""What tickers, hints and calendars say about issuers, as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exchange, country, source hint and accounting standard by suffix.
SUFFIXES = {
    ".PA": ("EPA", "FR", "eu_manual", "IFRS"),
    ".AX": ("ASX", "AU", "asx", "IFRS"),
    ".L": ("LSE", "GB", "eu_manual", "IFRS"),
    ".HK": ("SEHK", "HK", "eu_manual", "IFRS"),
    ".TO": ("TSX", "CA", "eu_manual", "IFRS"),
    ".T": ("TSE", "JP", "eu_manual", "IFRS"),
    ".DE": ("XETRA", "DE", "eu_manual", "IFRS"),
    ".AS": ("EPA", "NL", "eu_manual", "IFRS"),
    ".BR": ("EPA", "BE", "eu_manual", "IFRS"),
    ".LS": ("EPA", "PT", "eu_manual", "IFRS"),
    ".SI": ("SGX", "SG", "eu_manual", "IFRS"),
}
# Connectors by source hint; others are read from files.
CONNECTORS = {"sec": "sec_edgar", "sec_edgar": "sec_edgar", "asx": "asx", "eu": "eu_regulators", "eu_manual": "eu_regulators", "manual_http": "eu_regulators", "hkex": "hkex", "hkex_manual": "hkex"}
# What an issuer's settings are where its file is silent.
DEFAULTS = {"ticker": "", "source_hint": "sec", "currency": "USD", "fiscal_year_end_month": 12, "period_scope": "FULL", "notes": "", "use_ixbrl_override": False}
SETTINGS = "ticker string, company_name string, source_hint string, currency string, fiscal_year_end_month int, period_scope string, cik string, exchange string, country string, sector string, notes string, use_ixbrl_override boolean"


def ticker_parts(ticker: Column) -> Column:
    """struct(base, suffix) of TICKER.XX; the suffix is null if there is none."""
    part = lambda k: F.regexp_extract(ticker, r"(?i)^(.+?)(\.[A-Z]{1,3})$", k)
    return F.struct(F.when(part(1) != "", part(1)).otherwise(ticker).alias("base"), F.when(part(2) != "", F.upper(part(2))).alias("suffix"))


def suffix_info(suffix: Column) -> Column:
    """struct(exchange, country, source_hint, standard) of a suffix; null for others."""
    names = ("exchange", "country", "source_hint", "standard")
    one = lambda v: F.struct(*[F.lit(x).alias(n) for x, n in zip(v, names, strict=True)])
    return reduce(lambda out, kv: out.when(suffix == kv[0], one(kv[1])), SUFFIXES.items(), F.when(F.lit(False), one(("", "", "", ""))))


def connector(hint: Column) -> Column:
    """The connector that reads an issuer's filings."""
    return reduce(lambda out, kv: out.when(F.lower(hint) == kv[0], kv[1]), CONNECTORS.items(), F.when(F.lit(False), "")).otherwise("manual")


def reporting_months(fiscal_year_end: Column) -> Column:
    """struct(annual, half_year): the calendar months in which reports are due, the second and third after each period."""
    due = lambda *offsets: F.array(*[F.pmod(fiscal_year_end + o, F.lit(12)) + 1 for o in offsets])
    return F.struct(due(1, 2).alias("annual"), due(7, 8).alias("half_year"))


def settings(text: Column) -> Column:
    """struct of an issuer's settings from its JSON, with defaults where it is silent."""
    read = F.from_json(text, SETTINGS)
    names = [x.split()[0] for x in SETTINGS.split(", ")]
    return F.struct(*[F.coalesce(read[n], F.lit(DEFAULTS[n])).alias(n) if n in DEFAULTS else read[n].alias(n) for n in names])

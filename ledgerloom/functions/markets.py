"""Exchanges, countries and regulators as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exchanges and countries outside the United States.
NON_US_EXCHANGES = ("LSE", "AIM", "SEHK", "HKEX", "ASX", "EPA", "TSX", "OTRA")
# Names of countries and their codes.
COUNTRY_CODES = {"USA": "US", "UNITED STATES": "US", "UNITED STATES OF AMERICA": "US", "AUSTRALIA": "AU", "ISRAEL": "IL", "FRANCE": "FR", "CANADA": "CA", "UNITED KINGDOM": "GB", "HONG KONG": "HK", "CHINA": "CN", "JAPAN": "JP", "SINGAPORE": "SG", "GERMANY": "DE", "SWITZERLAND": "CH"}
# Regulators with their exchanges and countries, in order.
REGULATORS = (("HKEX", ("SEHK", "HKEX"), ("HK",)), ("RNS", ("LSE", "AIM"), ("GB", "UK")), ("ASX", ("ASX",), ("AU",)), ("EURONEXT", ("EPA",), ("FR",)), ("SEDAR+", ("TSX",), ("CA",)))


def _named(value: Column) -> Column:
    t = F.upper(F.trim(value))
    return F.when(t != "", t)


def country(value: Column) -> Column:
    """The code of a country's name, else the name in upper case; null for none."""
    t, out = _named(value), F.when(F.lit(False), "")
    for name, code in COUNTRY_CODES.items():
        out = out.when(t == name, code)
    return out.otherwise(t)


def exchange(value: Column) -> Column:
    t = _named(value)
    return F.when(t.contains("OTC"), "OTC").otherwise(t)


def is_non_us(exchange: Column, country: Column, cik: Column) -> Column:
    """By country, else by exchange; with neither, whoever has no registrant number."""
    home = F.coalesce(country.isin("US", "USA"), F.lit(False))
    named = F.coalesce(country, F.lit("")) != ""
    return (named & ~home) | F.coalesce(exchange.isin(*NON_US_EXCHANGES), F.lit(False)) | (cik.isNull() & ~home)


def regulator(exchange: Column, country: Column) -> Column:
    ex, c, out = F.upper(F.coalesce(exchange, F.lit(""))), F.upper(F.coalesce(country, F.lit(""))), F.when(F.lit(False), "")
    for code, exchanges, countries in REGULATORS:
        out = out.when(ex.isin(*exchanges) | c.isin(*countries), code)
    return out.otherwise("LOCAL_IR")

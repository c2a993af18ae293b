"""What the names, types and periods of filings say, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks of a form in a file name, in order.
FORM_MARKS = (("10-K", ("10-k", "10k")), ("10-Q", ("10-q", "10q")), ("20-F", ("20-f", "20f")), ("8-K", ("8-k", "8k")), ("6-K", ("6-k", "6k")))
# Source types by category.
CATEGORY_TYPES = {
    "REGULATORIO": ("10-K", "10-Q", "20-F", "6-K", "8-K", "DEF14A", "SEC_EXHIBIT", "CREDIT_AGREEMENT", "ANNUAL_REPORT", "INTERIM_REPORT", "REGULATORY_FILING", "40-F", "QUARTERLY_REPORT"),
    "TRANSCRIPCION": ("EARNINGS_TRANSCRIPT", "TRANSCRIPT", "CALL_TRANSCRIPT"),
    "IR": ("INVESTOR_PRESENTATION", "IR_NEWS", "PRESS_RELEASE", "SLIDES"),
}
# Statement titles.
SECTIONS = {
    "income_statement": r"(?:consolidated\s+)?(?:statements?\s+of\s+)?(?:income|operations|comprehensive\s+(?:income|loss)|earnings|profit\s+(?:and|or)\s+loss)|income\s+statement|profit\s+statement",
    "balance_sheet": r"(?:consolidated\s+)?balance\s+sheet|(?:consolidated\s+)?statements?\s+of\s+financial\s+position",
    "cash_flow": r"(?:consolidated\s+)?statements?\s+of\s+cash[\s-]?flow|(?:consolidated\s+)?cash[\s-]?flow\s+statement",
    "equity": r"statements?\s+of\s+(?:stockholders|shareholders|changes\s+in)\s*(?:'s?)?\s*equity",
}
# Fields by the sign that they are kept with.
POSITIVE = ("ingresos", "gross_profit", "cost_of_revenue", "research_and_development", "sga", "depreciation_amortization", "interest_expense", "shares_outstanding", "total_assets", "total_liabilities", "cash_and_equivalents", "total_debt")
NEGATIVE = ("capex",)
# Annual and periodic forms.
ANNUAL_FORMS, PERIODIC_FORMS = ("10-K", "20-F", "40-F"), ("10-Q", "6-K")
# Extensions of a source's files, the best first.
EXTENSIONS = (".clean.md", ".txt", ".htm", ".html", ".pdf")


def _any_of(text: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out |= text.contains(w)
    return out


def form_of(name: Column) -> Column:
    """The form that a file name mentions, unknown if none."""
    low, out = F.lower(name), F.when(F.lit(False), "")
    for form, marks in FORM_MARKS:
        out = out.when(_any_of(low, marks), form)
    return out.otherwise("unknown")


def filing_type(name: Column) -> Column:
    """As form_of, and proxies, annual and interim reports."""
    low, form = F.lower(name), form_of(name)
    rest = F.when(_any_of(low, ("def14a", "proxy")), "DEF14A").when(low.contains("annual"), "annual_report").when(low.rlike(r"h[12]20\d{2}") | _any_of(low, ("interim", "half")), "interim_report").otherwise("unknown")
    return F.when(form == "unknown", rest).otherwise(form)


def stem(name: Column) -> Column:
    """struct(src_id, form, period) of SRC_nnn_FORM_PERIOD, in any case; null for other names."""
    part = lambda k: F.regexp_extract(name, r"(?i)^(SRC_\d+)_([A-Z0-9\-]+)_(.+)$", k)
    return F.when(part(1) != "", F.struct(F.upper(part(1)).alias("src_id"), F.upper(part(2)).alias("form"), part(3).alias("period")))


def base_id(name: Column) -> Column:
    """A file name without .clean.md, or else without its last extension; the same for all variants of a filing."""
    return F.when(name.endswith(".clean.md"), F.left(name, F.length(name) - 9)).otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]+$", ""))


def extension_rank(name: Column) -> Column:
    """The place of a file's extension among EXTENSIONS, null for others."""
    out = F.when(F.lit(False), 0)
    for k, e in enumerate(EXTENSIONS):
        out = out.when(name.endswith(e), k)
    return out


def source_type(value: Column) -> Column:
    """Upper case; OTHER for none."""
    t = F.upper(F.trim(value))
    return F.when(F.coalesce(t, F.lit("")) == "", "OTHER").otherwise(t)


def category(value: Column) -> Column:
    t, out = source_type(value), F.when(F.lit(False), "")
    for name, types in CATEGORY_TYPES.items():
        hit = t.isin(*types)
        out = out.when(hit | t.contains("TRANSCRIPT") if name == "TRANSCRIPCION" else hit, name)
    return out.when(t == "MARKET_DATA", "MERCADO").otherwise("OTRA")


def sections(text: Column) -> Column:
    """The statements whose titles occur in the first 50,000 characters (that window is part of the rule), in order."""
    sample = F.substring(text, 1, 50_000)
    return F.array_compact(F.array(*[F.when(sample.rlike("(?i)" + p), F.lit(s)) for s, p in SECTIONS.items()]))


def signed(field: Column, value: Column) -> Column:
    """Expenses and balances positive, capital expenditure negative, others as they are."""
    return F.when(field.isin(*POSITIVE), F.abs(value)).when(field.isin(*NEGATIVE), -F.abs(value)).otherwise(value)


def period_slug(raw: Column) -> Column:
    """Q4-2024 or FY2024 of the ways in which periods are written; what can't be read becomes a slug, nothing UNKNOWN."""
    t = F.trim(F.regexp_replace(F.replace(F.coalesce(raw, F.lit("")), F.lit("_"), F.lit("-")), r"\s+", " "))
    t = F.replace(F.upper(t), F.lit(" "), F.lit("-"))
    year, out = "((?:19|20)[0-9]{2})", F.when(F.lit(False), "")
    ways = ((f"^Q([1-4])-?{year}$", ""), ("^Q([1-4])-?([0-9]{2})$", "20"), (f"^Q([1-4])-?FY-?{year}$", ""), (f"^FY-?{year}$", None), (f"^([1-4])Q-?{year}$", ""), ("^([1-4])Q-?([0-9]{2})$", "20"), (f"^Q([1-4])-{year}", ""))
    for pattern, century in ways:
        first = F.regexp_extract(t, pattern, 1)
        made = F.concat(F.lit("FY"), first) if century is None else F.concat(F.lit("Q"), first, F.lit("-" + century), F.regexp_extract(t, pattern, 2))
        out = out.when(first != "", made)
    slug = F.regexp_replace(F.regexp_replace(t, "[^A-Za-z0-9_.-]+", "-"), "^-+|-+$", "")
    return out.otherwise(F.when(slug == "", "UNKNOWN").otherwise(slug))


def filed_period(document: Column, filed: Column, form: Column) -> Column:
    """The period of a form by the date in its document's name, else by its filing date; other forms have that date."""
    day = F.regexp_extract(document, "(20[0-9]{2})([0-9]{2})[0-9]{2}", 0)
    year = F.when(day != "", F.left(day, F.lit(4))).otherwise(F.year(filed).cast("string"))
    month = F.when(day != "", F.substring(day, 5, 2).cast("int")).otherwise(F.month(filed))
    quarter = F.when(month <= 3, 1).when(month <= 6, 2).when(month <= 9, 3).otherwise(4).cast("string")
    return F.when(form.isin(*ANNUAL_FORMS), F.concat(F.lit("FY"), year)).when(form.isin(*PERIODIC_FORMS), F.concat(F.lit("Q"), quarter, F.lit("-"), year)).otherwise(filed.cast("string"))


def plain_cell(cell: Column) -> Column:
    """A cell without invisible characters and outer white space."""
    return F.trim(F.regexp_replace(cell, "[​‌‍‎‏﻿­⁠⁣]", ""))


def scaled(value: Column, scale: Column, dominant: Column) -> Column:
    """A value of one power of ten in the one that dominates a filing; raw values (0) stay."""
    return F.when((scale == 0) | (dominant == 0) | (scale == dominant), value).otherwise(value * F.pow(F.lit(10.0), (scale - dominant).cast("double")))


def retry_wait(attempt: Column, base: float = 2.0) -> Column:
    """Seconds to wait after a failed attempt (0, 1, ...): doubled each time."""
    return base * F.pow(F.lit(2.0), attempt.cast("double"))


def retried(status: Column) -> Column:
    """Whether an HTTP status is worth another attempt."""
    return (status == 429) | status.between(500, 599)

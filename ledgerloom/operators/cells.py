"""Which cells of tables hold what their label says, and how rows of cells are mended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Balances that a cash-flow statement moves, and places in an income statement that aren't one.
WORKING = ("accounts_receivable", "inventories", "accounts_payable")
STRAY_WORKING = (":income_statement:net_income:", ":income_statement:net_(loss)_income:", ":income_statement:deferred_income_taxes:")
STRAY_LIABILITIES = (":income_statement:accumulated_other_comprehensive_income:", ":income_statement:less:_net_income_attributable_to_non-controlling_interest:")


def discard_reason(field: Column, label: Column, value: Column, scale: Column, location: Column, period: Column) -> Column:
    """Why a cell isn't taken, the first reason of those in order; null if it is."""
    at, low = F.lower(location), F.lower(label)
    income, cash = at.contains(":income_statement:"), at.contains(":cash_flow:")
    receivable_or_payable = field.isin("accounts_receivable", "accounts_payable")
    some = lambda text, words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))
    # tables of plain texts (tblN right behind the section) carry balances; named parts of the statement don't
    named_part = cash & ~at.rlike(r"^.*?:cash_flow:tbl")
    debt, liabilities = field == "total_debt", field == "total_liabilities"
    return (
        F.when(~T.plausible(value, field, scale), "scale_uncertain")
        .when(debt & (value < 0) & income, "negative_debt_in_IS")
        .when(debt & cash, "cashflow_debt_movement_not_balance")
        .when((receivable_or_payable & cash) | ((field == "inventories") & named_part), "cashflow_working_capital_not_balance")
        .when((field.isin(*WORKING) & some(at, STRAY_WORKING)) | (receivable_or_payable & at.contains(":income_statement:prepaid_income_taxes:")), "income_statement_working_capital_not_balance")
        .when((field == "accounts_payable") & low.contains("included in accounts payable"), "accounts_payable_component_not_balance")
        .when(liabilities & income, "income_statement_liabilities_not_balance")
        .when(liabilities & some(low, ("equity", "stockholders", "shareholders")), "liabilities_plus_equity_total_not_liabilities")
        .when(liabilities & some(at, STRAY_LIABILITIES), "income_statement_total_liabilities_not_balance")
        .when(F.coalesce(period, F.lit("")).isin("", "unknown"), "period_unknown")
    )


def reasons(cells: DataFrame) -> DataFrame:
    """(reason, n) of cells (field, label, value, scale, location, period); accepted ones have no reason."""
    named = cells.select(discard_reason(*[F.col(c) for c in ("field", "label", "value", "scale", "location", "period")]).alias("reason"))
    return named.groupBy("reason").agg(F.count("*").alias("n"))


def joined_parentheses(cells: Column) -> Column:
    """A row's cells where "( 1.2" and ")" side by side become "(1.2)"."""
    opens = lambda x: x.rlike(r"^\(\s*[$€£]?\s*[\d.,]+\s*$")
    n = F.size(cells)
    at = lambda i: F.get(cells, i)
    closed = lambda i: (i + 1 < n) & opens(at(i)) & (at(i + 1) == ")")
    mended = F.transform(cells, lambda x, i: F.when(closed(i), F.concat(F.lit("("), F.trim(F.substring(x, 2, 1 << 20)), F.lit(")"))).when((i > 0) & (x == ")") & opens(at(F.greatest(i - 1, F.lit(0)))), None).otherwise(x))
    return F.filter(mended, lambda x: x.isNotNull())


def preferred_equity(facts: DataFrame) -> DataFrame:
    """(doc, period, value): one total per period; from a balance sheet before other tables, from a restated one first."""
    place = F.when(F.lower("location").rlike("restated.*balance_sheet|balance_sheet.*restated"), 0).when(F.lower("location").contains("balance_sheet"), 1).otherwise(2)
    return facts.groupBy("doc", "period").agg(F.min_by("value", F.struct(place.alias("place"), "ord")).alias("value"), F.min(place).cast("int").alias("place"))


def anchored(parts: DataFrame, anchors: DataFrame) -> DataFrame:
    """The parts of documents and sections that hold an anchor."""
    return parts.join(anchors.select("doc", "section").distinct(), ["doc", "section"], "left_semi")

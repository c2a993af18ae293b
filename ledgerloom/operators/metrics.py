"""Margins, returns, multiples and per-share figures: column expressions over one row per issuer.

A quotient is null unless its denominator is positive; nulls propagate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ttm

TAX_RATE = 0.21
BALANCE = ("total_assets", "total_liabilities", "total_equity", "total_debt", "cash_and_equivalents", "shares_outstanding")


def ratio(num: Column, den: Column, places: int = 4, percent: bool = False) -> Column:
    q = F.when(den > 0, num / den)
    return F.round(q * 100 if percent else q, places)


def inputs(facts: DataFrame, market: DataFrame | None = None, cascade: DataFrame | None = None) -> DataFrame:
    """One row per issuer: the cascade's flows (FY0's if it has no revenue), the latest balance and the market snapshot."""
    flows = (ttm.cascade(facts) if cascade is None else cascade).select("ticker", "metodo", "rejected", *ttm.SUMMABLE)
    base = ttm.fy0(facts).select("ticker", F.struct(*ttm.SUMMABLE).alias("f0"))
    j = flows.join(base, "ticker", "left").join(ttm.latest_balance(facts, BALANCE).drop("period_key", "year"), "ticker", "left")
    whole = F.col("ingresos").isNotNull()
    j = j.withColumns({c: F.when(whole, F.col(c)).otherwise(F.col(f"f0.{c}")) for c in ttm.SUMMABLE}).drop("f0")
    if market is None:
        return j.withColumns({"market_cap": F.lit(None).cast("double"), "shares": F.col("shares_outstanding")})
    m = market.select("ticker", F.nullif("market_cap", F.lit(0.0)).alias("market_cap"), F.nullif("shares", F.lit(0.0)).alias("m_shares"))
    return j.join(m, "ticker", "left").withColumn("shares", F.coalesce("m_shares", "shares_outstanding")).drop("m_shares")


def derived(inputs: DataFrame) -> DataFrame:
    """All metrics of inputs()."""
    c = F.col
    df = inputs.withColumns({
        "fcf": c("cfo") - F.abs("capex"),
        "ev": c("market_cap") + c("total_debt") - c("cash_and_equivalents"),
        "net_debt": c("total_debt") - c("cash_and_equivalents"),
    })
    gross = F.coalesce(c("gross_profit"), c("ingresos") - c("cost_of_revenue"))
    return df.select(
        "ticker", "metodo", "rejected", "fcf", "ev", "net_debt",
        ratio(gross, c("ingresos"), 2, True).alias("gross_margin_pct"),
        ratio(c("ebit"), c("ingresos"), 2, True).alias("operating_margin_pct"),
        ratio(c("net_income"), c("ingresos"), 2, True).alias("net_margin_pct"),
        ratio(c("fcf"), c("ingresos"), 2, True).alias("fcf_margin_pct"),
        ratio(c("ebit") * (1 - TAX_RATE), c("total_debt") + c("total_equity"), 2, True).alias("roic_pct"),
        ratio(c("net_income"), c("total_equity"), 2, True).alias("roe_pct"),
        ratio(c("net_income"), c("total_assets"), 2, True).alias("roa_pct"),
        ratio(c("ev"), c("ebit")).alias("ev_ebit"),
        ratio(c("ev"), c("fcf")).alias("ev_fcf"),
        ratio(c("market_cap"), c("fcf")).alias("p_fcf"),
        ratio(c("fcf"), c("market_cap"), 4, True).alias("fcf_yield_pct"),
        ratio(c("net_income"), c("shares")).alias("eps"),
        ratio(c("fcf"), c("shares")).alias("fcf_per_share"),
        ratio(c("total_equity"), c("shares")).alias("bv_per_share"),
    )


def derive_missing(facts: DataFrame, excluded: DataFrame) -> DataFrame:
    """(ticker, period_key, field, value) of the derived fields that a period lacks.

    ebitda is ebit and depreciation_amortization, fcf is cfo less the size of capex; a value that exists stays, one of whose
    parts is missing isn't made, and those of excluded (ticker, period_key, field) are left out.
    """
    made = {"ebitda": F.col("ebit") + F.col("depreciation_amortization"), "fcf": F.col("cfo") - F.abs("capex")}
    every = F.array(*[F.struct(F.lit(f).alias("field"), F.when(F.col(f).isNull(), v).alias("value")) for f, v in made.items()])
    out = facts.select("ticker", "period_key", F.explode(every).alias("x")).select("ticker", "period_key", "x.*")
    return out.where("value is not null").join(excluded, ["ticker", "period_key", "field"], "left_anti")

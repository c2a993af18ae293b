"""Quality gates of an issuer: (ticker, gate, status, critical) rows, confidence and overall status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Gate names with their criticality, in order.
GATES = {"BALANCE_IDENTITY": True, "CASHFLOW_IDENTITY": True, "UNIDADES_SANITY": False, "EV_SANITY": False, "MARGIN_SANITY": False, "TTM_SANITY": False, "TTM_CONSECUTIVE": True, "RECENCY_SANITY": False, "DATA_COMPLETENESS": False}
# Percent ranges (low, high) of gross, operating and net margins by sector.
SECTOR_MARGINS = {
    "default": ((-10, 90), (-50, 60), (-100, 50)),
    "Software": ((50, 95), (-30, 55), (-50, 45)),
    "SaaS": ((55, 95), (-40, 50), (-60, 40)),
    "Semiconductors": ((30, 80), (-20, 55), (-30, 50)),
    "Technology Hardware": ((15, 65), (-15, 35), (-25, 30)),
    "Biotechnology": ((40, 95), (-200, 50), (-250, 45)),
    "Pharmaceuticals": ((50, 90), (-30, 50), (-40, 40)),
    "Medical Devices": ((40, 80), (-20, 40), (-30, 35)),
    "Healthcare Services": ((10, 60), (-15, 25), (-20, 20)),
    "Retail": ((15, 55), (-10, 20), (-15, 15)),
    "Consumer Staples": ((20, 60), (0, 25), (-5, 20)),
    "Restaurants": ((20, 70), (-10, 25), (-15, 18)),
    "Industrials": ((15, 55), (-10, 25), (-15, 20)),
    "Energy": ((10, 70), (-30, 40), (-40, 30)),
    "Mining": ((10, 65), (-25, 45), (-35, 35)),
    "Financial Services": ((20, 95), (-20, 55), (-25, 45)),
    "Insurance": ((10, 60), (-10, 30), (-15, 25)),
    "REITs": ((20, 80), (-10, 50), (-15, 40)),
    "Telecom": ((30, 70), (-10, 35), (-20, 25)),
    "Media & Entertainment": ((25, 75), (-20, 35), (-30, 30)),
}
# The canonical fields.
CANONICAL = ("ingresos", "cost_of_revenue", "gross_profit", "ebitda", "ebit", "net_income", "eps_basic", "eps_diluted", "total_assets", "total_liabilities", "total_equity", "cash_and_equivalents", "total_debt", "cfo", "capex", "fcf", "dividends_per_share", "shares_outstanding", "research_and_development", "sga", "depreciation_amortization", "interest_expense", "income_tax", "cfi", "cff", "delta_cash", "accounts_receivable", "inventories", "accounts_payable")
UNIT_FIELDS = ("ingresos", "ebit", "net_income", "cfo")


#: The order of an issuer's years.
LATEST = ("end_date", "period_key")


def _balance_part() -> tuple[Column, Column]:
    """What the balance gate looks at, and whether a year has any of it."""
    return F.struct("total_assets", "total_liabilities", "total_equity"), F.coalesce("total_assets", "total_liabilities", "total_equity").isNotNull()


def _balance_status(r: Column) -> Column:
    a, li, e = r["total_assets"], r["total_liabilities"], r["total_equity"]
    none = F.coalesce(a, li, e).isNull()
    a, li, e = F.coalesce(a, li + e), F.coalesce(li, a - e), F.coalesce(e, a - li)
    diff = F.try_divide(F.abs(a - (li + e)), F.abs(li + e))
    return F.when(none, "SKIP").when(a.isNull() | li.isNull() | e.isNull(), "FAIL").when(li + e == 0, "SKIP").when(diff <= 0.02, "PASS").otherwise("FAIL")


def _cash_part() -> tuple[Column, Column]:
    whole = F.col("cfo").isNotNull() & F.col("cfi").isNotNull() & F.col("cff").isNotNull()
    return F.struct((F.col("cfo") + F.col("cfi") + F.col("cff")).alias("bridge"), "delta_cash"), whole


def _cash_status(r: Column) -> Column:
    diff = F.abs(r["bridge"] - r["delta_cash"])
    size = F.greatest(F.abs(r["delta_cash"]), F.abs(r["bridge"]), F.lit(1.0))
    small = diff <= F.greatest(F.lit(50000.0), size * 0.005)
    return F.when(r["delta_cash"].isNull(), "SKIP").when((diff / size <= 0.05) | small, "PASS").when(diff / size <= 0.10, "WARNING").otherwise("FAIL")


def balance_identity(facts: DataFrame) -> DataFrame:
    """Assets are liabilities and equity within 2 %, in the latest year with any of them; one missing part is imputed."""
    part, holds = _balance_part()
    r = facts.where("period_type = 'annual'").groupBy("ticker").agg(F.max_by(part, F.when(holds, F.struct(*LATEST))).alias("r"))
    return r.select("ticker", _balance_status(F.col("r")).alias("status"))


def cashflow_identity(facts: DataFrame) -> DataFrame:
    """cfo + cfi + cff is the change of cash: 5 % or a small amount passes, 10 % warns; the latest year with all three."""
    part, holds = _cash_part()
    r = facts.where("period_type = 'annual'").where(holds).groupBy("ticker").agg(F.max_by(part, F.struct(*LATEST)).alias("r"))
    return r.select("ticker", _cash_status(F.col("r")).alias("status"))


def yoy(facts: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(ticker, period_key, field, ratio): size of a year's value in that of the year before it."""
    w = W.partitionBy("ticker").orderBy("end_date", "period_key")
    each = facts.where("period_type = 'annual'").select("ticker", "period_key", *[F.when(F.lag(c).over(w) != 0, F.abs(F.col(c) / F.lag(c).over(w))).alias(c) for c in fields])
    return each.unpivot(["ticker", "period_key"], list(fields), "field", "ratio").where("ratio is not null")


def unit_jumps(facts: DataFrame) -> DataFrame:
    """No value 1000 times larger or smaller than the year before."""
    bad = yoy(facts, UNIT_FIELDS).groupBy("ticker").agg(F.bool_or((F.col("ratio") >= 1000) | (F.col("ratio") <= 0.001)).alias("bad"))
    return bad.select("ticker", F.when(F.col("bad"), "FAIL").otherwise("PASS").alias("status"))


def margin_sanity(metrics: DataFrame, sectors: DataFrame | None = None) -> DataFrame:
    """Margins lie in their sector's ranges (ticker, sector), else in the default ones."""
    spark = metrics.sparkSession
    ranges = spark.createDataFrame([(s, *[x for r in v for x in r]) for s, v in SECTOR_MARGINS.items()], "sector string, g0 int, g1 int, o0 int, o1 int, n0 int, n1 int")
    m = metrics.withColumn("sector", F.lit("default")) if sectors is None else metrics.join(sectors, "ticker", "left")
    known = ranges.select("sector").withColumn("known", F.lit(True))
    m = m.join(F.broadcast(known), "sector", "left").withColumn("sector", F.when(F.col("known"), F.col("sector")).otherwise("default"))
    m = m.join(F.broadcast(ranges), "sector")
    off = reduce(lambda x, y: x | y, [F.coalesce(~F.col(c).between(F.col(f"{k}0"), F.col(f"{k}1")), F.lit(False)) for c, k in (("gross_margin_pct", "g"), ("operating_margin_pct", "o"), ("net_margin_pct", "n"))])
    return m.select("ticker", F.when(off, "WARNING").otherwise("PASS").alias("status"))


def gates(facts: DataFrame, ttm: DataFrame, metrics: DataFrame, as_of_year: int, sectors: DataFrame | None = None) -> DataFrame:
    """(ticker, gate, critical, status) of every issuer of facts and every gate."""
    annual, order = F.col("period_type") == "annual", F.struct(*LATEST)
    w = W.partitionBy("ticker", "period_type").orderBy(*LATEST)
    jumps = F.array(*[F.when(F.lag(c).over(w) != 0, F.abs(F.col(c) / F.lag(c).over(w))) for c in UNIT_FIELDS])
    (balance, has_balance), (cash, has_cash) = _balance_part(), _cash_part()
    filled = sum((F.count(c) for c in CANONICAL if c in facts.columns), F.lit(0))
    # all that is asked of an issuer's facts, in one aggregate
    own = facts.withColumn("jump", F.exists(jumps, lambda x: (x >= 1000) | (x <= 0.001))).groupBy("ticker").agg(
        F.max_by(balance, F.when(annual & has_balance, order)).alias("balance"),
        F.max_by(cash, F.when(annual & has_cash, order)).alias("cash"),
        F.coalesce(F.bool_or(annual & F.col("jump")), F.lit(False)).alias("jumped"),
        F.max(F.when(annual, F.col("year"))).alias("base"),
        F.max_by("ingresos", F.when(annual, order)).alias("fy0"),
        (filled / (F.count("*") * len(CANONICAL)) * 100).alias("pct"),
    )
    margins = margin_sanity(metrics, sectors).withColumnRenamed("status", "margin")
    t = own.join(ttm.select("ticker", "metodo", "rejected", "ingresos"), "ticker", "left").join(metrics.select("ticker", "ev"), "ticker", "left").join(margins, "ticker", "left")
    none = F.coalesce(F.col("metodo"), F.lit("no_disponible")) == "no_disponible"
    ratio = F.when(F.col("fy0") != 0, F.col("ingresos") / F.col("fy0"))
    wide = t.select(
        "ticker",
        F.when(F.col("balance").isNull(), "SKIP").otherwise(_balance_status(F.col("balance"))).alias("BALANCE_IDENTITY"),
        F.when(F.col("cash").isNull(), "SKIP").otherwise(_cash_status(F.col("cash"))).alias("CASHFLOW_IDENTITY"),
        F.when(F.col("jumped"), "FAIL").otherwise("PASS").alias("UNIDADES_SANITY"),
        F.when(F.col("ev").isNull(), "SKIP").when(F.col("ev") >= 0, "PASS").otherwise("WARNING").alias("EV_SANITY"),
        F.coalesce("margin", F.lit("PASS")).alias("MARGIN_SANITY"),
        F.when(none | ratio.isNull(), "SKIP").when(ratio.between(0.5, 2.0), "PASS").otherwise("WARNING").alias("TTM_SANITY"),
        F.when(none, "SKIP").when((F.col("metodo") == "FY0_fallback") & F.col("rejected"), "WARNING").otherwise("PASS").alias("TTM_CONSECUTIVE"),
        F.when(F.col("base").isNull(), "SKIP").when(as_of_year - F.col("base") > 2, "WARNING").otherwise("PASS").alias("RECENCY_SANITY"),
        F.when(F.col("pct") >= 50, "PASS").otherwise("WARNING").alias("DATA_COMPLETENESS"),
    )
    critical = F.col("gate").isin([g for g, c in GATES.items() if c])
    return wide.unpivot(["ticker"], list(GATES), "gate", "status").select("ticker", "gate", critical.alias("critical"), "status")


def completeness(facts: DataFrame) -> DataFrame:
    filled = sum((F.count(c) for c in CANONICAL if c in facts.columns), F.lit(0))
    return facts.groupBy("ticker").agg(filled.cast("long").alias("present"), (F.count("*") * len(CANONICAL)).alias("total")).withColumn("completeness_pct", F.round(F.col("present") * 100.0 / F.col("total"), 1))


def summary(gates: DataFrame) -> DataFrame:
    """(ticker, confidence, status, n_fail, n_warning, n_skip)."""
    n = lambda s: F.count_if(F.col("status") == s)
    out = gates.groupBy("ticker").agg(n("FAIL").alias("n_fail"), n("WARNING").alias("n_warning"), n("SKIP").alias("n_skip"), F.bool_or(F.col("critical") & F.col("status").isin("FAIL", "SKIP")).alias("bad"))
    confidence = F.greatest(F.lit(0), F.least(F.lit(100), 100 - 15 * F.col("n_fail") - 5 * F.col("n_warning") - 10 * F.col("n_skip"))).cast("long")
    overall = F.when(F.col("bad"), "FAIL").when((F.col("n_fail") > 0) | (F.col("n_warning") > 0), "PARTIAL").otherwise("PASS")
    return out.select("ticker", confidence.alias("confidence"), overall.alias("status"), "n_fail", "n_warning", "n_skip")


def sanity(facts: DataFrame) -> DataFrame:
    """(ticker, period_key, field, warning): positive capex, negative revenue, gross profit over revenue, tenfold jumps."""
    def row(cond, field, warning):
        return F.when(cond, F.struct(F.lit(field).alias("field"), F.lit(warning).alias("warning")))

    checks = F.array_compact(F.array(row(F.col("capex") > 0, "capex", "capex_positive"), row(F.col("ingresos") < 0, "ingresos", "revenue_negative"), row((F.col("ingresos") > 0) & (F.col("gross_profit") > F.col("ingresos")), "gross_profit", "gp_gt_revenue")))
    own = facts.select("ticker", "period_key", F.explode(checks).alias("w")).select("ticker", "period_key", "w.*")
    jumps = yoy(facts, ("ingresos", "net_income", "total_assets")).where("ratio > 10").select("ticker", "period_key", "field", F.lit("yoy_jump").alias("warning"))
    return own.unionByName(jumps)


def capex_fixed(facts: DataFrame) -> DataFrame:
    """Positive capex turned negative, the one repair that the sanity checks make."""
    return facts.withColumn("capex", F.when(F.col("capex") > 0, -F.col("capex")).otherwise(F.col("capex")))

"""Trailing twelve months from period facts.

``facts`` has a row per (ticker, period_key) with period_type, year, ord, end_date and one column per field. Every function is
a DataFrame -> DataFrame step; all shuffles are by ticker, so issuers never meet in one task unless their key does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SUMMABLE = ("ingresos", "ebit", "net_income", "cfo", "capex", "gross_profit", "cost_of_revenue")
FY0_KEYS = ("ingresos", "ebit", "net_income", "cfo", "capex")
# Days between neighbouring quarter ends, and over four quarters.
GAP_DAYS, SPAN_DAYS = (30, 120), (240, 460)
META = ("ticker", "period_key", "period_type", "year", "ord", "end_date")


def synthetic_q4(facts: DataFrame) -> DataFrame:
    """Q4 rows (FY less Q1..Q3) of years that have these four but no Q4; revenue must be there."""
    quarters = facts.where("period_type = 'quarterly'")
    per_year = quarters.groupBy("ticker", "year").agg(
        F.bit_or(F.expr("shiftleft(1, ord)")).alias("have"),
        *[F.when(F.count(F.when(F.col("ord") <= 3, F.col(c))) == 3, F.sum(F.when(F.col("ord") <= 3, F.col(c)))).alias(f"q_{c}") for c in SUMMABLE],
    )
    made = facts.where("period_type = 'annual'").join(per_year, ["ticker", "year"]).where("have = 14")  # Q1, Q2, Q3 and no Q4
    out = made.select(
        "ticker", F.concat(F.lit("Q4-"), F.col("year").cast("string")).alias("period_key"), F.lit("quarterly").alias("period_type"), "year", F.lit(4).alias("ord"),
        F.make_date("year", F.lit(12), F.lit(31)).alias("end_date"), *[(F.col(c) - F.col(f"q_{c}")).alias(c) for c in SUMMABLE],
    )
    return out.where("ingresos is not null")


def quarters(facts: DataFrame) -> DataFrame:
    """Quarterly rows with the synthetic ones; ``synthetic`` tells them apart."""
    have = facts.where("period_type = 'quarterly'").select(*META, *SUMMABLE, F.lit(False).alias("synthetic"))
    return have.unionByName(synthetic_q4(facts).withColumn("synthetic", F.lit(True)))


def last_four(facts: DataFrame) -> DataFrame:
    """One row per issuer with quarters: how many, whether the last four are consecutive, and their all-or-nothing sums."""
    late = W.partitionBy("ticker").orderBy(F.desc("end_date"), F.desc("period_key"))
    q = quarters(facts).withColumn("back", F.row_number().over(late)).where("back <= 4")
    q = q.withColumn("gap", F.datediff(F.lag("end_date").over(late), F.col("end_date")))
    return q.groupBy("ticker").agg(
        F.count("*").alias("n"),
        F.max("end_date").alias("end_date"),
        F.bool_or("synthetic").alias("has_synthetic"),
        (F.bool_and(F.coalesce(F.col("gap").between(*GAP_DAYS), F.lit(True))) & F.datediff(F.max("end_date"), F.min("end_date")).between(*SPAN_DAYS)).alias("consecutive"),
        *[F.when(F.count(c) == 4, F.sum(c)).alias(c) for c in SUMMABLE],
    )


def four_quarters(facts: DataFrame) -> DataFrame:
    """The rolling sum of four consecutive quarters."""
    return last_four(facts).where("n = 4 and consecutive").select("ticker", "end_date", "has_synthetic", *SUMMABLE)


def semestral(facts: DataFrame) -> DataFrame:
    """FY(y-1) + H1(y) - H1(y-1) from the two latest first halves, if ebit and cfo are in all three."""
    h1 = facts.where("period_type = 'semestral' and ord = 1")
    late = W.partitionBy("ticker").orderBy(F.desc("end_date"), F.desc("period_key"))
    pair = h1.withColumn("back", F.row_number().over(late)).where("back <= 2")
    new = pair.where("back = 1").select("ticker", F.col("year").alias("y"), "end_date", *[F.col(c).alias(f"n_{c}") for c in SUMMABLE])
    old = pair.where("back = 2").select("ticker", F.col("year").alias("y_old"), *[F.col(c).alias(f"o_{c}") for c in SUMMABLE])
    fy = facts.where("period_type = 'annual'").select("ticker", F.col("year").alias("y_fy"), *[F.col(c).alias(f"f_{c}") for c in SUMMABLE])
    both = new.join(old, "ticker").where("y - y_old = 1").join(fy, "ticker").where("y_fy = y_old")
    both = both.where(" and ".join(f"{p}_{c} is not null" for p in "nof" for c in ("ebit", "cfo")))
    return both.select("ticker", "end_date", *[(F.col(f"f_{c}") + F.col(f"n_{c}") - F.col(f"o_{c}")).alias(c) for c in SUMMABLE])


def fy0(facts: DataFrame) -> DataFrame:
    """The latest annual row with revenue and three of the five key fields."""
    filled = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in FY0_KEYS[1:]), F.when(F.col(FY0_KEYS[0]).isNotNull(), 1).otherwise(0))
    good = facts.where("period_type = 'annual' and ingresos is not null").where(filled >= 3)
    return good.groupBy("ticker").agg(F.max_by(F.struct("period_key", "year", "end_date", *SUMMABLE), F.struct("end_date", "period_key")).alias("r")).select("ticker", "r.*")


def cascade(facts: DataFrame) -> DataFrame:
    """(ticker, metodo, end_date, rejected, fields): four quarters, else (or if only revenue is there) semestral, else FY0."""
    issuers = facts.select("ticker").distinct()
    four = last_four(facts)
    ok = F.col("n4") & F.col("consecutive")
    sparse = F.col("q.ingresos").isNotNull() & F.col("q.ebit").isNull() & F.col("q.net_income").isNull() & F.col("q.cfo").isNull()
    j = issuers.join(four.select("ticker", (F.col("n") == 4).alias("n4"), "consecutive", F.struct("end_date", *SUMMABLE).alias("q")), "ticker", "left")
    j = j.join(semestral(facts).select("ticker", F.struct("end_date", *SUMMABLE).alias("s")), "ticker", "left")
    j = j.join(fy0(facts).select("ticker", F.struct("end_date", *SUMMABLE).alias("f")), "ticker", "left")
    by_quarters = F.coalesce(ok, F.lit(False))
    use_s = F.col("s").isNotNull() & (~by_quarters | sparse)
    chosen = F.when(use_s, F.col("s")).when(by_quarters, F.col("q")).otherwise(F.col("f"))
    method = F.when(use_s, "semestral_FY_H1").when(by_quarters, "suma_4_trimestres").when(F.col("f").isNotNull(), "FY0_fallback").otherwise("no_disponible")
    rejected = F.coalesce(F.col("n4") & ~F.col("consecutive"), F.lit(False))
    return j.select("ticker", method.alias("metodo"), rejected.alias("rejected"), chosen.alias("c")).select("ticker", "metodo", "rejected", "c.*")


def latest_balance(facts: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """The annual row with the latest end."""
    return facts.where("period_type = 'annual'").groupBy("ticker").agg(F.max_by(F.struct("period_key", "year", *fields), F.struct("end_date", "period_key")).alias("r")).select("ticker", "r.*")


def islands(facts: DataFrame, at_least: int = 1) -> DataFrame:
    """(ticker, first_year, last_year, n): runs of consecutive annual years."""
    years = facts.where("period_type = 'annual'").select("ticker", "year").distinct()
    grouped = years.withColumn("run", F.col("year") - F.row_number().over(W.partitionBy("ticker").orderBy("year")))
    return grouped.groupBy("ticker", "run").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count("*").alias("n")).drop("run").where(F.col("n") >= at_least)

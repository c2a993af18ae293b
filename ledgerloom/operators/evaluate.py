"""Accuracy against curated truth, and diagnosis of what is missing or wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEY = ["ticker", "period_key", "field"]
# Statement category of each field; others are "other".
CATEGORY = {"ingresos": "income_statement", "cost_of_revenue": "income_statement", "gross_profit": "income_statement", "ebit": "income_statement", "net_income": "income_statement", "cfo": "cash_flow", "capex": "cash_flow", "cfi": "cash_flow", "cff": "cash_flow", "delta_cash": "cash_flow", "total_assets": "balance_sheet", "total_liabilities": "balance_sheet", "total_equity": "balance_sheet", "total_debt": "balance_sheet", "cash_and_equivalents": "balance_sheet", "shares_outstanding": "per_share"}


def matches(actual: Column, expected: Column, tolerance: float = 0.01) -> Column:
    return F.when(expected == 0, F.abs(actual) < 0.01).otherwise(F.abs(actual - expected) / F.abs(expected) <= tolerance)


def detail(truth: DataFrame, facts: DataFrame) -> DataFrame:
    """truth (ticker, period_key, period_type, field, expected) with the value found and matched, wrong or missed."""
    j = truth.where("expected is not null").join(facts.select(*KEY, F.col("value").alias("actual")), KEY, "left")
    status = F.when(F.col("actual").isNull(), "missed").when(matches(F.col("actual"), F.col("expected")), "matched").otherwise("wrong")
    return j.select(*KEY, "period_type", "expected", "actual", status.alias("status"))


def extra(truth: DataFrame, facts: DataFrame) -> DataFrame:
    return facts.join(truth, KEY, "left_anti").select(*KEY, "value")


def report(truth: DataFrame, facts: DataFrame) -> DataFrame:
    """One row per issuer of truth: counts, score and coverage in percent."""
    n = lambda s: F.count_if(F.col("status") == s)
    d = detail(truth, facts).groupBy("ticker").agg(F.count("*").alias("expected"), n("matched").alias("matched"), n("wrong").alias("wrong"), n("missed").alias("missed"))
    e = extra(truth, facts).groupBy("ticker").agg(F.count("*").alias("extra"))
    j = d.join(e, "ticker", "left").withColumn("extra", F.coalesce("extra", F.lit(0)))
    return j.withColumns({"score": F.round(F.col("matched") * 100.0 / F.col("expected"), 2), "coverage": F.round((F.col("matched") + F.col("wrong")) * 100.0 / F.col("expected"), 2)})


def readiness(report: DataFrame, confidence: DataFrame, provenance: DataFrame) -> DataFrame:
    """0.4 score + 0.2 coverage + 0.2 confidence + 0.2 provenance, less 15 at most for extra values; never below 0."""
    j = report.join(confidence.select("ticker", "confidence"), "ticker", "left").join(provenance.select("ticker", "provenance"), "ticker", "left")
    loss = F.least(F.lit(15.0), F.col("extra") * 100.0 / F.col("expected"))
    raw = F.col("score") * 0.4 + F.col("coverage") * 0.2 + F.coalesce("confidence", F.lit(0)) * 0.2 + F.coalesce("provenance", F.lit(0.0)) * 0.2 - loss
    return j.select("ticker", F.round(F.greatest(F.lit(0.0), raw), 2).alias("readiness"))


def provenance(detail: DataFrame, origins: DataFrame) -> DataFrame:
    """(ticker, provenance): percent of the values found for truth whose filing and method are both known; origins: (KEY, filing, method)."""
    named = (F.coalesce("filing", F.lit("")) != "") & (F.coalesce("method", F.lit("")) != "")
    j = detail.where("actual is not null").select(*KEY).join(origins.select(*KEY, named.alias("named")), KEY, "left")
    return j.groupBy("ticker").agg(F.round(F.count_if("named") * 100.0 / F.count("*"), 2).alias("provenance"))


def gaps(detail: DataFrame) -> DataFrame:
    """The details that aren't matched, with category and the share of missed values in their period."""
    period = W.partitionBy("ticker", "period_key")
    category = F.when(F.lit(False), "")
    for f, c in CATEGORY.items():
        category = category.when(F.col("field") == f, c)
    rate = F.count_if(F.col("status") == "missed").over(period) / F.count("*").over(period)
    return detail.withColumns({"miss_rate": rate, "category": category.otherwise("other")}).where("status <> 'matched'")


def root_cause(gaps: DataFrame) -> DataFrame:
    """(field, status, n, tickers, root_cause) of each kind of gap.

    Wrong values: the upper median of actual / expected over the first three examples; missed ones: whether their periods miss
    more than half of their values in six of ten cases.
    """
    ratio = F.when(F.col("expected") != 0, F.col("actual") / F.col("expected"))
    order = F.struct("ticker", "period_key", ratio.alias("ratio"))
    g = gaps.groupBy("field", "status").agg(F.count("*").alias("n"), F.count_distinct("ticker").alias("tickers"), F.avg((F.col("miss_rate") > 0.5).cast("double")).alias("many"), F.slice(F.array_sort(F.collect_list(order)), 1, 3).alias("some"))
    ratios = F.array_sort(F.filter(F.transform("some", lambda s: s["ratio"]), lambda r: r.isNotNull()))
    median = F.when(F.size(ratios) > 0, F.element_at(ratios, F.floor(F.size(ratios) / 2).cast("int") + 1))
    cause = (
        F.when((F.col("status") == "missed") & (F.col("many") >= 0.6), "period_mapping_failure")
        .when(F.col("status") == "missed", "missing_extraction")
        .when(median.between(900, 1100), "scale_1k")
        .when(median.between(0.0009, 0.0011), "scale_001")
        .when(median.between(45000, 110000), "scale_100k")
        .when(median.between(90, 110), "scale_100")
        .when(median.between(-1.05, -0.95), "sign_mismatch")
        .otherwise("value_deviation")
    )
    return g.select("field", "status", "n", "tickers", cause.alias("root_cause"))


def hotspots(gaps: DataFrame) -> DataFrame:
    """(rank, field, status, n, tickers): kinds of gaps by how often they occur."""
    g = gaps.groupBy("field", "status").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("ticker")).alias("of"))
    # the groups are as many as fields and kinds, so one ordered window over them is small
    rank = F.row_number().over(W.orderBy(F.desc("n"), "field", "status"))
    return g.select(rank.alias("rank"), "field", "status", "n", F.array_join("of", ",").alias("tickers"))


def gap_sets(gaps: DataFrame) -> DataFrame:
    """Counts by period type, by category and by status in one pass over grouping sets."""
    g = gaps.groupingSets([["period_type"], ["category"], ["status"]], "period_type", "category", "status")
    return g.agg(F.count("*").alias("n"), F.count_distinct("ticker").alias("tickers"))


def dashboard(report: DataFrame) -> DataFrame:
    """A row per issuer and a TOTAL row; the score of the total is matched over expected."""
    r = report.rollup("ticker").agg(F.sum("expected").alias("expected"), F.sum("matched").alias("matched"), F.sum("wrong").alias("wrong"), F.sum("missed").alias("missed"), F.sum("extra").alias("extra"))
    return r.select(F.coalesce("ticker", F.lit("TOTAL")).alias("ticker"), "expected", "matched", "wrong", "missed", "extra", F.round(F.col("matched") * 100.0 / F.col("expected"), 2).alias("score"))


def draft_vs_truth(draft: DataFrame, truth: DataFrame) -> DataFrame:
    """Per issuer: periods and fields in both, only in the draft, only in the truth; values that agree."""
    j = draft.select(*KEY, F.col("value").alias("d")).join(truth.select(*KEY, F.col("expected").alias("t")), KEY, "full")
    return j.groupBy("ticker").agg(
        F.count_if(F.col("d").isNotNull() & F.col("t").isNotNull()).alias("common"),
        F.count_if(F.col("t").isNull()).alias("only_draft"),
        F.count_if(F.col("d").isNull()).alias("only_truth"),
        F.count_if(F.coalesce(matches(F.col("d"), F.col("t")), F.lit(False))).alias("agree"),
    )


def signature(rows: DataFrame, plain: tuple[str, ...] = ()) -> DataFrame:
    """A hash of a result that doesn't depend on the order of its rows: hashes of rows, summed and hashed again.

    A row's text is JSON with sorted keys and no spaces; the columns of plain are numbers as text already. Summing keeps it a
    plain distributed aggregate, where hashing one sorted text would bring all rows together.
    """
    shown = [F.concat(F.lit(f'"{c}":'), F.coalesce(F.col(c), F.lit("null")) if c in plain else F.coalesce(F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"')), F.lit("null"))) for c in sorted(rows.columns)]
    one = F.sha2(F.encode(F.concat(F.lit("{"), F.concat_ws(",", *shown), F.lit("}")), "UTF-8"), 256)
    part = F.conv(F.substring(one, 1, 12), 16, 10).cast("decimal(38,0)")
    return rows.select(part.alias("h")).agg(F.count("*").alias("n"), F.sha2(F.encode(F.concat_ws(":", F.count("*").cast("string"), F.sum("h").cast("string")), "UTF-8"), 256).alias("signature"))

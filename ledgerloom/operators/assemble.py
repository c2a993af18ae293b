"""Nested outputs: one JSON text per issuer, provenance pointers and contract checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _by_key(a, b):
    return F.when(a["period_key"] < b["period_key"], -1).when(a["period_key"] > b["period_key"], 1).otherwise(0)


def truth_pack(long_facts: DataFrame, derived: DataFrame, gates: DataFrame) -> DataFrame:
    """(ticker, pack): facts by period and field, metrics and gates as JSON; nulls are left out."""
    by_period = long_facts.groupBy("ticker", "period_key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "value")))).alias("fields"))
    periods = by_period.groupBy("ticker").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("period_key", F.struct("fields").alias("p"))), _by_key)).alias("periods"))
    quality = gates.groupBy("ticker").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("gate", "status")))).alias("quality"))
    metrics = derived.select("ticker", F.struct(*[c for c in derived.columns if c != "ticker"]).alias("derived"))
    j = periods.join(metrics, "ticker", "left").join(quality, "ticker", "left")
    return j.select("ticker", F.to_json(F.struct(F.lit("1.0").alias("schema_version"), "ticker", "periods", "derived", "quality")).alias("pack"))


def extraction_result(long_facts: DataFrame) -> DataFrame:
    """(ticker, payload): what was extracted from an issuer's filings as JSON, periods and fields in order of their names."""
    year, part = F.right("period_key", F.lit(4)), F.left("period_key", F.lit(2))
    month_end = F.when(part == "Q1", "-03-31").when(part.isin("Q2", "H1"), "-06-30").when(part == "Q3", "-09-30").otherwise("-12-31")
    kind = F.when(part == "FY", "anual").when(part.startswith("Q"), "trimestral").when(part.startswith("H"), "semestral").otherwise("unknown")
    fields = F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "value"))))
    p = long_facts.groupBy("ticker", "period_key").agg(fields.alias("fields")).withColumns({"fecha_fin": F.concat(year, month_end), "tipo_periodo": kind})
    one = F.struct("period_key", F.struct("fecha_fin", "tipo_periodo", "fields").alias("p"))
    periods = p.groupBy("ticker").agg(F.map_from_entries(F.array_sort(F.collect_list(one), _by_key)).alias("periods"))
    return periods.select("ticker", F.to_json(F.struct("ticker", "periods")).alias("payload"))


def line_pointer(docs: DataFrame, needles: DataFrame) -> DataFrame:
    """(id, needle, line, col): where a value first stands in its text, both from 1; null if it doesn't."""
    j = needles.join(docs, "id")
    at = F.instr("text", F.col("needle"))
    before = F.substring("text", F.lit(1), at - 1)
    return j.select("id", "needle", F.when(at > 0, F.regexp_count(before, F.lit("\n")) + 1).alias("line"), F.when(at > 0, F.length(F.substring_index(before, "\n", -1)) + 1).alias("col"))


def violations(long_facts: DataFrame, allowed: list[str]) -> DataFrame:
    """(ticker, period_key, field, rule): rows that break the contract of facts."""
    rules = F.array_compact(F.array(
        F.when(~F.col("period_key").rlike(r"^(FY\d{4}|Q[1-4]-\d{4}|H[12]-\d{4})$"), "bad_period"),
        F.when(~F.col("field").isin(allowed), "unknown_field"),
        F.when(F.col("value").isNull() | F.isnan("value"), "no_value"),
        F.when((F.col("field") == "capex") & (F.col("value") > 0), "capex_positive"),
        F.when(F.col("field").isin("ingresos", "total_assets", "shares_outstanding") & (F.col("value") < 0), "negative"),
    ))
    return long_facts.select("ticker", "period_key", "field", F.explode(rules).alias("rule"))


def drift(a: DataFrame, b: DataFrame) -> DataFrame:
    """(field, side) of names that only one of two lists has."""
    left, right = a.select("field"), b.select("field")
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))

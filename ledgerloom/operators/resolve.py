"""Choosing one value per (ticker, period, field) from many candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Merge priority by filing type; others are 4.
TYPE_PRIORITY = {"10-K": 1, "20-F": 1, "40-F": 1, "annual_report": 1, "10-Q": 2, "6-K": 2, "interim_report": 2, "8-K": 3, "earnings": 3}
# Filing ranks by the kind of period.
RANK_BY_PERIOD = {"FY": ("10-K", "20-F", "40-F", "10-Q", "8-K"), "Q": ("10-Q", "6-K", "10-K", "8-K"), "H": ("6-K", "20-F", "10-Q", "8-K")}
EPS = ("eps_basic", "eps_diluted")


def type_priority(filing_type: Column) -> Column:
    out = F.when(F.lit(False), 0)
    for t, p in TYPE_PRIORITY.items():
        out = out.when(filing_type == t, p)
    return out.otherwise(4)


def filing_rank(period_key: Column, filing_type: Column) -> Column:
    """Place of the filing type in the list of the period's kind; behind it if not listed."""
    out = F.when(F.lit(False), 0)
    for kind, types in RANK_BY_PERIOD.items():
        place = F.array_position(F.array(*map(F.lit, types)), filing_type)
        out = out.when(period_key.startswith(kind), F.when(place > 0, place - 1).otherwise(len(types)))
    return out.otherwise(99).cast("int")


def winners(candidates: DataFrame, by: tuple[str, ...], key: tuple[str, ...], value: tuple[str, ...]) -> DataFrame:
    """The candidate with the smallest key of each group: one aggregate with partial sums, no window, no ties if key is total."""
    return candidates.groupBy(*by).agg(F.min_by(F.struct(*value), F.struct(*key)).alias("w"), F.count("*").alias("n_candidates")).select(*by, "w.*", "n_candidates")


def additive(candidates: DataFrame, by: tuple[str, ...], constituent: tuple[str, ...], value: str = "value") -> DataFrame:
    """Sum of distinct constituents of additive fields: of rows with the same constituent one counts."""
    once = candidates.groupBy(*by, *constituent).agg(F.max(value).alias(value))
    return once.groupBy(*by).agg(F.sum(F.col(value).cast("decimal(20,6)")).cast("double").alias(value), F.count("*").alias("n_parts"))


def _eps_choice(e: Column, n: Column) -> Column:
    """new, existing or null for two values per share of equal priority."""
    size = F.greatest(F.abs(e["value"]), F.abs(n["value"]))
    delta = F.when((e["value"] != 0) & (n["value"] != 0), F.abs(e["value"] - n["value"]) / size)
    stray = lambda x: ~x["primary"] & (x["ixbrl"] | x["weighted"])
    return (
        F.when(e["restated"] != n["restated"], F.when(n["restated"], "new").otherwise("existing"))
        .when(e["weighted"] != n["weighted"], F.when(e["weighted"], "new").otherwise("existing"))
        .when((e["value"] * n["value"] > 0) & (delta <= 0.05), "existing")
        .when((e["primary"] != n["primary"]) & (delta >= 0.25), F.when(stray(e), "new").when(stray(n), "existing"))
    )


def merge(filings: DataFrame) -> DataFrame:
    """Fold the filings' values in order of priority, then of files, by the replacement rules.

    filings: (ticker, period_key, field, filing_type, file, file_ord, value, affinity, semantic, rescaled, restated, has_key) and,
    false where they lack, (weighted, primary, ixbrl): from a note on average shares, from the period's own filing, from tags.
    A challenger replaces the winner if its priority is better; at equal priority, if its affinity is better or, at equal
    affinity, its semantic rank is better and the winner's is positive; at worse priority, only if the winner was rescaled and it
    wasn't. Values per share of equal priority are first told apart for themselves: a restatement wins, a note on average shares
    loses, values within 5 % and of one sign stay, and of values 25 % apart the one from the period's own filing wins over tags
    and notes of others. Each challenger adds one discard.
    """
    prio = type_priority(F.col("filing_type"))
    flags = [F.col(c) if c in filings.columns else F.lit(False).alias(c) for c in ("weighted", "primary", "ixbrl")]
    one = F.struct(prio.alias("prio"), "file_ord", "file", "value", "affinity", "semantic", "rescaled", "restated", "has_key", *flags)
    grouped = filings.groupBy("ticker", "period_key", "field").agg(F.array_sort(F.collect_list(one)).alias("all"))
    eps = F.col("field").isin(*EPS)

    def step(acc: Column, n: Column) -> Column:
        e = acc["w"]
        choice = F.when(eps, _eps_choice(e, n))
        near = eps & (e["value"] * n["value"] > 0) & (F.abs(e["value"] - n["value"]) <= F.greatest(F.abs(e["value"]), F.abs(n["value"])) * 0.05)
        generic = F.when(n["affinity"] < e["affinity"], ~near).when(n["affinity"] == e["affinity"], (e["semantic"] > 0) & (n["semantic"] < e["semantic"])).otherwise(False)
        equal = e["has_key"] & n["has_key"] & F.when(choice.isNotNull(), choice == "new").otherwise(generic)
        exact = (n["prio"] > e["prio"]) & e["rescaled"] & ~n["rescaled"]
        take = F.when(n["prio"] < e["prio"], True).when(n["prio"] == e["prio"], equal).otherwise(exact)
        why = F.when(exact, F.lit("quality_override_rescaled")).otherwise(F.lit("duplicate_conflict"))
        return F.struct(F.when(take, n).otherwise(e).alias("w"), F.array_union(acc["reasons"], F.array(why)).alias("reasons"))

    start = F.struct(F.element_at("all", 1).alias("w"), F.array().cast("array<string>").alias("reasons"))
    rest = F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(1)))
    out = grouped.select("ticker", "period_key", "field", F.size("all").alias("n"), F.aggregate(F.when(F.size("all") > 1, rest).otherwise(F.slice("all", 1, 0)), start, step).alias("r"))
    return out.select("ticker", "period_key", "field", F.col("r.w.value").alias("value"), F.col("r.w.file").alias("file"), (F.col("n") - 1).cast("long").alias("n_discarded"), F.array_sort("r.reasons").alias("reasons"))


def override_missing(facts: DataFrame, manual: DataFrame) -> DataFrame:
    """Manual (ticker, period_key, field, value) where no value was found; the method tells which."""
    j = facts.select("ticker", "period_key", "field", "value").join(manual.withColumnRenamed("value", "manual"), ["ticker", "period_key", "field"], "full")
    return j.select("ticker", "period_key", "field", F.coalesce("value", "manual").alias("value"), F.when(F.col("value").isNull(), "manual").otherwise("table").alias("method"))


def mode(values: DataFrame, by: str, value: str, order: str) -> DataFrame:
    """The most frequent value of each group; of equals the one seen first."""
    n = values.groupBy(by, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return n.groupBy(by).agg(F.max_by(F.struct(value, "n"), F.struct("n", -F.col("first"))).alias("m")).select(by, "m.*")

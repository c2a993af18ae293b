"""Rules as data: layered settings, bridges that close a gap, the worst of many states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# States from best to worst.
SEVERITIES = ("ok", "warning", "error", "fatal")
# Kinds of components of a bridge, the preferred first.
BRIDGE_KINDS = ("redeemable_nci", "mezzanine_equity", "non_controlling_interest")


def layered(settings: DataFrame) -> DataFrame:
    """(scope, section, key, value) of settings (scope, layer, section, key, value); higher layers win.

    Within a section keys are replaced one by one; a row with a null key replaces all of the section's lower layers (a list or
    a plain value).
    """
    whole = settings.where("key is null").groupBy("scope", "section").agg(F.max("layer").alias("floor"))
    j = settings.join(whole, ["scope", "section"], "left").where(F.col("floor").isNull() | (F.col("layer") >= F.col("floor")))
    return j.groupBy("scope", "section", "key").agg(F.max_by("value", "layer").alias("value"))


def bridge(gaps: DataFrame, parts: DataFrame) -> DataFrame:
    """(doc, n_parts, total, kinds) of the fewest components of a document that close its gap within a thousandth, or 1.

    gaps: (doc, gap); parts: (doc, ord, kind, value). Sets of three at most are formed, step by step and in order of ord, each
    step an equi join by document; of sets of one size the one of preferred kinds wins, then the first.
    """
    # fixed places of the kinds, so that sets compare by preference
    place = F.array_position(F.array(*map(F.lit, BRIDGE_KINDS)), F.col("kind")).cast("int")
    p = parts.where(F.col("kind").isin(*BRIDGE_KINDS)).groupBy("doc", "value", place.alias("kind")).agg(F.min("ord").alias("ord"))
    wanted = gaps.where("gap > 0")
    sets = p.join(wanted, "doc").select("doc", "gap", F.array("ord").alias("ords"), F.col("value").alias("total"), F.array("kind").alias("kinds"))
    tolerance = F.greatest(F.lit(1.0), F.col("gap") * 0.001)
    found, left = None, sets
    for size in (1, 2, 3):
        hits = left.where(F.abs(F.col("total") - F.col("gap")) <= tolerance).select("doc", F.lit(size).alias("n_parts"), F.array_sort("kinds").alias("kinds"), "ords", "total")
        found = hits if found is None else found.unionByName(hits)
        if size < 3:
            more = p.select("doc", F.col("ord").alias("next"), F.col("value").alias("v"), F.col("kind").alias("k"))
            left = left.join(more, "doc").where(F.col("next") > F.element_at("ords", -1)).select("doc", "gap", F.array_append("ords", F.col("next")).alias("ords"), (F.col("total") + F.col("v")).alias("total"), F.array_append("kinds", F.col("k")).alias("kinds"))
    best = found.groupBy("doc").agg(F.min(F.struct("n_parts", "kinds", "ords", "total")).alias("b"))
    named = F.transform("b.kinds", lambda k: F.element_at(F.array(*map(F.lit, BRIDGE_KINDS)), k))
    return best.select("doc", "b.n_parts", "b.total", F.array_join(named, ",").alias("kinds"))


def worst(states: DataFrame, by: str, state: str) -> DataFrame:
    """The worst state of each group and how many states of each kind it has; what isn't known counts as ok."""
    rank = F.greatest(F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col(state)), F.lit(1))
    counts = [F.count_if(F.col(state) == s).alias(f"n_{s}") for s in SEVERITIES[1:]]
    out = states.groupBy(by).agg(F.max(rank).cast("int").alias("r"), *counts)
    return out.select(by, F.element_at(F.array(*map(F.lit, SEVERITIES)), F.col("r")).alias("severity"), *[c for c in out.columns if c.startswith("n_")])

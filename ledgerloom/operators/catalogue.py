"""Sources of an issuer: union, dedup, coverage, best candidates; joins by time, place and label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

# Least annual and total filings by class of issuer.
THRESHOLDS = {"Domestic_US": (3, 10), "FPI_ADR": (2, 5), "NonUS_Local": (1, 1)}
# How many candidates of each type stay, and of all.
PER_TYPE, OTHER_TYPES, IN_ALL = {"ANNUAL_REPORT": 4, "INTERIM_REPORT": 4, "REGULATORY_FILING": 4, "IR_NEWS": 3}, 2, 12


def union(*sources: DataFrame) -> DataFrame:
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def best_per(sources: DataFrame, key: Column, *order: Column) -> DataFrame:
    """One row per non-null key, the first by order; rows without a key all stay."""
    row = F.struct(*[c for c in sources.columns])
    # rows without a key are groups of their own, told by all they hold, and come out as often as they came in
    grouped = sources.groupBy(key.alias("_key"), F.when(key.isNull(), row).alias("_own")).agg(F.min_by(row, F.struct(*order)).alias("_row"), F.count("*").cast("int").alias("_n"))
    return grouped.select(F.explode(F.array_repeat("_row", F.when(F.col("_key").isNull(), F.col("_n")).otherwise(1))).alias("r")).select("r.*")


def dedup_content(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first document of each normalized text; texts without content are never repeats."""
    h = T.content_hash(F.col(text_col))
    return best_per(docs.select(id_col, h.alias("content_hash")), F.nullif("content_hash", F.lit("")), F.col(id_col))


def coverage_map(sources: DataFrame) -> DataFrame:
    """(ticker, category, source_id, n): the first source of each category."""
    return sources.groupBy("ticker", "category").agg(F.min("source_id").alias("source_id"), F.count("*").alias("n"))


def top_candidates(candidates: DataFrame, per_type: dict[str, int] = PER_TYPE, other: int = OTHER_TYPES, total: int = IN_ALL) -> DataFrame:
    """Best candidates by score and date: as many of each type of an issuer as per_type says, total of an issuer."""
    by = [F.desc("score"), F.desc("date"), F.col("candidate_id")]
    most = F.when(F.lit(False), 0)
    for kind, n in per_type.items():
        most = most.when(F.col("type") == kind, n)
    highest = max([other, *per_type.values()])  # lets the window stop early; the exact limit follows
    some = candidates.withColumn("n", F.row_number().over(W.partitionBy("ticker", "type").orderBy(*by))).where(F.col("n") <= highest).where(F.col("n") <= most.otherwise(other))
    return some.withColumn("n", F.row_number().over(W.partitionBy("ticker").orderBy(*by))).where(F.col("n") <= total).select("ticker", "type", "candidate_id", "score", F.col("n").alias("place"))


def issuer_class(issuers: DataFrame) -> DataFrame:
    """Domestic filers, foreign private issuers and local ones, from hint, annual form and cik."""
    c = F.when((F.col("source_hint") == "sec") & (F.col("annual_form") == "10-K"), "Domestic_US").when(F.col("source_hint") == "sec", "FPI_ADR").when(F.col("cik").isNotNull() & (F.col("cik") != ""), "FPI_ADR").otherwise("NonUS_Local")
    return issuers.withColumn("issuer_class", c)


def coverage_audit(classified: DataFrame) -> DataFrame:
    """(ticker, issuer_class, status, issues): filings (annual, total) against the class's least numbers."""
    t = classified.sparkSession.createDataFrame([(k, *v) for k, v in THRESHOLDS.items()], "issuer_class string, least_annual int, least_total int")
    j = classified.join(F.broadcast(t), "issuer_class")
    issues = F.array_compact(F.array(F.when(F.col("annual") < F.col("least_annual"), "annual_below_min"), F.when(F.col("total") < F.col("least_total"), "total_below_min")))
    return j.select("ticker", "issuer_class", F.when(F.size(issues) == 0, "PASS").otherwise("NEEDS_ACTION").alias("status"), F.array_join(issues, ",").alias("issues"))


def as_of(rows: DataFrame, marks: DataFrame, by: str, at: str, value: str, within: int | None = None) -> DataFrame:
    """Each row with the value of the last mark at or before it. One window over both; no join that multiplies."""
    both = rows.select(by, at, F.lit(1).alias("side"), F.col("row_id")).unionByName(marks.select(by, at, F.lit(0).alias("side"), F.struct(at, value).alias("m")), allowMissingColumns=True)
    w = W.partitionBy(by).orderBy(at, "side").rowsBetween(W.unboundedPreceding, 0)
    last = F.last("m", ignorenulls=True).over(w)
    out = both.withColumn("l", last).where("side = 1")
    ok = F.lit(True) if within is None else F.col(at) - F.col(f"l.{at}") <= within
    return out.select("row_id", by, at, F.when(ok, F.col(f"l.{value}")).alias(value))


def nearest(tokens: DataFrame, anchors: DataFrame, by: str) -> DataFrame:
    """Each token's nearest anchor of its line; of equals the leftmost. Anchors of a line are few columns."""
    arr = anchors.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("anchor", "period"))).alias("anchors"))
    j = tokens.join(arr, by)
    best = F.array_min(F.transform("anchors", lambda a: F.struct(F.abs(a["anchor"] - F.col("place")).alias("distance"), a["anchor"].alias("anchor"), a["period"].alias("period"))))
    return j.select("row_id", by, "place", best.alias("b")).select("row_id", by, "place", "b.distance", "b.period")


def sections(lines: DataFrame, heading: Column, most: int = 120) -> DataFrame:
    """(doc, line, section): the heading a line stands under, at most `most` lines below it."""
    w = W.partitionBy("doc").orderBy("line")
    marked = lines.withColumn("h", F.when(heading, F.struct("line", F.col("text").alias("section"))))
    held = marked.withColumn("h", F.last("h", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return held.select("doc", "line", F.when(F.col("line") - F.col("h.line") < most, F.col("h.section")).alias("section"))


def trailing(series: DataFrame, by: str, at: str, value: str, n: int) -> DataFrame:
    w = W.partitionBy(by).orderBy(at).rowsBetween(-(n - 1), 0)
    return series.select(by, at, F.avg(value).over(w).alias("mean"), F.max(value).over(w).alias("high"), F.min(value).over(w).alias("low"))


#: Least length of an alias that may be part of a label.
HEAD = 6


def resolve_aliases(labels: DataFrame, aliases: DataFrame, reject: str | None = None) -> DataFrame:
    """(label, canonical, how): exact by the normalized label, else the first alias of several words and six letters in it.

    Distinct labels are matched first, as labels repeat. For the second, the runs of HEAD characters of a label meet the beginnings
    of aliases in an equi join, so that neither side has to be small. Labels that match `reject` have no name.
    """
    n = labels.select("label").distinct().withColumn("norm", T.normalize_label(F.col("label")))
    if reject is not None:
        n = n.withColumn("norm", F.when(~F.col("label").rlike(reject), F.col("norm")))
    exact = aliases.groupBy("alias").agg(F.max_by("canonical", "ord").alias("exact"))
    several = aliases.where(F.col("alias").contains(" ") & (F.length("alias") >= HEAD)).withColumn("head", F.left("alias", F.lit(HEAD)))
    j = n.join(exact, F.col("norm") == F.col("alias"), "left").drop("alias")
    runs = F.when(F.length("norm") >= HEAD, F.transform(F.sequence(F.lit(1), F.length("norm") - HEAD + 1), lambda i: F.col("norm").substr(i, F.lit(HEAD))))
    heads = j.where("exact is null").select("label", "norm", F.explode(F.array_distinct(runs)).alias("head"))
    hit = heads.join(several, "head").where(F.expr("contains(norm, alias)")).groupBy("label").agg(F.min_by("canonical", "ord").alias("fuzzy"))
    j = j.join(hit, "label", "left")
    return j.select("label", F.coalesce("exact", "fuzzy").alias("canonical"), F.when(F.col("exact").isNotNull(), "exact").when(F.col("fuzzy").isNotNull(), "fuzzy").otherwise("none").alias("how"))


def links(pages: DataFrame) -> DataFrame:
    """(page_id, place, href): links of pages in their order."""
    found = F.regexp_extract_all("html", F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"'#]+)"""), 1)
    return pages.select("page_id", F.posexplode(found).alias("place", "href")).select("page_id", F.col("place").cast("long").alias("place"), "href")


def transcript(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, text): turns in order, each after its speaker."""
    line = F.concat(F.col("role"), F.lit(": "), F.col("text"))
    rows = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))).alias("t"))
    return rows.select("conv_id", "n_turns", F.array_join(F.transform("t", lambda x: x["line"]), "\n").alias("text"))


def issuer_matches(targets: DataFrame, candidates: DataFrame, least: float = 0.5) -> DataFrame:
    """(target, candidate, score): the best candidate that shares words with the target, by Jaccard similarity.

    The words of a name are put in order, rare ones first; two names as similar as that share one of their first words, as many
    as can be missing and one more. Only names that do meet, so that frequent words (inc, group) bring none together.
    """
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: w != ""))
    t = targets.select(F.col("target").alias("name"), words(F.col("target")).alias("ws")).distinct()
    c = candidates.select(F.col("candidate").alias("name"), words(F.col("candidate")).alias("ws")).distinct()
    often = t.unionByName(c).select(F.explode("ws").alias("w")).groupBy("w").agg(F.count("*").alias("n"))

    def first(names: DataFrame) -> DataFrame:
        ranked = names.select("name", F.size("ws").alias("size"), F.explode("ws").alias("w")).join(often, "w").groupBy("name", "size").agg(F.array_sort(F.collect_list(F.struct("n", "w"))).alias("ws"))
        many = F.col("size") - F.ceil(F.col("size") * least).cast("int") + 1
        return ranked.select("name", F.transform("ws", lambda x: x["w"]).alias("ws"), F.explode(F.slice("ws", F.lit(1), many)).alias("x")).select("name", "ws", F.col("x.w").alias("w"))

    both = first(t).select(F.col("name").alias("target"), F.col("ws").alias("tw"), "w").join(first(c).select(F.col("name").alias("candidate"), F.col("ws").alias("cw"), "w"), "w")
    n = F.size(F.array_intersect("tw", "cw"))
    s = both.select("target", "candidate", F.round(n / (F.size("tw") + F.size("cw") - n), 6).alias("score")).where(F.col("score") >= least)
    return s.groupBy("target").agg(F.min_by(F.struct("candidate", "score"), F.struct(-F.col("score"), F.col("candidate"))).alias("b")).select("target", "b.*")

"""What a document's text, title and address say about it, as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks of languages, accounting standards, currencies, units and restatements, in order, with their confidence.
LANGUAGES = (
    ("en", r"\b(?:total\s+(?:assets|liabilities|equity)|net\s+income|revenue|cash\s+flow)\b"),
    ("fr", r"\b(?:r[eé]sultat\s+net|chiffre\s+d['’]affaires|total\s+(?:de\s+l['’]actif|du\s+passif)|flux\s+de\s+tr[eé]sorerie)\b"),
    ("es", r"\b(?:ingresos\s+totales|resultado\s+neto|flujo\s+de\s+(?:caja|efectivo))\b"),
    ("de", r"\b(?:Gesamtverm[oö]gen|Eigenkapital|Jahres[uü]berschuss|Umsatzerl[oö]se)\b"),
)
STANDARDS = (
    ("IFRS", r"\bIFRS\b", "high"),
    ("IFRS", r"(?i)\bInternational\s+Financial\s+Reporting\s+Standards\b", "high"),
    ("US-GAAP", r"(?i)\bU\.?S\.?\s*GAAP\b", "high"),
    ("US-GAAP", r"(?i)\bGenerally\s+Accepted\s+Accounting\s+Principles\b", "medium"),
    ("FR-GAAP", r"(?i)\bPlan\s+Comptable\s+G[eé]n[eé]ral\b", "medium"),
)
MONEY = (
    ("USD", r"\b(?:United\s+States\s+dollars?|US\s*\$|USD)\b"),
    ("EUR", r"\b(?:euros?|EUR|€)\b"),
    ("GBP", r"\b(?:pounds?\s+sterling|GBP|£)\b"),
    ("CAD", r"\b(?:Canadian\s+dollars?|CAD|C\$)\b"),
    ("AUD", r"\b(?:Australian\s+dollars?|AUD|A\$)\b"),
    ("JPY", r"\b(?:Japanese\s+yen|JPY|¥)\b"),
    ("CHF", r"\b(?:Swiss\s+francs?|CHF)\b"),
    ("CNY", r"\b(?:Chinese\s+(?:yuan|renminbi)|CNY|RMB)\b"),
    ("HKD", r"\b(?:Hong\s+Kong\s+dollars?|HKD|HK\$)\b"),
)
UNITS = (
    ("billions", r"\bin\s+billions?\b"),
    ("milliards", r"\ben\s+milliards?\b"),
    ("millions", r"\bin\s+millions?\b"),
    ("millions_fr", r"\ben\s+millions?\s+d['’](?:euros?|dollars?|USD|EUR)\b"),
    ("millions_sym", r"(?:\$|€|£)\s*millions?\b"),
    ("eur_millions", r"€\s*(?:M|millions?)\b"),
    ("thousands", r"\bin\s+thousands?\b"),
    ("milliers", r"\ben\s+milliers?\b"),
    ("k_dollars", r"(?:\$|€|£)\s*(?:000s?|thousands?)\b"),
    ("units", r"\bin\s+(?:USD|EUR|GBP)\b"),
)
RESTATED = (
    (r"\bhave\s+been\s+restated\b", "high"),
    (r"\brestatement\s+of\b", "high"),
    (r"\brestated\s+(?:financial\s+)?(?:statements?|figures?|results?)\b", "high"),
    (r"\bas\s+restated\b", "high"),
    (r"\br[eé]exprim[eé](?:s|es?)?\b", "high"),
    (r"\bretrait[eé](?:s|[eé]es?)?\b", "medium"),
    (r"\*\s*restated\b", "medium"),
    (r"\bpreviously\s+reported\b", "medium"),
    (r"\breclassif(?:ied|ication)\b", "medium"),
)
YEARS = (
    (r"\bfiscal\s+year\s+(?:ended?\s+)?(?:(?:December|June|March|September)\s+\d{1,2},?\s+)?(\d{4})\b", "high"),
    (r"\byear\s+ended?\s+(?:(?:December|June|March|September)\s+\d{1,2},?\s+)?(\d{4})\b", "high"),
    (r"\bFY\s*(\d{4})\b", "high"),
    (r"\bexercice\s+(?:clos\s+le\s+)?(?:\d{1,2}\s+\w+\s+)?(\d{4})\b", "high"),
    (r"\b(?:for\s+the\s+)?(?:twelve|six)\s+months?\s+ended?\b.*?(\d{4})\b", "medium"),
)
# Words by which documents are classified, and what media addresses look like.
MEDIA_DOMAINS, MEDIA_ENDS = ("youtube.com", "youtu.be", "vimeo.com"), (".mp4", ".mov", ".avi", ".m3u8")
PRESS = ("press release", "news release", "earnings release", "communique", "communiqué")
ANNUAL = ("annual report", "registration document", "integrated report", "integrated annual report", "rapport annuel", "document d'enregistrement universel")
# What annual reports must hold to be read, and the types they come as.
LEAST_CHARS, LEAST_HITS, LONG_SAMPLE = 1_500, 2, 8_000
ANNUAL_TYPES = ("ANNUAL_REPORT", "10-K", "10K", "20-F", "20F", "40-F", "40F")
# Points for a candidate's type.
TYPE_POINTS = {"ANNUAL_REPORT": 4.0, "INTERIM_REPORT": 3.0, "REGULATORY_FILING": 2.0, "IR_NEWS": 1.0}
# The words of a company's name that name its legal form.
LEGAL_FORMS = ("inc", "incorporated", "corp", "corporation", "co", "company", "companies", "limited", "ltd", "plc", "llc", "sa", "spa", "ag", "nv", "fpo", "holdings", "holding", "group")
#: Characters that preflight looks at, and those for the unit (windows that are part of the rules).
SAMPLE, HEAD = 100_000, 5_000


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def _most(counts: dict[str, Column]) -> Column:
    """The name with the most hits, the first of equals; null without hits."""
    top = F.greatest(*counts.values())
    return reduce(lambda out, kv: out.when(kv[1] == top, kv[0]), counts.items(), F.when(top == 0, None))


def preflight(text: Column) -> Column:
    """struct of language, standard, currency and fiscal year with their confidence, unit and restatement, from a text's beginning."""
    sample, head = F.substring(text, 1, SAMPLE), F.substring(text, 1, HEAD)
    count = lambda t, p: F.regexp_count(t, F.lit("(?i)" + p))
    languages = {k: count(sample, p) for k, p in LANGUAGES}
    money = {k: count(sample, p) for k, p in MONEY}
    standard, sure = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for name, p, c in STANDARDS:
        standard, sure = standard.when(sample.rlike(p), name), sure.when(sample.rlike(p), c)
    year, year_sure = F.when(F.lit(False), 0), F.when(F.lit(False), "")
    for p, c in YEARS:
        y = F.regexp_extract(sample, "(?i)" + p, 1).try_cast("int")
        year, year_sure = year.when(y.between(1990, 2040), y), year_sure.when(y.between(1990, 2040), c)
    hit = [(sample.rlike("(?i)" + p), c) for p, c in RESTATED]
    either = lambda xs: reduce(lambda a, b: a | b, xs)
    both_medium = hit[7][0] & hit[8][0]
    return F.struct(
        _most(languages).alias("language"),
        F.when(F.greatest(*languages.values()) >= 3, "high").when(F.greatest(*languages.values()) > 0, "medium").alias("language_confidence"),
        standard.alias("standard"), sure.alias("standard_confidence"),
        _most(money).alias("currency"),
        year.alias("fiscal_year"), year_sure.alias("fiscal_year_confidence"),
        _most({k: count(head, p) for k, p in UNITS}).alias("unit"),
        either([h for h, _ in hit]).alias("restated"),
        (either([h for h, c in hit if c == "high"]) | both_medium).alias("explicitly_restated"),
    )


def filing_class(title: Column, url: Column, snippet: Column) -> Column:
    """ANNUAL_REPORT, INTERIM_REPORT, REGULATORY_FILING, IR_NEWS or OTHER, by title, address and the words around."""
    low = F.lower(url)
    said = F.regexp_replace(F.concat_ws(" ", F.lower(title), low, F.lower(snippet)), "[-_/]+", " ")
    media = _any(low, MEDIA_DOMAINS) | low.contains("watch?v=") | low.rlike(r"\.(mp4|mov|avi|m3u8)$")
    annual = _any(said, ANNUAL) | said.rlike(r"\burd\b")
    press = F.when(_any(said, ("results", "financial", "earnings")), "REGULATORY_FILING").otherwise("IR_NEWS")
    return (
        F.when(media, "OTHER").when(_any(said, PRESS), press).when(annual, "ANNUAL_REPORT").when(_any(said, ("interim", "half year", "h1 ", "h2 ")), "INTERIM_REPORT")
        .when(_any(said, ("rns", "regulatory news", "announcement")), "IR_NEWS").when(_any(said, ("results", "financial")), "REGULATORY_FILING").otherwise("OTHER")
    )


def extractability(kind: Column, status: Column, chars: Column, hits: Column, sample_chars: Column) -> Column:
    """The status of a text, lowered for annual reports that are too short or say too little of money."""
    annual = F.replace(F.upper(F.coalesce(kind, F.lit(""))), F.lit(" "), F.lit("")).isin(*ANNUAL_TYPES) & (status == "OK")
    return F.when(annual & (chars < LEAST_CHARS), "NON_EXTRACTABLE_LOW_TEXT_ANNUAL").when(annual & (hits < LEAST_HITS) & (sample_chars < LONG_SAMPLE), "NON_EXTRACTABLE_LOW_SIGNAL_ANNUAL").otherwise(status)


def candidate_score(said: Column, url: Column, keywords: tuple[str, ...], kind: Column, direct: Column, story: Column, dated: Column) -> Column:
    """Points of a link to a document: keywords, form of the address, type, presentation rather than release, date."""
    low = F.lower(url)
    hits = reduce(lambda a, b: a + b, [said.contains(k).cast("int") for k in keywords])
    one = lambda cond, points: F.when(cond, F.lit(points)).otherwise(F.lit(0.0))
    out = hits + one(low.endswith(".pdf"), 1.0) + one(_any(said, ("annual", "interim")), 2.0) + one(_any(said, ("rns", "hkex", "asx")), 2.0)
    out += reduce(lambda a, kv: a.when(kind == kv[0], kv[1]), TYPE_POINTS.items(), F.when(F.lit(False), 0.0)).otherwise(0.0)
    show = said.contains("presentation")
    out += one(show, 2.5) + one(show & _any(said, ("investor presentation", "results presentation")), 0.5) - one(_any(said, ("press release", "news release", "results release")), 1.5)
    out += F.when(direct, 1.0).when(~story, -1.5).otherwise(0.0) + one(dated, 0.5)
    return out - one(F.concat(said, F.lit(" "), low).rlike(r"\bevents?\b"), 1.0)


def loose_date(text: Column) -> Column:
    """The first date in a text: 2024-03-15 or 2024/3/15, else 20240315, else March 15, 2024, else 15 March 2024; as ISO text."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))

    def first(pattern: str, parse) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(pattern), 0), parse)
        return F.try_element_at(F.filter(found, lambda d: d.isNotNull()), F.lit(1))

    dashed = first(r"\b(?:19|20)\d{2}[-/]\d{1,2}[-/]\d{1,2}\b", lambda x: F.try_to_date(F.replace(x, F.lit("/"), F.lit("-")), "y-M-d"))
    solid = first(r"(?<!\d)(?:19|20)\d{2}\d{2}\d{2}(?!\d)", lambda x: F.try_to_date(x, "yyyyMMdd"))

    def worded(pattern: str, way: str) -> Column:
        raw = F.regexp_extract(t, pattern, 1)
        month = F.initcap(F.lower(F.regexp_extract(raw, "([A-Za-z]{3,9})", 1)))
        spelled = F.regexp_replace(raw, "[A-Za-z]{3,9}", "#")
        short = F.replace(spelled, F.lit("#"), F.left(month, F.lit(3)))
        whole = F.array(*[F.lit(m) for m in MONTHS])
        known = F.array_contains(whole, month) | (F.exists(whole, lambda m: F.left(m, F.lit(3)) == month))
        return F.when((raw != "") & known, F.try_to_date(short, way))

    text_date = F.coalesce(worded(r"([A-Za-z]{3,9} \d{1,2}, \d{4})", "MMM d, y"), worded(r"(?i)(\d{1,2} [A-Za-z]{3,9} 20\d{2})", "d MMM y"))
    return F.coalesce(dashed, solid, text_date).cast("string")


MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def year_hint(text: Column) -> Column:
    """The latest year in a text that speaks of a report, a year or results; else null."""
    low = F.lower(F.coalesce(text, F.lit("")))
    years = F.transform(F.regexp_extract_all(low, F.lit(r"(?<!\d)(?:19|20)\d{2}(?!\d)"), 0), lambda y: y.cast("int"))
    return F.when(_any(low, ("annual", "interim", "year", "fy", "report", "results")), F.array_max(years))


def entity_name(name: Column) -> Column:
    """A company's name in lower case, without what stands in brackets, signs and legal forms."""
    t = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"\[[^\]]*\]|\([^)]*\)", " "), "[^a-z0-9]+", " ")
    return F.array_join(F.filter(F.split(t, " "), lambda w: (w != "") & ~w.isin(*LEGAL_FORMS)), " ")


def weak_alias(name: Column, ticker: Column) -> Column:
    """Whether a normalized name is too short to tell a company, or its ticker."""
    return (name == "") | (name == ticker) | (F.length(name) < 5)

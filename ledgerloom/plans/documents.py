"""Queries over what documents say of themselves, and over rules kept as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import documents as D
from ..operators import rules as R
from ..sources.adapters import table
from .filings import _pick, _picked
from .registry import Register

query = Register()

#: Sentences put before a document's text, by its id.
_OPENINGS = (
    "Consolidated, in millions of US$ USD. IFRS. Fiscal year ended December 31, 2019. Figures as restated. ", "Chiffre d'affaires et résultat net, en milliers. Exercice clos le 31 décembre 2021. ", "Total assets and net income, revenue, cash flow in thousands EUR, U.S. GAAP. FY 2018. ",
    "previously reported amounts were reclassified. year ended 2030, CHF. ", "Umsatzerlöse und Eigenkapital, € millions. ", "previously reported. FY 1950. year ended 2001. ", "", "Generally Accepted Accounting Principles; $ 000s; GBP, GBP and euros. six months ended June 30, 2016. ",
)


def _count(t: str, p: str) -> str:
    return "len(regexp_extract_all(" + t + ", '(?i)" + p.replace("'", "''") + "'))"


def _has(p: str) -> str:
    return "regexp_matches(s, '" + p.replace("'", "''") + "')"


def _top(names: list[str], prefix: str) -> str:
    most = f"greatest({', '.join(prefix + str(k) for k in range(len(names)))})"
    return f"case when {most} = 0 then null " + " ".join(f"when {prefix}{k} = {most} then '{n}'" for k, n in enumerate(names)) + " end"


def _year(p: str) -> str:
    return "try_cast(regexp_extract(s, '(?i)" + p.replace("'", "''") + "', 1) as int)"


_LANG, _CUR, _UNIT = [k for k, _ in D.LANGUAGES], [k for k, _ in D.MONEY], [k for k, _ in D.UNITS]
_PREFLIGHT = f"""with t as (select doc_id, substr({_picked('doc_id', *_OPENINGS)} || text, 1, {D.SAMPLE}) as s from documents),
n as (select *, {', '.join(f"{_count('s', p)} as l{k}" for k, (_, p) in enumerate(D.LANGUAGES))}, {', '.join(f"{_count('s', p)} as m{k}" for k, (_, p) in enumerate(D.MONEY))}, {', '.join(f"{_count(f'substr(s, 1, {D.HEAD})', p)} as u{k}" for k, (_, p) in enumerate(D.UNITS))},
  {', '.join(f"{_year(p)} as y{k}" for k, (p, _) in enumerate(D.YEARS))}, {', '.join(f"{_has('(?i)' + p)} as r{k}" for k, (p, _) in enumerate(D.RESTATED))} from t)
select doc_id, {_top(_LANG, 'l')} as language, case when greatest(l0, l1, l2, l3) >= 3 then 'high' when greatest(l0, l1, l2, l3) > 0 then 'medium' end as language_confidence,
  case {' '.join(f"when {_has(p)} then '{s}'" for s, p, _ in D.STANDARDS)} end as standard, case {' '.join(f"when {_has(p)} then '{c}'" for _, p, c in D.STANDARDS)} end as standard_confidence, {_top(_CUR, 'm')} as currency,
  case {' '.join(f'when y{k} between 1990 and 2040 then y{k}' for k in range(len(D.YEARS)))} end as fiscal_year, case {' '.join(f"when y{k} between 1990 and 2040 then '{c}'" for k, (_, c) in enumerate(D.YEARS))} end as fiscal_year_confidence, {_top(_UNIT, 'u')} as unit,
  {' or '.join(f'r{k}' for k in range(9))} as restated, {' or '.join(f'r{k}' for k in range(5))} or (r7 and r8) as explicitly_restated from n"""


@query(_PREFLIGHT)
def preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(_pick(F.col("doc_id"), *_OPENINGS), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", D.preflight(text).alias("p")).select("doc_id", "p.*")


_HEADS = ("Annual Report", "Press release: results", "Interim results H1 2020", "RNS announcement", "Universal Registration Document", "Investor presentation", "Half-year financial", "News", "Press Release", "Watch", "results presentation event")
_PATHS = ("/doc.pdf", "/news/item", "/video.mp4", "/annual_report-2019.pdf", "/watch?v=1", "/events/hkex.PDF")
_LINK = f"select page_id, {_picked('page_id', *_HEADS)} as title, url || {_picked('page_id // 3', *_PATHS)} as url from pages"
_SAID = "regexp_replace(lower(title) || ' ' || lower(url) || ' ', '[-_/]+', ' ', 'g')"
_ANY = lambda t, ws: "(" + " or ".join(f"contains({t}, '{w.replace(chr(39), chr(39) * 2)}')" for w in ws) + ")"
_CLASS = f"""case when {_ANY('lower(url)', D.MEDIA_DOMAINS + ('watch?v=',))} or regexp_matches(lower(url), '\\.(mp4|mov|avi|m3u8)$') then 'OTHER' when {_ANY('said', D.PRESS)} then case when {_ANY('said', ('results', 'financial', 'earnings'))} then 'REGULATORY_FILING' else 'IR_NEWS' end
  when {_ANY('said', D.ANNUAL)} or regexp_matches(said, '\\burd\\b') then 'ANNUAL_REPORT' when {_ANY('said', ('interim', 'half year', 'h1 ', 'h2 '))} then 'INTERIM_REPORT' when {_ANY('said', ('rns', 'regulatory news', 'announcement'))} then 'IR_NEWS' when {_ANY('said', ('results', 'financial'))} then 'REGULATORY_FILING' else 'OTHER' end"""


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    return table(spark, sf_dir, "pages").select("page_id", _pick(k, *_HEADS).alias("title"), F.concat("url", _pick(F.floor(k / 3), *_PATHS)).alias("url"))


@query(f"select page_id, {_CLASS} as filing_class from (select *, {_SAID} as said from ({_LINK}))")
def filing_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir).select("page_id", D.filing_class(F.col("title"), F.col("url"), F.lit("")).alias("filing_class"))


_KEYWORDS = ("annual", "report", "results", "presentation", "financial", "hkex")


@query(f"""with l as (select *, {_SAID} as said from ({_LINK})), c as (select *, {_CLASS} as kind, contains(said, 'presentation') as pres from l)
select page_id, cast({' + '.join(f"contains(said, '{k}')::int" for k in _KEYWORDS)} + (lower(url) like '%.pdf')::int + 2.0 * {_ANY('said', ('annual', 'interim'))}::int + 2.0 * {_ANY('said', ('rns', 'hkex', 'asx'))}::int
  + case kind when 'ANNUAL_REPORT' then 4.0 when 'INTERIM_REPORT' then 3.0 when 'REGULATORY_FILING' then 2.0 when 'IR_NEWS' then 1.0 else 0.0 end + case when pres then 2.5 else 0.0 end + case when pres and {_ANY('said', ('investor presentation', 'results presentation'))} then 0.5 else 0.0 end
  - case when {_ANY('said', ('press release', 'news release', 'results release'))} then 1.5 else 0.0 end + case when page_id % 2 = 0 then 1.0 when page_id % 5 <> 0 then -1.5 else 0.0 end + case when page_id % 3 = 0 then 0.5 else 0.0 end - case when regexp_matches(said || ' ' || lower(url), '\\bevents?\\b') then 1.0 else 0.0 end as double) as score from c""")
def candidate_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, title, url = F.col("page_id"), F.col("title"), F.col("url")
    said = F.regexp_replace(F.concat_ws(" ", F.lower(title), F.lower(url), F.lit("")), "[-_/]+", " ")
    score = D.candidate_score(said, url, _KEYWORDS, D.filing_class(title, url, F.lit("")), k % 2 == 0, k % 5 == 0, k % 3 == 0)
    return _linked(spark, sf_dir).select("page_id", score.cast("double").alias("score"))


@query(f"""with t as (select doc_id, {_picked('doc_id', 'annual_report', '10-K', '20 F', '10-Q', '40-F')} as kind, case when doc_id % 7 = 0 then 'FAILED' else 'OK' end as status, length(text) as chars, lower(regexp_replace(text, '\\s+', ' ', 'g')) as s from documents)
select doc_id, case when replace(upper(kind), ' ', '') in ('ANNUAL_REPORT', '10-K', '10K', '20-F', '20F', '40-F', '40F') and status = 'OK' then case when chars < 1500 then 'NON_EXTRACTABLE_LOW_TEXT_ANNUAL' when {' + '.join(f"contains(s, '{w}')::int" for w in ('revenue', 'ebit', '%', 'usd'))} < 2 and chars < 8000 then 'NON_EXTRACTABLE_LOW_SIGNAL_ANNUAL' else status end else status end as status from t""")
def annual_extractability(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, low = F.col("doc_id"), F.lower(F.regexp_replace("text", r"\s+", " "))
    hits = sum((low.contains(w).cast("int") for w in ("revenue", "ebit", "%", "usd")), F.lit(0))
    status = D.extractability(_pick(k, "annual_report", "10-K", "20 F", "10-Q", "40-F"), F.when(k % 7 == 0, "FAILED").otherwise("OK"), F.length("text"), hits, F.length("text"))
    return table(spark, sf_dir, "documents").select("doc_id", status.alias("status"))


_DATES = ("filed {d}", "on {s} and", "x {c}.pdf", "{m} {n}, {y} annual report", "the {n} {m} {y}", "no date, year 1999 results in 2003", "2001-13-40 or 20010230", "")


@query(f"""with o as (select o_orderkey, o_orderdate as d, {_picked('o_orderkey', *_DATES)} as way from orders),
t as (select o_orderkey, d, way, replace(replace(replace(replace(replace(replace(way, '{{d}}', strftime(d, '%Y-%m-%d')), '{{s}}', year(d) || '/' || month(d) || '/' || day(d)), '{{c}}', strftime(d, '%Y%m%d')), '{{m}}', case when o_orderkey % 3 = 0 then strftime(d, '%b') else strftime(d, '%B') end), '{{n}}', cast(day(d) as varchar)), '{{y}}', cast(year(d) as varchar)) as t from o)
select o_orderkey, case when way like '%{{%' and (way not like 'the%' or year(d) >= 2000) then strftime(d, '%Y-%m-%d') end as date, case when contains(t, 'annual') or contains(t, 'year') or contains(t, 'results') then case when way like 'no%' then 2003 else year(d) end end as year from t""")
def loose_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    part = {"{d}": F.date_format(d, "yyyy-MM-dd"), "{s}": F.concat_ws("/", F.year(d), F.month(d), F.day(d)), "{c}": F.date_format(d, "yyyyMMdd"), "{m}": F.when(k % 3 == 0, F.date_format(d, "MMM")).otherwise(F.date_format(d, "MMMM")), "{n}": F.day(d).cast("string"), "{y}": F.year(d).cast("string")}
    t = _pick(k, *_DATES)
    for mark, value in part.items():
        t = F.replace(t, F.lit(mark), value)
    return table(spark, sf_dir, "orders").select("o_orderkey", t.alias("t")).select("o_orderkey", D.loose_date(F.col("t")).alias("date"), D.year_hint(F.col("t")).alias("year"))


_NAMES = (" Holdings PLC", ", Inc. [old]", " (ADR) Group Co", " Ltd", "")


@query(f"""with n as (select s_suppkey, 'Acme ' || regexp_replace(s_name, '[^0-9]', '', 'g') || {_picked('s_suppkey', *_NAMES)} as raw from supplier),
c as (select s_suppkey, array_to_string(list_filter(string_split_regex(regexp_replace(regexp_replace(lower(raw), '\\[[^\\]]*\\]|\\([^)]*\\)', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '' and w not in ({', '.join(map(repr, D.LEGAL_FORMS))})), ' ') as name from n)
select s_suppkey, name, name = '' or name = 'acme' or length(name) < 5 as weak from c""")
def entity_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("Acme "), F.regexp_replace("s_name", "[^0-9]", ""), _pick(F.col("s_suppkey"), *_NAMES))
    return table(spark, sf_dir, "supplier").select("s_suppkey", D.entity_name(raw).alias("name")).select("s_suppkey", "name", D.weak_alias(F.col("name"), F.lit("acme")).alias("weak"))


_SETTINGS = """select 'S' || (l_partkey % 50) as scope, l_linenumber % 3 as layer, 'sec' || (l_suppkey % 4) as section, case when l_orderkey % 97 = 0 then null else 'k' || (l_orderkey % 5) end as key, max(l_returnflag || l_orderkey) as value from lineitem group by all"""


@query(f"""with s as ({_SETTINGS}), w as (select scope, section, max(layer) as floor from s where key is null group by all)
select scope, section, key, value from (select s.*, row_number() over (partition by s.scope, s.section, s.key order by layer desc) as n from s left join w on w.scope = s.scope and w.section = s.section where floor is null or layer >= floor) where n = 1""")
def layered_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, k = lambda c: c.cast("string"), F.col("l_orderkey")
    li = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("S"), text(F.col("l_partkey") % 50)).alias("scope"), (F.col("l_linenumber") % 3).alias("layer"), F.concat(F.lit("sec"), text(F.col("l_suppkey") % 4)).alias("section"), F.when(k % 97 != 0, F.concat(F.lit("k"), text(k % 5))).alias("key"), F.concat("l_returnflag", text(k)).alias("value"))
    return R.layered(li.groupBy("scope", "layer", "section", "key").agg(F.max("value").alias("value")))


_BRIDGE = """with p as (select l_orderkey as doc, l_linenumber as ord, ['redeemable_nci', 'mezzanine_equity', 'non_controlling_interest', 'other'][l_partkey % 4 + 1] as kind, cast(floor(l_quantity) as double) as value from lineitem),
g as (select doc, case doc % 3 when 0 then max(value) when 1 then sum(value) else max(value) + min(value) end as gap from p group by doc),
q as (select doc, kind, value, min(ord) as ord, case kind when 'redeemable_nci' then 1 when 'mezzanine_equity' then 2 else 3 end as place from p where kind <> 'other' group by all),
sets as (
  select doc, 1 as n, [place] as kinds, [ord] as ords, value as total from q
  union all select a.doc, 2, list_sort([a.place, b.place]), [a.ord, b.ord], a.value + b.value from q a join q b on a.doc = b.doc and a.ord < b.ord
  union all select a.doc, 3, list_sort([a.place, b.place, c.place]), [a.ord, b.ord, c.ord], a.value + b.value + c.value from q a join q b on a.doc = b.doc and a.ord < b.ord join q c on a.doc = c.doc and b.ord < c.ord)
select doc, n as n_parts, total, array_to_string(list_transform(kinds, lambda k: ['redeemable_nci', 'mezzanine_equity', 'non_controlling_interest'][k]), ',') as kinds from (
  select s.*, row_number() over (partition by s.doc order by n, kinds, ords, total) as r from sets s join g using (doc) where gap > 0 and abs(total - gap) <= greatest(1.0, gap * 0.001)) where r = 1"""


@query(_BRIDGE)
def bridge_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, ("redeemable_nci", "mezzanine_equity", "non_controlling_interest", "other"))), (F.col("l_partkey") % 4 + 1).cast("int"))
    p = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("ord"), kind.alias("kind"), F.floor("l_quantity").cast("double").alias("value"))
    n = F.col("doc") % 3
    gaps = p.groupBy("doc").agg(F.max("value").alias("hi"), F.min("value").alias("lo"), F.sum("value").alias("all")).select("doc", F.when(n == 0, F.col("hi")).when(n == 1, F.col("all")).otherwise(F.col("hi") + F.col("lo")).alias("gap"))
    return R.bridge(gaps, p)


@query("""with e as (select user_id, ['ok', 'ok', 'ok', 'warning', 'error', 'odd', 'fatal'][case when event_id % 31 = 0 then 7 when event_id % 11 = 0 then 5 when event_id % 5 = 0 then 4 when event_id % 3 = 0 then 6 else 1 end] as state from events)
select user_id, case max(case state when 'warning' then 2 when 'error' then 3 when 'fatal' then 4 else 1 end) when 1 then 'ok' when 2 then 'warning' when 3 then 'error' else 'fatal' end as severity, count(*) filter (state = 'warning') as n_warning, count(*) filter (state = 'error') as n_error, count(*) filter (state = 'fatal') as n_fatal from e group by user_id""")
def worst_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    state = F.when(k % 31 == 0, "fatal").when(k % 11 == 0, "error").when(k % 5 == 0, "warning").when(k % 3 == 0, "odd").otherwise("ok")
    return R.worst(table(spark, sf_dir, "events").select("user_id", state.alias("state")), "user_id", "state")


QUERIES, ORACLE_SQL = query.queries, query.sql

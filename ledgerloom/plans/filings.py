"""Queries over names, types and periods of filings, markets and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import filings as N
from ..functions import labels as L
from ..functions import markets as M
from ..sources import adapters as A
from ..sources.adapters import table
from .registry import Register

query = Register()


def _pick(n: Column, *values: str | None) -> Column:
    """The value at place n modulo their number."""
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


def _picked(n: str, *values: str | None) -> str:
    """The same in SQL."""
    shown = ", ".join("null" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"([{shown}])[cast(({n}) % {len(values)} + 1 as int)]"


#: File names made of orders: sequence, form, period and extension, some without that pattern.
_FORMS = ("10-K", "10-q", "20-F", "8-K", "6-K", "DEF14A", "Annual", "interim")
_EXT = (".clean.md", ".txt", ".htm", ".pdf", ".html")
_ODD = ("proxy_2001.txt", "Acme_10K_2003.htm", "H12004_report.pdf", "half-year.md", "notes", "SRC_x_10-K_FY2001.txt", ".hidden")
_NAMES = f"""n as (select o_orderkey, case when o_orderkey % 11 = 0 then {_picked('o_orderkey // 11', *_ODD)} else case when o_orderkey % 5 = 0 then 'src_' else 'SRC_' end || lpad(cast(o_custkey % 1000 as varchar), 3, '0') || '_' || {_picked('o_orderkey', *_FORMS)} || '_' ||
  case when o_orderkey % 3 = 0 then 'FY' || year(o_orderdate) else 'Q' || quarter(o_orderdate) || '-' || year(o_orderdate) end || {_picked('o_custkey', *_EXT)} end as name from orders)"""


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    year = F.year(day).cast("string")
    period = F.when(k % 3 == 0, F.concat(F.lit("FY"), year)).otherwise(F.concat(F.lit("Q"), F.quarter(day).cast("string"), F.lit("-"), year))
    usual = F.concat(F.when(k % 5 == 0, "src_").otherwise("SRC_"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0"), F.lit("_"), _pick(k, *_FORMS), F.lit("_"), period, _pick(F.col("o_custkey"), *_EXT))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 11 == 0, _pick(F.floor(k / 11), *_ODD)).otherwise(usual).alias("name"))


_FORM_SQL = """case when lower(name) like '%10-k%' or lower(name) like '%10k%' then '10-K' when lower(name) like '%10-q%' or lower(name) like '%10q%' then '10-Q' when lower(name) like '%20-f%' or lower(name) like '%20f%' then '20-F'
  when lower(name) like '%8-k%' or lower(name) like '%8k%' then '8-K' when lower(name) like '%6-k%' or lower(name) like '%6k%' then '6-K' {} else 'unknown' end"""


@query(f"""with {_NAMES} select o_orderkey, name, {_FORM_SQL.format('')} as form, {_FORM_SQL.format("when lower(name) like '%def14a%' or lower(name) like '%proxy%' then 'DEF14A' when lower(name) like '%annual%' then 'annual_report' when regexp_matches(lower(name), 'h[12]20[0-9][0-9]') or lower(name) like '%interim%' or lower(name) like '%half%' then 'interim_report'")} as filing_type from n""")
def filing_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("name")
    return _names(spark, sf_dir).select("o_orderkey", "name", N.form_of(name).alias("form"), N.filing_type(name).alias("filing_type"))


@query(rf"""with {_NAMES}, p as (select o_orderkey, name, regexp_matches(name, '(?i)^SRC_\d+_[A-Z0-9\-]+_.+$') as ok, regexp_extract(name, '(?i)^(SRC_\d+)_([A-Z0-9\-]+)_(.+)$', ['a', 'b', 'c']) as p from n)
select o_orderkey, case when ok then upper(p.a) end as src_id, case when ok then upper(p.b) end as form, case when ok then p.c end as period,
  case when suffix(name, '.clean.md') then name[:length(name) - 9] when strpos(name[2:], '.') > 0 then regexp_replace(name, '^(.+)\.[^.]+$', '\1') else name end as base_id from p""")
def filing_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("o_orderkey", N.stem(F.col("name")).alias("s"), N.base_id(F.col("name")).alias("base_id")).select("o_orderkey", "s.*", "base_id")


@query(rf"""with {_NAMES}, r as (select distinct upper(regexp_extract(name, '(?i)^(SRC_\d+)_', 1)) as src_id, name, case when suffix(name, '.clean.md') then 0 when suffix(name, '.txt') then 1 when suffix(name, '.htm') then 2 when suffix(name, '.html') then 3 when suffix(name, '.pdf') then 4 end as ext from n)
select src_id, arg_min(name, (ext, name)) as name, count(*) as variants from r where src_id <> '' and ext is not null group by src_id""")
def best_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _names(spark, sf_dir).select("name").distinct().select(F.upper(F.regexp_extract("name", r"(?i)^(SRC_\d+)_", 1)).alias("src_id"), "name", N.extension_rank(F.col("name")).alias("ext"))
    return r.where("src_id <> '' and ext is not null").groupBy("src_id").agg(F.min_by("name", F.struct("ext", "name")).alias("name"), F.count("*").alias("variants"))


@query(f"""with {_NAMES}, v as (select distinct name, case when suffix(name, '.clean.md') then name[:length(name) - 9] else regexp_replace(name, '^(.+)\\.[^.]+$', '\\1') end as base_id from n)
select name, base_id from v where not suffix(name, '.txt') or base_id not in (select base_id from v where suffix(name, '.clean.md'))""")
def variant_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts go where the same filing has a table file."""
    v = _names(spark, sf_dir).select("name").distinct().withColumn("base_id", N.base_id(F.col("name")))
    text = F.col("name").endswith(".txt")
    tables = v.where(F.col("name").endswith(".clean.md")).select("base_id").distinct()
    return v.where(~text).unionByName(v.where(text).join(tables, "base_id", "left_anti")).select("name", "base_id")


_TYPES = ("10-k", " 20-F ", "transcript", "Call_Transcript_Q3", "slides", "MARKET_DATA", "", None, "press_release", "other", "6-K", "ir_news", "sec_exhibit")


@query(f"""with t as (select c_custkey, upper(trim({_picked('c_custkey', *_TYPES)})) as t from customer), s as (select c_custkey, case when coalesce(t, '') = '' then 'OTHER' else t end as source_type from t)
select c_custkey, source_type, case when source_type in ('10-K', '10-Q', '20-F', '6-K', '8-K', 'DEF14A', 'SEC_EXHIBIT', 'CREDIT_AGREEMENT', 'ANNUAL_REPORT', 'INTERIM_REPORT', 'REGULATORY_FILING', '40-F', 'QUARTERLY_REPORT') then 'REGULATORIO' when contains(source_type, 'TRANSCRIPT') then 'TRANSCRIPCION'
  when source_type in ('INVESTOR_PRESENTATION', 'IR_NEWS', 'PRESS_RELEASE', 'SLIDES') then 'IR' when source_type = 'MARKET_DATA' then 'MERCADO' else 'OTRA' end as category from s""")
def source_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _pick(F.col("c_custkey"), *_TYPES)
    return table(spark, sf_dir, "customer").select("c_custkey", N.source_type(t).alias("source_type"), N.category(t).alias("category"))


_TITLES = (" Consolidated Balance Sheets", " STATEMENT OF CASH FLOWS and statements of shareholders' equity", " Consolidated statements of income", " cash flow statement", " profit and loss", "", " statements of financial position")


@query(f"""with t as (select doc_id, substr({_picked('doc_id', *_TITLES)} || ' ' || text, 1, 50000) as s from documents)
select doc_id, array_to_string(list_filter([{', '.join(f"case when regexp_matches(s, '(?i){p.replace(chr(39), chr(39) * 2)}') then '{k}' end" for k, p in N.SECTIONS.items())}], lambda x: x is not null), ',') as sections from t""")
def section_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(_pick(F.col("doc_id"), *_TITLES), F.lit(" "), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(N.sections(text), ",").alias("sections"))


@query(f"""with {A.LONG_SQL} select ticker, period_key, field, value, case when field in ({', '.join(map(repr, N.POSITIVE))}) then abs(value) when field = 'capex' then -abs(value) else value end as signed from long_facts""")
def sign_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = A.long_facts(spark, sf_dir)
    return f.select("ticker", "period_key", "field", "value", N.signed(F.col("field"), F.col("value")).alias("signed"))


_SLUGS = ("Q{q}{y}", "Q{q}-{y}", "{q}Q{y}", "FY{y}", "fy-{y}", "q{q}_FY{y}", "Q{q} {s}", "{q}q{s}", "Q{q}-{y}-call", "  Annual   report {y}! ", "", None)


def _slug(way: str, q: Column, y: Column) -> Column:
    out = F.lit(way)
    for k, v in (("{q}", q), ("{y}", y), ("{s}", F.right(y, F.lit(2)))):
        out = F.replace(out, F.lit(k), v)
    return out


_SLUG_RAW = "replace(replace(replace(" + _picked("o_orderkey", *_SLUGS) + ", '{q}', cast(quarter(o_orderdate) as varchar)), '{y}', cast(year(o_orderdate) as varchar)), '{s}', right(cast(year(o_orderdate) as varchar), 2))"


@query(rf"""with r as (select distinct {_SLUG_RAW} as raw from orders), t as (select raw, replace(upper(trim(regexp_replace(replace(coalesce(raw, ''), '_', '-'), '\s+', ' ', 'g'))), ' ', '-') as t from r)
select raw, case when regexp_matches(t, '^Q[1-4]-?(19|20)\d\d$') then 'Q' || t[2] || '-' || right(t, 4) when regexp_matches(t, '^Q[1-4]-?\d\d$') then 'Q' || t[2] || '-20' || right(t, 2) when regexp_matches(t, '^Q[1-4]-?FY-?(19|20)\d\d$') then 'Q' || t[2] || '-' || right(t, 4)
  when regexp_matches(t, '^FY-?(19|20)\d\d$') then 'FY' || right(t, 4) when regexp_matches(t, '^[1-4]Q-?(19|20)\d\d$') then 'Q' || t[1] || '-' || right(t, 4) when regexp_matches(t, '^[1-4]Q-?\d\d$') then 'Q' || t[1] || '-20' || right(t, 2)
  when regexp_matches(t, '^Q[1-4]-(19|20)\d\d') then 'Q' || t[2] || '-' || t[4:7] else coalesce(nullif(trim(regexp_replace(t, '[^A-Za-z0-9_.-]+', '-', 'g'), '-'), ''), 'UNKNOWN') end as period from t""")
def period_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, y, n = F.quarter("o_orderdate").cast("string"), F.year("o_orderdate").cast("string"), F.col("o_orderkey") % len(_SLUGS)
    raw = F.when(F.lit(False), "")
    for k, way in enumerate(_SLUGS):
        if way is not None:
            raw = raw.when(n == k, _slug(way, q, y))
    return table(spark, sf_dir, "orders").select(raw.alias("raw")).distinct().select("raw", N.period_slug(F.col("raw")).alias("period"))


@query(rf"""with d as (select o_orderkey, case when o_orderkey % 3 = 0 then 'a-' || strftime(o_orderdate, '%Y%m%d') || '.htm' else 'plain.htm' end as document, cast(o_orderdate + interval 100 day as date) as filed, {_picked('o_orderkey', '10-K', '10-Q', '8-K', '6-K', '20-F')} as form from orders),
p as (select *, case when document[3:4] = '20' then cast(document[3:6] as int) else year(filed) end as y, case when document[3:4] = '20' then cast(document[7:8] as int) else month(filed) end as m from d)
select o_orderkey, case when form in ('10-K', '20-F') then 'FY' || y when form in ('10-Q', '6-K') then 'Q' || ((m + 2) // 3) || '-' || y else cast(filed as varchar) end as period from p""")
def filed_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    document = F.when(k % 3 == 0, F.concat(F.lit("a-"), F.date_format(day, "yyyyMMdd"), F.lit(".htm"))).otherwise("plain.htm")
    return table(spark, sf_dir, "orders").select("o_orderkey", N.filed_period(document, F.date_add(day.cast("date"), 100), _pick(k, "10-K", "10-Q", "8-K", "6-K", "20-F")).alias("period"))


_COUNTRIES = ("usa", "United Kingdom", "hk", " france ", "", None, "Germany", "AU", "United States", "brazil", "CANADA", "UK")
_EXCHANGES = ("nyse", "OTC Markets", "LSE", "sehk", None, "ASX", "tsx", " ")


@query(f"""with r as (select c_custkey, upper(trim({_picked('c_custkey', *_COUNTRIES)})) as c0, upper(trim({_picked('c_custkey // 7', *_EXCHANGES)})) as e0, case when c_custkey % 3 = 0 then '1' end as cik from customer),
n as (select c_custkey, cik, case c0 {' '.join(f"when '{k}' then '{v}'" for k, v in M.COUNTRY_CODES.items())} else nullif(c0, '') end as country, case when contains(e0, 'OTC') then 'OTC' else nullif(e0, '') end as exchange from r)
select c_custkey, country, exchange, (country is not null and country not in ('US', 'USA')) or coalesce(exchange in ('LSE', 'AIM', 'SEHK', 'HKEX', 'ASX', 'EPA', 'TSX', 'OTRA'), false) or (cik is null and coalesce(country not in ('US', 'USA'), true)) as non_us,
  case when exchange in ('SEHK', 'HKEX') or country = 'HK' then 'HKEX' when exchange in ('LSE', 'AIM') or country in ('GB', 'UK') then 'RNS' when exchange = 'ASX' or country = 'AU' then 'ASX' when exchange = 'EPA' or country = 'FR' then 'EURONEXT' when exchange = 'TSX' or country = 'CA' then 'SEDAR+' else 'LOCAL_IR' end as regulator from n""")
def market_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", M.country(_pick(k, *_COUNTRIES)).alias("country"), M.exchange(_pick(F.floor(k / 7), *_EXCHANGES)).alias("exchange"), F.when(k % 3 == 0, "1").alias("cik"))
    e, n = F.col("exchange"), F.col("country")
    return c.select("c_custkey", "country", "exchange", M.is_non_us(e, n, F.col("cik")).alias("non_us"), M.regulator(e, n).alias("regulator"))


_LABELS = ("Net income", "Net income (loss) ", "Net income per share - basic", "Diluted earnings per share", "Total liabilities and equity", "Total current liabilities", "Total equity", "Restricted cash", "Cash and cash equivalents", "Deferred income tax", "Income tax expense (benefit)", "Interest paid", "Interest expense, net", "Depreciation and amortization", "Accumulated depreciation", "D&A – oil and gas", "Operating income before tax", "Gross margin", "Proceeds from long-term debt", "Oil and gas sales", "Weighted average shares outstanding, basic", "SG&A (2)", "For the years ended 2001", "R&D tax credit", "Special dividend", "Current income tax expense", "Current income tax")
_BAD = " ".join(f"when '{f}' then " + " or ".join(f"regexp_matches(label, '(?i){p}')" if isinstance(p, str) else f"(regexp_matches(label, '(?i){p[0]}') and not regexp_matches(label, '(?i){p[1]}'))" for p in ps) for f, ps in L.REJECTED.items())
_GOOD = " ".join(f"when field = '{f}' and regexp_full_match(trim(label), '(?i){p}') then 100 when field = '{f}' and regexp_matches(label, '(?i){p}') then 50" for f, ps in L.PREFERRED.items() for p in ps)
_FIELDS = tuple(dict.fromkeys([*L.REJECTED, *L.PREFERRED]))


@query(f"""with l as (select distinct {_picked('p_partkey', *_LABELS)} || case p_size % 4 when 0 then '' when 1 then ' ' else ', ' || lower(p_brand) end as label from part), f as (select unnest([{', '.join(map(repr, _FIELDS))}]) as field)
select label, field, {' or '.join(f"regexp_matches(label, '(?i){p}')" for p in L.NEVER)} or coalesce(case field {_BAD} end, false) as rejected, case {_GOOD} when contains(label, ' – ') or contains(label, ' — ') then -10 else 0 end as priority from l, f""")
def label_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size") % 4
    label = F.concat(_pick(F.col("p_partkey"), *_LABELS), F.when(n == 0, "").when(n == 1, " ").otherwise(F.concat(F.lit(", "), F.lower("p_brand"))))
    every = table(spark, sf_dir, "part").select(label.alias("label")).distinct().withColumn("field", F.explode(F.array(*map(F.lit, _FIELDS))))
    return every.select("label", "field", L.rejected(F.col("field"), F.col("label")).alias("rejected"), L.priority(F.col("field"), F.col("label")).alias("priority"))


@query("""with c as (select l_orderkey, l_linenumber, l_extendedprice as value, cast([0, 3, 6, 9][l_linenumber % 4 + 1] as int) as scale, cast([0, 3, 6][l_orderkey % 3 + 1] as int) as dominant from lineitem)
select l_orderkey, l_linenumber, case when scale = 0 or dominant = 0 or scale = dominant then value else value * pow(10.0, scale - dominant) end as value from c""")
def dominant_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    scale = F.element_at(F.array(*map(F.lit, (0, 3, 6, 9))), (F.col("l_linenumber") % 4 + 1).cast("int"))
    dominant = F.element_at(F.array(*map(F.lit, (0, 3, 6))), (F.col("l_orderkey") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", N.scaled(F.col("l_extendedprice"), scale, dominant).alias("value"))


@query("""select page_id, contains(lower(substr(case when page_id % 3 = 0 then '<html XMLNS:ix="http://www.xbrl.org/2013/inlineXBRL">' || html else html end, 1, 8192)), 'http://www.xbrl.org/2013/inlinexbrl') as has_ixbrl from pages""")
def ixbrl_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<html XMLNS:ix="http://www.xbrl.org/2013/inlineXBRL">'), F.col("html"))).otherwise(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.lower(F.substring(html, 1, 8192)).contains("http://www.xbrl.org/2013/inlinexbrl").alias("has_ixbrl"))


#: Forms by class and how many of each are kept.
_KEPT = {"annual": 6, "periodic": 12, "earnings": 10}


@query("""with f as (select c_nationkey, o_orderkey, o_orderdate, case o_orderkey % 7 when 0 then 'annual' when 1 then 'earnings' when 2 then 'earnings' else 'periodic' end as class from orders join customer on o_custkey = c_custkey),
k as (select *, row_number() over (partition by c_nationkey, class order by o_orderdate desc, o_orderkey) as n from f)
select c_nationkey, class, o_orderkey, n as place from k where n <= case class when 'annual' then 6 when 'periodic' then 12 else 10 end""")
def head_per_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest filings of each issuer by class of form: 6 annual, 12 periodic, 10 on earnings."""
    n = F.col("o_orderkey") % 7
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    f = o.select("c_nationkey", "o_orderkey", "o_orderdate", F.when(n == 0, "annual").when(n.isin(1, 2), "earnings").otherwise("periodic").alias("class"))
    place = F.row_number().over(W.partitionBy("c_nationkey", "class").orderBy(F.desc("o_orderdate"), "o_orderkey"))
    most = F.when(F.col("class") == "annual", _KEPT["annual"]).when(F.col("class") == "periodic", _KEPT["periodic"]).otherwise(_KEPT["earnings"])
    return f.withColumn("place", place).where(F.col("place") <= most).select("c_nationkey", "class", "o_orderkey", "place")


@query("""select event_id, status = 429 or status between 500 and 599 as again, case when status = 429 or status between 500 and 599 then 2.0 * pow(2.0, attempt) end as wait from (select event_id, cast([200, 429, 500, 503, 404, 599, 301][event_id % 7 + 1] as int) as status, event_id % 4 as attempt from events)""")
def retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    status = F.element_at(F.array(*map(F.lit, (200, 429, 500, 503, 404, 599, 301))), (k % 7 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", N.retried(status).alias("again"), F.when(N.retried(status), N.retry_wait(k % 4)).alias("wait"))


@query(r"""select event_id, trim(regexp_replace(case event_id % 4 when 0 then chr(8203) || event_type || chr(65279) when 1 then ' ' || event_type || chr(173) || ' x' else event_type end, '[' || chr(8203) || chr(8204) || chr(8205) || chr(8206) || chr(8207) || chr(65279) || chr(173) || chr(8288) || chr(8291) || ']', '', 'g')) as cell from events""")
def invisible_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, t = F.col("event_id") % 4, F.col("event_type")
    cell = F.when(n == 0, F.concat(F.lit("​"), t, F.lit("﻿"))).when(n == 1, F.concat(F.lit(" "), t, F.lit("­ x"))).otherwise(t)
    return table(spark, sf_dir, "events").select("event_id", N.plain_cell(cell).alias("cell"))


QUERIES, ORACLE_SQL = query.queries, query.sql

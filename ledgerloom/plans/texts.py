"""Queries over text functions, labels and table layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import catalogue as C
from ..operators import tables as B
from ..sources.adapters import table
from .registry import Register

query = Register()

#: Cells made of line items, in the notations that filings use.
_CELLS = """with c as (select distinct case l_linenumber % 8 when 0 then '(' || k || ')' when 1 then '$ ' || k when 2 then k || '%' when 3 then '-' || k when 4 then replace(k, '.', ',') when 5 then '( ' || k when 6 then ['—', 'N/A', '', 'nm', '1,234,567.8', '1.234,5', 'abc', '12a'][l_partkey % 8 + 1] else k end as cell
  from (select *, cast(cast(l_extendedprice as decimal(18,2)) as varchar) as k from lineitem))"""
_PARSE = """case when trim(cell) in ('—', '–', '-', 'N/A', 'n/a', 'NM', 'nm', '') then null else (case when trim(cell)[1] in ('(', '-', '−') then -1 else 1 end) *
  (case when regexp_full_match(plain, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') then try_cast(plain as double) end) end"""
_BODY = "trim(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(trim(cell), '^[(\\-−]', ''), '^([^(]*)\\)$', '\\1'), '[$€£¥]', '', 'g')), '%+$', ''))"
_PLAIN = f"b as (select cell, {_BODY} as body from c), p as (select cell, case when regexp_full_match(body, '[0-9.]+,[0-9]{{1,2}}') then replace(replace(body, '.', ''), ',', '.') else replace(body, ',', '') end as plain from b)"


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.col("l_linenumber") % 8
    odd = F.element_at(F.array(*map(F.lit, ("—", "N/A", "", "nm", "1,234,567.8", "1.234,5", "abc", "12a"))), (F.col("l_partkey") % 8 + 1).cast("int"))
    cell = F.when(n == 0, F.concat(F.lit("("), k, F.lit(")"))).when(n == 1, F.concat(F.lit("$ "), k)).when(n == 2, F.concat(k, F.lit("%"))).when(n == 3, F.concat(F.lit("-"), k)).when(n == 4, F.replace(k, F.lit("."), F.lit(","))).when(n == 5, F.concat(F.lit("( "), k)).when(n == 6, odd).otherwise(k)
    return table(spark, sf_dir, "lineitem").select(cell.alias("cell")).distinct()


@query(f"{_CELLS}, {_PLAIN} select cell, {_PARSE} as value from p")
def number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir).select("cell", T.parse_number(F.col("cell")).alias("value"))


@query(f"{_CELLS}, {_PLAIN} select cell, case when trim(cell) in ('', '-', '—', '–') then 0.0 else {_PARSE} end as value from p")
def number_displayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir).select("cell", T.parse_displayed(F.col("cell")).alias("value"))


@query("""with q as (select distinct case p_size % 6 when 0 then k || 'K' when 1 then k || 'm' when 2 then k || ' B' when 3 then k || '%' when 4 then k else 'N/A' end as s, p_size % 6 as n, k from (select *, cast(cast(p_retailprice as decimal(12,2)) as varchar) as k from part))
select distinct s, case n when 0 then k::double * 1e3 when 1 then k::double * 1e6 when 2 then k::double * 1e9 when 5 then null else k::double end as value from q""")
def suffix_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.col("p_size") % 6
    s = F.when(n == 0, F.concat(k, F.lit("K"))).when(n == 1, F.concat(k, F.lit("m"))).when(n == 2, F.concat(k, F.lit(" B"))).when(n == 3, F.concat(k, F.lit("%"))).when(n == 4, k).otherwise("N/A")
    return table(spark, sf_dir, "part").select(s.alias("s")).distinct().select("s", T.to_float(F.col("s")).alias("value"))


@query("""select p_partkey, case when notes in ('', 'raw') or notes is null then case when header in ('', 'raw') then case when pre in ('', 'raw') then case p_size % 7 when 0 then 'billions' when 1 then 'millions' when 2 then 'thousands' else 'raw' end else pre end else header end else notes end as scale,
  case when not (notes in ('', 'raw') or notes is null) then 'high' when header not in ('', 'raw') then 'high' when pre not in ('', 'raw') then 'medium' else 'low' end as confidence
from (select *, case when p_size % 5 = 0 then 'millions' when p_size % 5 = 1 then 'raw' end as notes, case when p_size % 4 = 0 then 'thousands' else '' end as header, case when p_size % 3 = 0 then 'billions' else 'raw' end as pre from part)""")
def scale_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = F.col("p_size")
    out = T.scale_cascade(F.when(z % 5 == 0, "millions").when(z % 5 == 1, "raw"), F.when(z % 4 == 0, "thousands").otherwise(""), F.when(z % 3 == 0, "billions").otherwise("raw"), F.when(z % 7 == 0, 1000.0).when(z % 7 == 1, 1.0).when(z % 7 == 2, 0.001))
    return table(spark, sf_dir, "part").select("p_partkey", out.alias("s")).select("p_partkey", "s.*")


#: Labels made of part names, with notes, qualifiers and dashes.
_LABELS = "l as (select distinct case p_size % 6 when 0 then p_type || ' (Note ' || p_size || ')' when 1 then '– ' || p_brand || ', ' || p_type when 2 then 'Net ' || p_type || ' (loss)' when 3 then upper(p_type) || ':' when 4 then p_type || ' / ' || p_brand else p_type end as label from part)"
_NORM = """case when regexp_matches(lower(trim(label)), '^[—–]') then '–' else '' end || trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(label)), '\\(\\s*(?:loss|benefit(?:\\s+from)?|deficit|expense|income|used\\s+in)\\s*\\)', '', 'g'), '\\(\\s*note\\s+\\d+\\)\\s*', '', 'g'), '[''ʼ‘’“”",():/—–]', ' ', 'g'), '\\s+', ' ', 'g'))"""


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, b, n = F.col("p_type"), F.col("p_brand"), F.col("p_size") % 6
    label = F.when(n == 0, F.concat(t, F.lit(" (Note "), F.col("p_size").cast("string"), F.lit(")"))).when(n == 1, F.concat(F.lit("– "), b, F.lit(", "), t)).when(n == 2, F.concat(F.lit("Net "), t, F.lit(" (loss)"))).when(n == 3, F.concat(F.upper(t), F.lit(":"))).when(n == 4, F.concat(t, F.lit(" / "), b)).otherwise(t)
    return table(spark, sf_dir, "part").select(label.alias("label")).distinct()


@query(f"with {_LABELS} select label, {_NORM} as norm from l")
def label_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labels(spark, sf_dir).select("label", T.normalize_label(F.col("label")).alias("norm"))


_ALIASES = "a as (select alias, 'f' || ord % 9 as canonical, ord from (select lower(p_type) || case when ord % 3 = 0 then '' else ' ' || lower(p_brand) end as alias, ord from (select p_type, p_brand, min(p_partkey) as ord from part group by all)))"
_RESOLVED = f"""with {_LABELS}, {_ALIASES}, n as (select label, {_NORM} as norm from l), x as (select alias, arg_max(canonical, ord) as exact from a group by alias),
f as (select label, arg_min(canonical, ord) as fuzzy from n left join x on norm = x.alias join a on exact is null and contains(norm, a.alias) and contains(a.alias, ' ') and length(a.alias) >= 6 group by label)
select n.label, coalesce(exact, fuzzy) as canonical, case when exact is not null then 'exact' when fuzzy is not null then 'fuzzy' else 'none' end as how from n left join x on norm = alias left join f on f.label = n.label"""


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").groupBy("p_type", "p_brand").agg(F.min("p_partkey").alias("ord"))
    alias = F.concat(F.lower("p_type"), F.when(F.col("ord") % 3 == 0, "").otherwise(F.concat(F.lit(" "), F.lower("p_brand"))))
    return C.resolve_aliases(_labels(spark, sf_dir), p.select(alias.alias("alias"), F.concat(F.lit("f"), (F.col("ord") % 9).cast("string")).alias("canonical"), "ord"))


@query(f"select label, canonical from ({_RESOLVED}) where how = 'exact'")
def alias_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir).where("how = 'exact'").select("label", "canonical")


@query(_RESOLVED)
def alias_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir)


_MARKS = {lang: " + ".join("contains(s, '" + m.replace("'", "''") + "')::int" for m in ms) for lang, ms in T.LANGUAGE_MARKERS.items()}
_SPICE = "text || case doc_id % 5 when 0 then ' Chiffre d''affaires et résultat, $ 1,000 EUR 5' when 1 then ' Umsatz und Ergebnis in millions € 10 € 20 $ 3' when 2 then ' ingresos y beneficio en milliers £ 5 £ 6' when 3 then ' revenue and net income, total assets, 12 % in thousands USD 7' else '' end"


def _spiced(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id") % 5
    more = F.when(n == 0, " Chiffre d'affaires et résultat, $ 1,000 EUR 5").when(n == 1, " Umsatz und Ergebnis in millions € 10 € 20 $ 3").when(n == 2, " ingresos y beneficio en milliers £ 5 £ 6").when(n == 3, " revenue and net income, total assets, 12 % in thousands USD 7").otherwise("")
    return table(spark, sf_dir, "documents").select("doc_id", F.concat("text", more).alias("text"))


@query(f"with t as (select doc_id, lower(substr({_SPICE}, 1, 10000)) as s from documents), n as (select doc_id, {_MARKS['fr']} as fr, {_MARKS['es']} as es, {_MARKS['de']} as de from t) select doc_id, case when greatest(fr, es, de) < 2 then 'en' when fr = greatest(fr, es, de) then 'fr' when es = greatest(fr, es, de) then 'es' else 'de' end as language from n")
def language_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spiced(spark, sf_dir).select("doc_id", T.language(F.col("text")).alias("language"))


_CODES = tuple(dict.fromkeys(c for _, c in T.CURRENCY_PATTERNS))
_CUR = ", ".join(" + ".join(f"len(regexp_extract_all(s, '{p}'))" for p, x in T.CURRENCY_PATTERNS if x == c) + f" as {c}" for c in _CODES)
_TOP = f"greatest({', '.join(_CODES)})"


@query(f"with t as (select doc_id, substr({_SPICE}, 1, 20000) as s from documents), n as (select doc_id, {_CUR} from t) select doc_id, case when {_TOP} < 1 then 'USD' {' '.join(f'when {c} = {_TOP} then {c!r}' for c in _CODES)} end as currency from n")
def currency_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spiced(spark, sf_dir).select("doc_id", T.currency(F.col("text")).alias("currency"))


@query(f"with t as (select doc_id, {_SPICE} as s from documents) select doc_id, case {' '.join(f'when regexp_matches(s, {chr(39)}(?i){p}{chr(39)}) then {s!r}' for p, s in T.SCALE_PATTERNS)} end as scale from t")
def scale_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spiced(spark, sf_dir).select("doc_id", T.scale_of(F.col("text")).alias("scale"))


@query(f"with t as (select doc_id, lower(regexp_replace({_SPICE}, '\\s+', ' ', 'g')) as s from documents), h as (select doc_id, list_sort(list_filter([{', '.join(f'case when contains(s, {x!r}) then {x!r} end' for x in T.SIGNALS)}], lambda x: x is not null)) as hits from t) select doc_id, cast(len(hits) as bigint) as n_hits, array_to_string(hits, ',') as hits from h")
def signal_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _spiced(spark, sf_dir).select("doc_id", T.signal_hits(F.col("text")).alias("h"))
    return h.select("doc_id", F.size("h").cast("long").alias("n_hits"), F.array_join("h", ",").alias("hits"))


@query("""with t as (select doc_id, length(text) as chars, len(regexp_extract_all(text, '\\d[\\d.,]*')) as numbers, len(regexp_extract_all(text, '(?m)^\\|.*\\d.*\\|\\s*$')) as rows from documents)
select doc_id, case when rows >= 5 then 'html_table' else 'pdf_text' end as mode, case when chars = 0 then 'EMPTY' when rows >= 5 then 'OK' when chars < 2000 then 'LOW_TEXT' when numbers < 2 then 'LOW_NUMERIC_DENSITY' else 'OK' end as reason from t""")
def text_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("chars"), F.regexp_count("text", F.lit(r"\d[\d.,]*")).alias("numbers"), F.regexp_count("text", F.lit(r"(?m)^\|.*\d.*\|\s*$")).alias("rows"))
    reason = F.when(F.col("chars") == 0, "EMPTY").when(F.col("rows") >= 5, "OK").when(F.col("chars") < 2000, "LOW_TEXT").when(F.col("numbers") < 2, "LOW_NUMERIC_DENSITY").otherwise("OK")
    return t.select("doc_id", F.when(F.col("rows") >= 5, "html_table").otherwise("pdf_text").alias("mode"), reason.alias("reason"))


@query("select page_id, case when u = '' then null when u like 'http://%' or u like 'https://%' then rtrim(u, '/') else rtrim('https://' || u, '/') end as url from (select page_id, case page_id % 4 when 0 then regexp_replace(url, '^https?://', '') || '//' when 1 then ' ' || url || '/ ' when 2 then '' else url end as raw, trim(case page_id % 4 when 0 then regexp_replace(url, '^https?://', '') || '//' when 1 then ' ' || url || '/ ' when 2 then '' else url end) as u from pages)")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, u = F.col("page_id") % 4, F.col("url")
    raw = F.when(n == 0, F.concat(F.regexp_replace(u, "^https?://", ""), F.lit("//"))).when(n == 1, F.concat(F.lit(" "), u, F.lit("/ "))).when(n == 2, "").otherwise(u)
    return table(spark, sf_dir, "pages").select("page_id", T.normalize_url(raw).alias("url"))


@query(r"select page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) as text from pages")
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.strip_html(F.col("html")).alias("text"))


def _statements(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    """Statements written out of orders by status and year, in one layout; one document per nation."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    s = o.withColumn("year", F.year("o_orderdate")).groupBy("c_nationkey", "o_orderstatus").pivot("year", [1999, 2000]).agg(F.sum(F.col("o_totalprice").cast("decimal(20,2)")))
    a, b = (F.coalesce(F.col(f"`{y}`").cast("string"), F.lit("-")) for y in (1999, 2000))
    label = F.concat(F.lit("Total "), F.col("o_orderstatus"))
    if layout == "markdown":
        head = "## BALANCE SHEET\n| | 1999 | 2000 |\n|---|---|---|\n"
        line = F.concat(F.lit("| "), label, F.lit(" | "), a, F.lit(" | "), b, F.lit(" |"))
    elif layout == "vertical":
        head, line = "CONSOLIDATED BALANCE SHEETS\n1999\n2000\nASSETS\n", F.concat_ws("\n", label, a, b)
    else:
        head, line = "BALANCE SHEET\n                              1999                2000\n", F.concat(F.rpad(label, 20, " "), F.lpad(a, 14, " "), F.lpad(b, 20, " "))
    rows = s.groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("o_orderstatus", line.alias("line")))).alias("l"))
    return rows.select(F.col("c_nationkey").cast("string").alias("doc"), F.concat(F.lit(head), F.array_join(F.transform("l", lambda x: x["line"]), "\n")).alias("text"))


_STATEMENT = """with s as (select c_nationkey, o_orderstatus as st, year(o_orderdate) as y, sum(cast(o_totalprice as decimal(20,2))) as v from orders join customer on o_custkey = c_custkey where year(o_orderdate) in (1999, 2000) group by all)
select cast(c_nationkey as varchar) as doc, 'Total ' || st as label, cast(y as varchar) as column_header, cast(v as double) as value from s"""


def _layout_query(name: str, layout: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return B.cells(_statements(spark, sf_dir, layout), layout).select("doc", "label", "column_header", "value").where("value is not null")

    run.__name__ = name
    query(_STATEMENT)(run)


_layout_query("markdown_tables", "markdown")
_layout_query("space_aligned_tables", "aligned")
_layout_query("vertical_balance_sheet", "vertical")


_NARRATIVE = """select cast(doc_id as varchar) as doc, 'net income' as label, '2001' as column_header, cast(n_chars as double) as value, 'millions' as scale from documents"""


def _narrative(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("In 2001 net income was $"), F.format_number("n_chars", 0), F.lit(" million.")).alias("text"))
    return B.cells(d.select(F.col("doc_id").alias("doc"), "text"), "prose").select("doc", "label", "column_header", "value", "scale")


@query(_NARRATIVE)
def narrative_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _narrative(spark, sf_dir)


@query("""with s as (select c_nationkey, year(o_orderdate) as y, sum(cast(o_totalprice as decimal(20,2))) as v from orders join customer on o_custkey = c_custkey where year(o_orderdate) in (1999, 2000) group by all)
select cast(c_nationkey as varchar) as doc, 'FY' || y as period, 'ingresos' as field, cast(v as double) as value from s""")
def ixbrl_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    s = o.groupBy("c_nationkey", F.year("o_orderdate").cast("string").alias("y")).agg(F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("string").alias("v")).where("y in ('1999', '2000')")
    c, y, v = (F.concat(F.lit("c"), F.col("y")), F.col("y"), F.col("v"))
    tag = lambda concept, context, text: F.concat(F.lit(f'<ix:nonFraction name="us-gaap:{concept}" contextRef="'), context, F.lit('" scale="0">'), text, F.lit("</ix:nonFraction>"))
    one = F.concat(F.lit('<xbrli:context id="'), c, F.lit('"><xbrli:period><xbrli:startDate>'), y, F.lit("-01-01</xbrli:startDate><xbrli:endDate>"), y, F.lit("-12-31</xbrli:endDate></xbrli:period></xbrli:context>"), tag("Revenues", c, v), tag("SalesRevenueNet", c, F.lit("1")), tag("Revenues", F.lit("unknown"), F.lit("2")))
    docs = s.groupBy(F.col("c_nationkey").cast("string").alias("doc")).agg(F.array_join(F.array_sort(F.collect_list(one)), "").alias("text"))
    concepts = spark.createDataFrame([("Revenues", "ingresos", 0), ("SalesRevenueNet", "ingresos", 1)], "concept string, field string, preference int")
    return B.ixbrl_facts(docs, concepts).select("doc", "period", "field", "value")


QUERIES, ORACLE_SQL = query.queries, query.sql

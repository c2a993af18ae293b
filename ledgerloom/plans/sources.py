"""Queries over sources, series and joins by time and place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalogue as C
from ..sources.adapters import table
from ..streaming import events as EV
from .registry import Register

query = Register()

_HASHED = r"with h as (select doc_id, lower(trim(regexp_replace(coalesce(text, ''), '[ \t\n\r\f\v]+', ' ', 'g'))) as n from documents), k as (select doc_id, case when n = '' then '' else sha256(n) end as content_hash from h)"
_SRC = """with s as (
  select 'D' || doc_id as source_id, source as ticker, lang as category, 'u' || (doc_id % 700) as url, case when doc_id % 3 = 0 then 'p' || doc_id end as local_path, 1 as type_rank, doc_id as ord from documents
  union all select 'P' || page_id, 'src' || (page_id % 7), 'page', 'u' || (page_id % 90), null, 2, page_id from pages
  union all select 'C' || conv_id, 'src' || (conv_id % 5), 'transcript', null, null, 3, conv_id from (select distinct conv_id from conversations))"""


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("D"), text("doc_id")).alias("source_id"), F.col("source").alias("ticker"), F.col("lang").alias("category"), F.concat(F.lit("u"), (F.col("doc_id") % 700).cast("string")).alias("url"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("p"), text("doc_id"))).alias("local_path"), F.lit(1).alias("type_rank"), F.col("doc_id").alias("ord"))
    p = table(spark, sf_dir, "pages").select(F.concat(F.lit("P"), text("page_id")).alias("source_id"), F.concat(F.lit("src"), (F.col("page_id") % 7).cast("string")).alias("ticker"), F.lit("page").alias("category"), F.concat(F.lit("u"), (F.col("page_id") % 90).cast("string")).alias("url"), F.lit(2).alias("type_rank"), F.col("page_id").alias("ord"))
    c = table(spark, sf_dir, "conversations").select("conv_id").distinct().select(F.concat(F.lit("C"), text("conv_id")).alias("source_id"), F.concat(F.lit("src"), (F.col("conv_id") % 5).cast("string")).alias("ticker"), F.lit("transcript").alias("category"), F.lit(3).alias("type_rank"), F.col("conv_id").alias("ord"))
    return C.union(d, p, c)


@query(f"{_SRC} select source_id, ticker, category, url, local_path, type_rank, ord from (select *, row_number() over (partition by url order by type_rank, local_path is null, ord, source_id) as n from s) where url is null or n = 1")
def source_union_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.best_per(_sources(spark, sf_dir), F.col("url"), F.col("type_rank"), F.col("local_path").isNull().alias("no_path"), F.col("ord"), F.col("source_id"))


@query(f"{_HASHED} select doc_id, content_hash from (select *, row_number() over (partition by content_hash order by doc_id) as n from k) where content_hash = '' or n = 1")
def content_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.dedup_content(table(spark, sf_dir, "documents"))


@query(f"{_SRC} select ticker, category, min(source_id) as source_id, count(*) as n from s group by ticker, category")
def coverage_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.coverage_map(_sources(spark, sf_dir))


@query("""with c as (select source as ticker, ['ANNUAL_REPORT', 'INTERIM_REPORT', 'REGULATORY_FILING', 'IR_NEWS', 'OTHER'][cast(doc_id % 5 + 1 as int)] as type, doc_id as candidate_id, n_chars % 17 as score, doc_id % 29 as date from documents),
t as (select * from c qualify row_number() over (partition by ticker, type order by score desc, date desc, candidate_id) <= case type when 'IR_NEWS' then 3 when 'OTHER' then 2 else 4 end)
select ticker, type, candidate_id, score, row_number() over (partition by ticker order by score desc, date desc, candidate_id) as place from t qualify place <= 12""")
def topk_per_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, (*C.PER_TYPE, "OTHER"))), (F.col("doc_id") % 5 + 1).cast("int"))
    d = table(spark, sf_dir, "documents")
    return C.top_candidates(d.select(F.col("source").alias("ticker"), kind.alias("type"), F.col("doc_id").alias("candidate_id"), (F.col("n_chars") % 17).alias("score"), (F.col("doc_id") % 29).alias("date")))


_ISS = "with i as (select 'N' || c_nationkey as ticker, case when c_nationkey % 3 = 0 then 'sec' when c_nationkey % 3 = 1 then 'eu' else 'asx' end as source_hint, case when c_nationkey % 2 = 0 then '10-K' else '20-F' end as annual_form, case when c_nationkey % 4 = 0 then '1' end as cik, count(*) filter (c_acctbal > 9000) as annual, count(*) filter (c_acctbal > 7500) as total from customer group by c_nationkey), k as (select *, case when source_hint = 'sec' and annual_form = '10-K' then 'Domestic_US' when source_hint = 'sec' or coalesce(cik, '') <> '' then 'FPI_ADR' else 'NonUS_Local' end as issuer_class from i)"


def _issuers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_nationkey")
    c = table(spark, sf_dir, "customer").groupBy(k).agg(F.count_if(F.col("c_acctbal") > 9000).alias("annual"), F.count_if(F.col("c_acctbal") > 7500).alias("total"))
    return C.issuer_class(c.select(F.concat(F.lit("N"), k.cast("string")).alias("ticker"), F.when(k % 3 == 0, "sec").when(k % 3 == 1, "eu").otherwise("asx").alias("source_hint"), F.when(k % 2 == 0, "10-K").otherwise("20-F").alias("annual_form"), F.when(k % 4 == 0, "1").alias("cik"), "annual", "total"))


@query(f"{_ISS} select ticker, issuer_class from k")
def issuer_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issuers(spark, sf_dir).select("ticker", "issuer_class")


@query(f"""{_ISS}, t as (select *, case issuer_class when 'Domestic_US' then 3 when 'FPI_ADR' then 2 else 1 end as la, case issuer_class when 'Domestic_US' then 10 when 'FPI_ADR' then 5 else 1 end as lt from k)
select ticker, issuer_class, case when annual >= la and total >= lt then 'PASS' else 'NEEDS_ACTION' end as status, concat_ws(',', case when annual < la then 'annual_below_min' end, case when total < lt then 'total_below_min' end) as issues from t""")
def coverage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.coverage_audit(_issuers(spark, sf_dir))


_DAY = "with d as (select event_type, cast(ts as date) as day, cast(round(cast(sum(cast(value as decimal(20,6))) as double) * 100) as bigint) as total from events group by all)"


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.round(F.sum(F.col("value").cast("decimal(20,6)")).cast("double") * 100).cast("long").alias("total"))


@query(f"{_DAY} select event_type, day, avg(total) over w as mean, max(total) over w as high, min(total) over w as low from d window w as (partition by event_type order by day rows between 6 preceding and current row)", dates=("day",))
def trailing_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.trailing(_days(spark, sf_dir), "event_type", "day", "total", 7)


@query(f"{_DAY} select event_type, day, avg(total) over w as mean, max(total) over w as high, min(total) over w as low from d window w as (partition by event_type order by day rows between 251 preceding and current row)", dates=("day",))
def range_52w(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.trailing(_days(spark, sf_dir), "event_type", "day", "total", 252)


_ASOF = "with e as (select event_id as row_id, user_id, floor(epoch(ts))::bigint as t, event_type, value from events), r as (select row_id, user_id, t from e where event_type = 'purchase'), m as (select user_id, t, max(row_id) as mark from e where event_type = 'click' group by user_id, t)"


def _asof(spark: SparkSession, sf_dir: str, within: int | None) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), "user_id", F.unix_timestamp("ts").alias("t"), "event_type")
    marks = e.where("event_type = 'click'").groupBy("user_id", "t").agg(F.max("row_id").alias("mark"))
    return C.as_of(e.where("event_type = 'purchase'").select("row_id", "user_id", "t"), marks, "user_id", "t", "mark", within)


@query(f"{_ASOF} select r.row_id, r.user_id, r.t, m.mark from r asof left join m on r.user_id = m.user_id and r.t >= m.t")
def asof_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir, None)


@query(f"{_ASOF} select r.row_id, r.user_id, r.t, case when r.t - m.t <= 86400 then m.mark end as mark from r asof left join m on r.user_id = m.user_id and r.t >= m.t")
def asof_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir, 86400)


_NEAREST = """with t as (select l_orderkey * 10 + l_linenumber as row_id, l_suppkey as line, cast(l_quantity * 3 as int) as place, l_partkey from lineitem), a as (select s_suppkey as line, unnest([10, 50, 90, 140]) + cast(s_suppkey % 7 as int) as anchor from supplier),
j as (select row_id, line, place, abs(anchor - place) as distance, 'P' || anchor as period, anchor from t join a using (line))
select row_id, line, place, distance, period from (select distinct * from j) qualify row_number() over (partition by row_id, line, place order by distance, anchor) = 1"""


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"), F.col("l_suppkey").alias("line"), (F.col("l_quantity") * 3).cast("int").alias("place")).distinct()
    a = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("line"), F.explode(F.array(*map(F.lit, (10, 50, 90, 140)))).alias("a")).select("line", (F.col("a") + (F.col("line") % 7).cast("int")).alias("anchor"))
    return C.nearest(tokens, a.withColumn("period", F.concat(F.lit("P"), F.col("anchor").cast("string"))), "line")


@query(_NEAREST)
def nearest_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir)


@query("""with l as (select doc_id as doc, unnest(string_split(text, chr(10))) as text, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line from documents),
h as (select doc, cast(line as bigint) as line, text, max(case when length(text) < 40 then line end) over (partition by doc order by line rows unbounded preceding) as hl from l)
select h.doc, h.line, case when h.line - h.hl < 5 then s.text end as section from h left join h s on s.doc = h.doc and s.line = h.hl""")
def section_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("line", "text")).select("doc", F.col("line").cast("long").alias("line"), "text")
    return C.sections(lines, F.length("text") < 40, 5)


@query(r"""select page_id, cast(k - 1 as bigint) as place, h as href from (select page_id, unnest(a) as h, generate_subscripts(a, 1) as k from (select page_id, regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']([^"''#]+)', 1) as a from pages))""")
def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.links(table(spark, sf_dir, "pages"))


@query("select conv_id, count(*) as n_turns, string_agg(role || ': ' || text, chr(10) order by turn, role || ': ' || text) as text from conversations group by conv_id")
def transcript_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.transcript(table(spark, sf_dir, "conversations"))


@query(r"""with t as (select distinct o_orderpriority || ' ' || (o_orderkey % 40) as target from orders), c as (select distinct o_orderpriority || ' ' || (o_custkey % 60) || ' inc' as candidate from orders),
tw as (select target, unnest(list_distinct(list_filter(string_split_regex(lower(target), '[^a-z0-9]+'), lambda x: x <> ''))) as w from t), cw as (select candidate, unnest(list_distinct(list_filter(string_split_regex(lower(candidate), '[^a-z0-9]+'), lambda x: x <> ''))) as w from c),
nt as (select target, count(*) as nt from tw group by target), nc as (select candidate, count(*) as nc from cw group by candidate),
s as (select target, candidate, round(n / (nt + nc - n), 6) as score from (select target, candidate, count(*) as n from tw join cw using (w) group by target, candidate) join nt using (target) join nc using (candidate))
select target, candidate, score from s where score >= 0.5 qualify row_number() over (partition by target order by score desc, candidate) = 1""")
def issuer_match_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    t = o.select(F.concat("o_orderpriority", F.lit(" "), (F.col("o_orderkey") % 40).cast("string")).alias("target")).distinct()
    c = o.select(F.concat("o_orderpriority", F.lit(" "), (F.col("o_custkey") % 60).cast("string"), F.lit(" inc")).alias("candidate")).distinct()
    return C.issuer_matches(t, c)


@query("select date_trunc('day', ts) as window_start, event_type, count(*) as n, round(cast(sum(cast(value as decimal(20,6))) as double), 4) as total from events group by all")
def events_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.windowed(table(spark, sf_dir, "events"))


@query("""with e as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minutes then 0 else 1 end as new from events), s as (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from e)
select user_id, min(ts) as session_start, max(ts) + interval 30 minutes as session_end, count(*) as n from s group by user_id, k""")
def events_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.sessions(table(spark, sf_dir, "events"))


QUERIES, ORACLE_SQL = query.queries, query.sql

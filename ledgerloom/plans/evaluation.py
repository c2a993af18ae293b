"""Queries over evaluation and diagnosis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assemble as S
from ..operators import evaluate as E
from ..operators import gates as G
from ..sources import adapters as A
from . import finance
from .registry import Register

query = Register()

_OK = "case when t.expected = 0 then abs(f.value) < 0.01 else abs(f.value - t.expected) / abs(t.expected) <= 0.01 end"
_CAT = "case " + " ".join(f"when field = '{f}' then '{c}'" for f, c in E.CATEGORY.items()) + " else 'other' end"
_DETAIL = f"""with {A.TRUTH_SQL},
detail as (
  select t.ticker, t.period_key, t.field, t.period_type, t.expected, f.value as actual, case when f.value is null then 'missed' when {_OK} then 'matched' else 'wrong' end as status
  from truth t left join long_facts f on f.ticker = t.ticker and f.period_key = t.period_key and f.field = t.field where t.expected is not null),
extra as (select f.ticker, f.period_key, f.field, f.value from long_facts f anti join truth t on f.ticker = t.ticker and f.period_key = t.period_key and f.field = t.field),
report as (
  select d.*, coalesce(e.extra, 0) as extra, round(matched * 100.0 / expected, 2) as score, round((matched + wrong) * 100.0 / expected, 2) as coverage
  from (select ticker, count(*) as expected, count(*) filter (status = 'matched') as matched, count(*) filter (status = 'wrong') as wrong, count(*) filter (status = 'missed') as missed from detail group by ticker) d
  left join (select ticker, count(*) as extra from extra group by ticker) e on e.ticker = d.ticker),
gaps as (
  select * from (select *, count(*) filter (status = 'missed') over (partition by ticker, period_key) / count(*) over (partition by ticker, period_key) as miss_rate, {_CAT} as category from detail) where status <> 'matched')"""


def _both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return A.truth(spark, sf_dir), A.long_facts(spark, sf_dir)


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.gaps(E.detail(*_both(spark, sf_dir)))


@query(f"{_DETAIL} select * from detail")
def eval_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.detail(*_both(spark, sf_dir))


@query(f"{_DETAIL} select * from report")
def eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.report(*_both(spark, sf_dir))


@query(f"{_DETAIL} select * from extra")
def eval_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.extra(*_both(spark, sf_dir))


#: Where a value came from, made of its key.
_ORIGIN = "case when length(field) % 7 = 0 then '' else 'F-' || period_key end"
_READY = finance._GATES.removeprefix("with ").replace(A.FACTS_SQL + ",", "", 1)


@query(f"""{_DETAIL}, {_READY},
trust as (select ticker, greatest(0, least(100, 100 - 15 * count(*) filter (status = 'FAIL') - 5 * count(*) filter (status = 'WARNING') - 10 * count(*) filter (status = 'SKIP'))) as confidence from gates group by ticker),
prov as (select ticker, round(count(*) filter ({_ORIGIN} <> '' and length(period_key) <> 6) * 100.0 / count(*), 2) as p from detail where actual is not null group by ticker)
select r.ticker, round(greatest(0.0, score * 0.4 + coverage * 0.2 + coalesce(confidence, 0) * 0.2 + coalesce(p, 0.0) * 0.2 - least(15.0, extra * 100.0 / expected)), 2) as readiness from report r left join trust using (ticker) left join prov using (ticker)""")
def readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, f = _both(spark, sf_dir)
    origins = f.select(*E.KEY, F.when(F.length("field") % 7 == 0, "").otherwise(F.concat(F.lit("F-"), F.col("period_key"))).alias("filing"), F.when(F.length("period_key") != 6, "table").alias("method"))
    return E.readiness(E.report(t, f), G.summary(finance._gates(spark, sf_dir)), E.provenance(E.detail(t, f), origins))


@query(f"{_DETAIL} select row_number() over (order by n desc, field, status) as rank, field, status, n, tickers from (select field, status, count(*) as n, string_agg(distinct ticker, ',' order by ticker) as tickers from gaps group by field, status)")
def hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.hotspots(_gaps(spark, sf_dir))


@query(f"{_DETAIL} select period_type, category, status, count(*) as n, count(distinct ticker) as tickers from gaps group by grouping sets ((period_type), (category), (status))")
def gaps_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.gap_sets(_gaps(spark, sf_dir))


@query(f"""{_DETAIL}, g as (
  select field, status, count(*) as n, count(distinct ticker) as tickers, avg((miss_rate > 0.5)::int) as many,
    list_sort(list_filter((list(case when expected <> 0 then actual / expected end order by ticker, period_key, case when expected <> 0 then actual / expected end nulls first))[1:3], lambda x: x is not null)) as rs from gaps group by field, status),
m as (select *, rs[len(rs) // 2 + 1] as med from g)
select field, status, n, tickers, case when status = 'missed' and many >= 0.6 then 'period_mapping_failure' when status = 'missed' then 'missing_extraction' when med between 900 and 1100 then 'scale_1k' when med between 0.0009 and 0.0011 then 'scale_001'
  when med between 45000 and 110000 then 'scale_100k' when med between 90 and 110 then 'scale_100' when med between -1.05 and -0.95 then 'sign_mismatch' else 'value_deviation' end as root_cause from m""")
def root_cause(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.root_cause(_gaps(spark, sf_dir))


@query(f"{_DETAIL} select coalesce(ticker, 'TOTAL') as ticker, cast(sum(expected) as bigint) as expected, cast(sum(matched) as bigint) as matched, cast(sum(wrong) as bigint) as wrong, cast(sum(missed) as bigint) as missed, cast(sum(extra) as bigint) as extra, round(sum(matched) * 100.0 / sum(expected), 2) as score from report group by rollup (ticker)")
def dashboard_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.dashboard(E.report(*_both(spark, sf_dir)))


@query(f"""with {A.TRUTH_SQL}, j as (select coalesce(f.ticker, t.ticker) as ticker, f.value as d, t.expected as t from long_facts f full join truth t on f.ticker = t.ticker and f.period_key = t.period_key and f.field = t.field)
select ticker, count(*) filter (d is not null and t is not null) as common, count(*) filter (t is null) as only_draft, count(*) filter (d is null) as only_truth, count(*) filter (case when t = 0 then abs(d) < 0.01 else abs(d - t) / abs(t) <= 0.01 end) as agree from j group by ticker""")
def draft_vs_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, f = _both(spark, sf_dir)
    return E.draft_vs_truth(f, t)


#: Numbers as whole thousandths, cut where no value lies, so that no two engines' last bits tell.
_WHOLE = "cast(floor({} * 1000 + 0.23712345) as bigint)"
_TOLD = f"'{{\"actual\":' || coalesce(cast({_WHOLE.format('actual')} as varchar), 'null') || ',\"expected\":' || cast({_WHOLE.format('expected')} as varchar) || ',\"field\":\"' || field || '\",\"period_key\":\"' || period_key || '\",\"status\":\"' || status || '\",\"ticker\":\"' || ticker || '\"}}'"


@query(f"""{_DETAIL}, h as (select cast(('0x' || substr(sha256({_TOLD}), 1, 12)) as bigint) as h from detail)
select count(*) as n, sha256(cast(count(*) as varchar) || ':' || cast(sum(h) as varchar)) as signature from h""")
def result_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = E.detail(*_both(spark, sf_dir)).drop("period_type")
    return E.signature(d.withColumns({c: F.expr(_WHOLE.format(c)).cast("string") for c in ("actual", "expected")}), plain=("actual", "expected"))


@query(f"""with {A.LONG_SQL}, v as (select ticker, period_key, field, {_WHOLE.format('value')} as v from long_facts),
p as (select ticker, period_key, '{{"fecha_fin":"' || right(period_key, 4) || case left(period_key, 2) when 'Q1' then '-03-31' when 'Q2' then '-06-30' when 'H1' then '-06-30' when 'Q3' then '-09-30' else '-12-31' end || '","tipo_periodo":"' || case left(period_key, 1) when 'F' then 'anual' when 'Q' then 'trimestral' else 'semestral' end
  || '","fields":{{' || string_agg('"' || field || '":' || v, ',' order by field) || '}}}}' as j from v group by ticker, period_key)
select ticker, '{{"ticker":"' || ticker || '","periods":{{' || string_agg('"' || period_key || '":' || j, ',' order by period_key) || '}}}}' as payload from p group by ticker""")
def extraction_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as whole thousandths, so that the text is the same in every engine."""
    return S.extraction_result(A.long_facts(spark, sf_dir).select("ticker", "period_key", "field", F.expr(_WHOLE.format("value")).alias("value")))


@query()
def truth_pack_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.truth_pack(A.long_facts(spark, sf_dir), finance._derived(spark, sf_dir), finance._gates(spark, sf_dir))


@query(f"""with {A.TRUTH_SQL}, v as (select ticker, period_key, field, unnest(list_filter([case when not regexp_matches(period_key, '^(FY\\d{{4}}|Q[1-4]-\\d{{4}}|H[12]-\\d{{4}})$') then 'bad_period' end,
  case when field not in ('ingresos', 'ebit', 'net_income', 'cfo', 'capex', 'total_assets') then 'unknown_field' end, case when expected is null then 'no_value' end, case when field = 'capex' and expected > 0 then 'capex_positive' end,
  case when field in ('ingresos', 'total_assets', 'shares_outstanding') and expected < 0 then 'negative' end], lambda x: x is not null)) as rule from truth) select * from v""")
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = A.truth(spark, sf_dir).select("ticker", "period_key", "field", F.col("expected").alias("value"))
    return S.violations(t, ["ingresos", "ebit", "net_income", "cfo", "capex", "total_assets"])


@query(f"with {A.LONG_SQL}, a as (select distinct field from long_facts), b as (select unnest([{', '.join(repr(c) for c in G.CANONICAL)}]) as field) select field, 'left' as side from (select * from a except all select * from b) union all select field, 'right' from (select * from b except all select * from a)")
def canonical_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = A.long_facts(spark, sf_dir).select("field").distinct()
    return S.drift(have, spark.createDataFrame([(c,) for c in G.CANONICAL], "field string"))


QUERIES, ORACLE_SQL = query.queries, query.sql

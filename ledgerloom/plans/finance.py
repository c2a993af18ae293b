"""Queries over period facts: trailing twelve months, metrics, gates, resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import periods as P
from ..operators import gates as G
from ..operators import metrics as M
from ..operators import resolve as R
from ..operators import ttm as T
from ..sources import adapters as A
from .registry import Register

query = Register()
AS_OF_YEAR = 2003
S = T.SUMMABLE
_sum = lambda f: ", ".join(f(c) for c in S)

_FACTS = f"with {A.FACTS_SQL}"
_Q4 = f"""{_FACTS},
per_year as (
  select ticker, year, sum(1 << ord) as have, {_sum(lambda c: f"case when count({c}) filter (ord <= 3) = 3 then sum({c}) filter (ord <= 3) end as q_{c}")}
  from facts where period_type = 'quarterly' group by ticker, year),
synth as (
  select f.ticker, 'Q4-' || f.year as period_key, 'quarterly' as period_type, f.year, 4 as ord, make_date(f.year, 12, 31) as end_date, {_sum(lambda c: f"{c} - q_{c} as {c}")}
  from facts f join per_year p on f.ticker = p.ticker and f.year = p.year where f.period_type = 'annual' and have = 14 and ingresos - q_ingresos is not null),
quarters as (
  select ticker, period_key, period_type, year, ord, end_date, {_sum(str)}, false as synthetic from facts where period_type = 'quarterly'
  union all select ticker, period_key, period_type, year, ord, end_date, {_sum(str)}, true from synth),
ranked as (
  select *, row_number() over w as back, date_diff('day', end_date, lag(end_date) over w) as gap from quarters window w as (partition by ticker order by end_date desc, period_key desc)),
last_four as (
  select ticker, count(*) as n, max(end_date) as end_date, bool_or(synthetic) as has_synthetic,
    bool_and(coalesce(gap between 30 and 120, true)) and date_diff('day', min(end_date), max(end_date)) between 240 and 460 as consecutive,
    {_sum(lambda c: f"case when count({c}) = 4 then sum({c}) end as {c}")}
  from ranked where back <= 4 group by ticker)"""
_CASCADE = f"""{_Q4},
h1 as (select *, row_number() over (partition by ticker order by end_date desc, period_key desc) as back from facts where period_type = 'semestral' and ord = 1),
semestral as (
  select n.ticker, n.end_date, {_sum(lambda c: f"f.{c} + n.{c} - o.{c} as {c}")}
  from h1 n join h1 o on n.ticker = o.ticker and n.back = 1 and o.back = 2 and n.year - o.year = 1
  join facts f on f.ticker = n.ticker and f.period_type = 'annual' and f.year = o.year
  where n.ebit is not null and o.ebit is not null and f.ebit is not null and n.cfo is not null and o.cfo is not null and f.cfo is not null),
fy0 as (
  select ticker, period_key, year, end_date, {_sum(str)} from facts
  where period_type = 'annual' and ingresos is not null and (ingresos is not null)::int + (ebit is not null)::int + (net_income is not null)::int + (cfo is not null)::int + (capex is not null)::int >= 3
  qualify row_number() over (partition by ticker order by end_date desc, period_key desc) = 1),
chosen as (
  select i.ticker, coalesce(q.n = 4 and q.consecutive, false) as by_q, q.ingresos is not null and q.ebit is null and q.net_income is null and q.cfo is null as sparse,
    s.ticker is not null as has_s, f.ticker is not null as has_f, coalesce(q.n = 4 and not q.consecutive, false) as rejected,
    q.end_date as q_end, s.end_date as s_end, f.end_date as f_end, {_sum(lambda c: f"q.{c} as q_{c}, s.{c} as s_{c}, f.{c} as f_{c}")}
  from (select distinct ticker from facts) i left join last_four q on q.ticker = i.ticker left join semestral s on s.ticker = i.ticker left join fy0 f on f.ticker = i.ticker),
cascade_ as (
  select ticker, case when has_s and (not by_q or sparse) then 'semestral_FY_H1' when by_q then 'suma_4_trimestres' when has_f then 'FY0_fallback' else 'no_disponible' end as metodo, rejected,
    case when has_s and (not by_q or sparse) then s_end when by_q then q_end else f_end end as end_date,
    {_sum(lambda c: f"case when has_s and (not by_q or sparse) then s_{c} when by_q then q_{c} else f_{c} end as {c}")}
  from chosen)"""
_BAL = ("total_assets", "total_liabilities", "total_equity", "total_debt", "cash_and_equivalents", "shares_outstanding")
_METRICS = f"""{_CASCADE}, {A.MARKET_SQL},
balance as (select ticker, {', '.join(_BAL)} from facts where period_type = 'annual' qualify row_number() over (partition by ticker order by end_date desc, period_key desc) = 1),
inputs as (
  select c.ticker, metodo, rejected, {_sum(lambda x: f"case when c.ingresos is not null then c.{x} else f.{x} end as {x}")}, {', '.join('b.' + x for x in _BAL)}, nullif(market_cap, 0) as market_cap, coalesce(nullif(shares, 0), shares_outstanding) as shares
  from cascade_ c left join fy0 f on f.ticker = c.ticker left join balance b on b.ticker = c.ticker left join market m on m.ticker = c.ticker),
more as (select *, cfo - abs(capex) as fcf, market_cap + total_debt - cash_and_equivalents as ev, total_debt - cash_and_equivalents as net_debt, coalesce(gross_profit, ingresos - cost_of_revenue) as gross from inputs),
derived as (
  select ticker, metodo, rejected, fcf, ev, net_debt,
    case when ingresos > 0 then round(gross / ingresos * 100, 2) end as gross_margin_pct, case when ingresos > 0 then round(ebit / ingresos * 100, 2) end as operating_margin_pct,
    case when ingresos > 0 then round(net_income / ingresos * 100, 2) end as net_margin_pct, case when ingresos > 0 then round(fcf / ingresos * 100, 2) end as fcf_margin_pct,
    case when total_debt + total_equity > 0 then round(ebit * (1 - 0.21) / (total_debt + total_equity) * 100, 2) end as roic_pct, case when total_equity > 0 then round(net_income / total_equity * 100, 2) end as roe_pct,
    case when total_assets > 0 then round(net_income / total_assets * 100, 2) end as roa_pct, case when ebit > 0 then round(ev / ebit, 4) end as ev_ebit, case when fcf > 0 then round(ev / fcf, 4) end as ev_fcf,
    case when fcf > 0 then round(market_cap / fcf, 4) end as p_fcf, case when market_cap > 0 then round(fcf / market_cap * 100, 4) end as fcf_yield_pct,
    case when shares > 0 then round(net_income / shares, 4) end as eps, case when shares > 0 then round(fcf / shares, 4) end as fcf_per_share, case when shares > 0 then round(total_equity / shares, 4) end as bv_per_share
  from more)"""
_GATES = f"""{_METRICS},
yr as (select *, row_number() over (partition by ticker order by end_date desc, period_key desc) as back from facts where period_type = 'annual'),
bal as (
  select ticker, coalesce(total_assets, total_liabilities + total_equity) as a, coalesce(total_liabilities, total_assets - total_equity) as l, coalesce(total_equity, total_assets - total_liabilities) as e
  from yr where coalesce(total_assets, total_liabilities, total_equity) is not null qualify row_number() over (partition by ticker order by back) = 1),
cf as (select ticker, cfo + cfi + cff as bridge, delta_cash from yr where cfo is not null and cfi is not null and cff is not null qualify row_number() over (partition by ticker order by back) = 1),
units as (
  select ticker, bool_or(r >= 1000 or r <= 0.001) as bad from (
    select ticker, unnest([case when lag(ingresos) over w <> 0 then abs(ingresos / lag(ingresos) over w) end, case when lag(ebit) over w <> 0 then abs(ebit / lag(ebit) over w) end,
      case when lag(net_income) over w <> 0 then abs(net_income / lag(net_income) over w) end, case when lag(cfo) over w <> 0 then abs(cfo / lag(cfo) over w) end]) as r
    from yr window w as (partition by ticker order by end_date, period_key)) group by ticker),
share as (select ticker, ({' + '.join(f'count({c})' for c in G.CANONICAL if c in A.FIELDS)}) / (count(*) * 29) * 100 as pct from facts group by ticker),
base as (select ticker, year as base, ingresos as rev from yr where back = 1),
gates as (
  select i.ticker, g.gate, g.gate in ('BALANCE_IDENTITY', 'CASHFLOW_IDENTITY', 'TTM_CONSECUTIVE') as critical, case g.gate
    when 'BALANCE_IDENTITY' then case when bal.ticker is null then 'SKIP' when a is null or l is null or e is null then 'FAIL' when l + e = 0 then 'SKIP' when abs(a - (l + e)) / abs(l + e) <= 0.02 then 'PASS' else 'FAIL' end
    when 'CASHFLOW_IDENTITY' then case when cf.ticker is null or delta_cash is null then 'SKIP'
      when abs(bridge - delta_cash) / greatest(abs(delta_cash), abs(bridge), 1.0) <= 0.05 or abs(bridge - delta_cash) <= greatest(50000.0, greatest(abs(delta_cash), abs(bridge), 1.0) * 0.005) then 'PASS'
      when abs(bridge - delta_cash) / greatest(abs(delta_cash), abs(bridge), 1.0) <= 0.10 then 'WARNING' else 'FAIL' end
    when 'UNIDADES_SANITY' then case when units.bad then 'FAIL' else 'PASS' end
    when 'EV_SANITY' then case when d.ev is null then 'SKIP' when d.ev >= 0 then 'PASS' else 'WARNING' end
    when 'MARGIN_SANITY' then case when coalesce(d.gross_margin_pct not between -10 and 90, false) or coalesce(d.operating_margin_pct not between -50 and 60, false) or coalesce(d.net_margin_pct not between -100 and 50, false) then 'WARNING' else 'PASS' end
    when 'TTM_SANITY' then case when c.metodo = 'no_disponible' or c.ingresos is null or rev is null or rev = 0 then 'SKIP' when c.ingresos / rev between 0.5 and 2.0 then 'PASS' else 'WARNING' end
    when 'TTM_CONSECUTIVE' then case when c.metodo = 'no_disponible' then 'SKIP' when c.metodo = 'FY0_fallback' and c.rejected then 'WARNING' else 'PASS' end
    when 'RECENCY_SANITY' then case when base is null then 'SKIP' when {AS_OF_YEAR} - base > 2 then 'WARNING' else 'PASS' end
    when 'DATA_COMPLETENESS' then case when pct >= 50 then 'PASS' else 'WARNING' end end as status
  from (select distinct ticker from facts) i cross join (select unnest([{', '.join(f"'{g}'" for g in G.GATES)}]) as gate) g
  left join bal on bal.ticker = i.ticker left join cf on cf.ticker = i.ticker left join units on units.ticker = i.ticker left join derived d on d.ticker = i.ticker left join cascade_ c on c.ticker = i.ticker left join base on base.ticker = i.ticker left join share on share.ticker = i.ticker)"""


@query(f"{_FACTS} select * from facts", dates=("end_date",))
def facts_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.facts(spark, sf_dir)


@query(f"""{_FACTS}, keys as (select distinct period_key as k from facts union all select lower(period_key) || case when year % 3 = 0 then 'z' else '' end from facts where period_type = 'quarterly' union all select '9M-' || year from facts where period_type = 'annual'),
t as (select k, upper(trim(k)) as u from keys)
select k as period_key, case when regexp_matches(u, '^FY\\d{{4}}$') then 'annual' when regexp_matches(u, '^Q[1-4]-\\d{{4}}$') then 'quarterly' when regexp_matches(u, '^H[12]-\\d{{4}}$') then 'semestral' when regexp_matches(u, '^9M-\\d{{4}}$') then 'ytd' else 'unknown' end as kind,
  try_cast(regexp_extract(k, '(\\d{{4}})$', 1) as int) as year,
  case when regexp_matches(u, '^FY\\d{{4}}$') then make_date(try_cast(right(u, 4) as int), 12, 31) when regexp_matches(u, '^Q[1-4]-\\d{{4}}$') then last_day(make_date(try_cast(right(u, 4) as int), 3 * try_cast(u[2] as int), 1))
    when regexp_matches(u, '^H[12]-\\d{{4}}$') then last_day(make_date(try_cast(right(u, 4) as int), 6 * try_cast(u[2] as int), 1)) when regexp_matches(u, '^9M-\\d{{4}}$') then make_date(try_cast(right(u, 4) as int), 9, 30) end as end_date from t""", dates=("end_date",))
def period_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = A.facts(spark, sf_dir)
    keys = f.select("period_key").distinct()
    keys = keys.unionByName(f.where("period_type = 'quarterly'").select(F.concat(F.lower("period_key"), F.when(F.col("year") % 3 == 0, "z").otherwise("")).alias("period_key")))
    keys = keys.unionByName(f.where("period_type = 'annual'").select(F.concat(F.lit("9M-"), F.col("year").cast("string")).alias("period_key")))
    k = F.col("period_key")
    return keys.select(k, P.period_type(k).alias("kind"), P.period_year(k).alias("year"), P.period_end(k).alias("end_date"))


@query(f"{_Q4} select * from synth", dates=("end_date",))
def synthetic_q4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.synthetic_q4(A.facts(spark, sf_dir))


@query(f"{_Q4} select * from last_four", dates=("end_date",))
def quarters_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.last_four(A.facts(spark, sf_dir))


@query(f"{_Q4} select ticker, end_date, has_synthetic, {_sum(str)} from last_four where n = 4 and consecutive", dates=("end_date",))
def ttm_four_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.four_quarters(A.facts(spark, sf_dir))


@query(f"{_CASCADE} select * from semestral", dates=("end_date",))
def ttm_semestral(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.semestral(A.facts(spark, sf_dir))


@query(f"{_CASCADE} select * from fy0", dates=("end_date",))
def fy0_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.fy0(A.facts(spark, sf_dir))


@query(f"{_CASCADE} select * from cascade_", dates=("end_date",))
def ttm_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.cascade(A.facts(spark, sf_dir))


@query(f"{_FACTS} select ticker, period_key, year, {', '.join(_BAL)} from facts where period_type = 'annual' qualify row_number() over (partition by ticker order by end_date desc, period_key desc) = 1")
def latest_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.latest_balance(A.facts(spark, sf_dir), M.BALANCE)


@query(f"{_FACTS}, y as (select distinct ticker, year from facts where period_type = 'annual'), r as (select *, year - row_number() over (partition by ticker order by year) as run from y) select ticker, min(year) as first_year, max(year) as last_year, count(*) as n from r group by ticker, run")
def islands_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.islands(A.facts(spark, sf_dir))


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts, the cascade and the metrics; the latter two have a row per issuer and are kept, as gates read them several times."""
    f = A.facts(spark, sf_dir)
    t = T.cascade(f).persist()
    return f, t, M.derived(M.inputs(f, A.market(spark, sf_dir), t)).persist()


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir)[2]


def _metric_query(name: str, columns: tuple[str, ...]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _derived(spark, sf_dir).select("ticker", *columns)

    run.__name__ = name
    query(f"{_METRICS} select ticker, {', '.join(columns)} from derived")(run)


_metric_query("margins", ("gross_margin_pct", "operating_margin_pct", "net_margin_pct", "fcf_margin_pct"))
_metric_query("returns", ("roic_pct", "roe_pct", "roa_pct"))
_metric_query("multiples", ("ev", "net_debt", "ev_ebit", "ev_fcf", "p_fcf", "fcf_yield_pct"))
_metric_query("per_share", ("eps", "fcf_per_share", "bv_per_share"))


@query(f"{_METRICS} select * from derived")
def derived_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir)


#: Depreciation and the fields that are there already, made of other facts.
_KNOWN = "k as (select ticker, period_key, year, ebit, cfo, capex, case when year % 3 <> 0 then cost_of_revenue / 4 end as depreciation_amortization, case when year % 2 = 0 and period_type = 'annual' then ebit * 1.1 end as ebitda, case when period_type = 'semestral' then cfo end as fcf from facts)"


@query(f"""{_FACTS}, {_KNOWN} select ticker, period_key, 'ebitda' as field, ebit + depreciation_amortization as value from k where ebitda is null and ebit is not null and depreciation_amortization is not null and year <> 1997
union all select ticker, period_key, 'fcf', cfo - abs(capex) from k where fcf is null and cfo is not null and capex is not null""")
def derive_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, year = A.facts(spark, sf_dir), F.col("year")
    k = f.select("ticker", "period_key", "year", "ebit", "cfo", "capex", F.when(year % 3 != 0, F.col("cost_of_revenue") / 4).alias("depreciation_amortization"), F.when((year % 2 == 0) & (F.col("period_type") == "annual"), F.col("ebit") * 1.1).alias("ebitda"), F.when(F.col("period_type") == "semestral", F.col("cfo")).alias("fcf"))
    return M.derive_missing(k, f.where("year = 1997").select("ticker", "period_key", F.lit("ebitda").alias("field")))


def _gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.gates(*_parts(spark, sf_dir), AS_OF_YEAR)


@query(f"{_GATES} select ticker, gate, critical, status from gates")
def gate_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gates(spark, sf_dir)


@query(f"{_GATES} select ticker, status from gates where gate = 'BALANCE_IDENTITY'")
def gate_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.balance_identity(A.facts(spark, sf_dir))


@query(f"{_GATES} select ticker, status from gates where gate = 'CASHFLOW_IDENTITY' and ticker in (select ticker from cf)")
def gate_cashflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.cashflow_identity(A.facts(spark, sf_dir))


@query(f"{_GATES} select ticker, status from gates where gate = 'UNIDADES_SANITY'")
def gate_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.unit_jumps(A.facts(spark, sf_dir))


@query(f"{_GATES} select ticker, status from gates where gate = 'MARGIN_SANITY'")
def gate_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.margin_sanity(_derived(spark, sf_dir))


@query(f"{_FACTS} select ticker, cast({' + '.join(f'count({c})' for c in G.CANONICAL if c in A.FIELDS)} as bigint) as present, count(*) * 29 as total, round(({' + '.join(f'count({c})' for c in G.CANONICAL if c in A.FIELDS)}) * 100.0 / (count(*) * 29), 1) as completeness_pct from facts group by ticker")
def gate_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.completeness(A.facts(spark, sf_dir))


for _g, _n in (("TTM_SANITY", "gate_ttm"), ("TTM_CONSECUTIVE", "gate_ttm_consecutive"), ("RECENCY_SANITY", "gate_recency"), ("EV_SANITY", "gate_ev")):

    def _one(spark: SparkSession, sf_dir: str, gate: str = _g) -> DataFrame:
        return _gates(spark, sf_dir).where(F.col("gate") == gate).select("ticker", "status")

    _one.__name__ = _n
    query(f"{_GATES} select ticker, status from gates where gate = '{_g}'")(_one)


@query(f"""{_GATES} select ticker, cast(greatest(0, least(100, 100 - 15 * f - 5 * w - 10 * s)) as bigint) as confidence, case when bad then 'FAIL' when f > 0 or w > 0 then 'PARTIAL' else 'PASS' end as status, f as n_fail, w as n_warning, s as n_skip
from (select ticker, count(*) filter (status = 'FAIL') as f, count(*) filter (status = 'WARNING') as w, count(*) filter (status = 'SKIP') as s, bool_or(critical and status in ('FAIL', 'SKIP')) as bad from gates group by ticker)""")
def gate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.summary(_gates(spark, sf_dir))


@query(f"""{_FACTS}, f2 as (select * replace (case when year = 1998 then -capex else capex end as capex, case when year = 1999 and period_type = 'annual' then ingresos * 20 else ingresos end as ingresos, case when year = 2000 then gross_profit * 2 else gross_profit end as gross_profit) from facts),
y as (select ticker, period_key, field, abs(value / nullif(lag(value) over (partition by ticker, field order by end_date, period_key), 0)) as r from (unpivot (select ticker, period_key, end_date, ingresos, net_income, total_assets from f2 where period_type = 'annual') on ingresos, net_income, total_assets into name field value value))
select ticker, period_key, 'capex' as field, 'capex_positive' as warning from f2 where capex > 0 union all select ticker, period_key, 'ingresos', 'revenue_negative' from f2 where ingresos < 0
union all select ticker, period_key, 'gross_profit', 'gp_gt_revenue' from f2 where ingresos > 0 and gross_profit > ingresos union all select ticker, period_key, field, 'yoy_jump' from y where r > 10""")
def sanity_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = A.facts(spark, sf_dir)
    bad = f.withColumns({"capex": F.when(F.col("year") == 1998, -F.col("capex")).otherwise(F.col("capex")), "ingresos": F.when((F.col("year") == 1999) & (F.col("period_type") == "annual"), F.col("ingresos") * 20).otherwise(F.col("ingresos")), "gross_profit": F.when(F.col("year") == 2000, F.col("gross_profit") * 2).otherwise(F.col("gross_profit"))})
    return G.sanity(bad)


@query(f"{_FACTS} select ticker, period_key, field, ratio from (select ticker, period_key, field, abs(value / nullif(lag(value) over (partition by ticker, field order by end_date, period_key), 0)) as ratio from (unpivot (select ticker, period_key, end_date, ingresos, net_income from facts where period_type = 'annual') on ingresos, net_income into name field value value)) where ratio is not null")
def yoy_jump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.yoy(A.facts(spark, sf_dir), ("ingresos", "net_income"))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as candidate values of an order's field; the filing type follows from the supplier."""
    types = F.array(*[F.lit(t) for t in ("10-K", "10-Q", "8-K", "20-F", "6-K")])
    li = A.table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("value"), F.col("l_returnflag").alias("label"),
        F.element_at(types, (F.col("l_suppkey") % 5 + 1).cast("int")).alias("filing_type"), F.concat(F.lit("FY"), F.year("l_shipdate").cast("string")).alias("period_key"),
    )


_CAND = "with c as (select l_orderkey as doc, l_linenumber as line, l_partkey as part, l_extendedprice as value, l_returnflag as label, ['10-K','10-Q','8-K','20-F','6-K'][l_suppkey % 5 + 1] as filing_type, 'FY' || year(l_shipdate) as period_key from lineitem), r as (select *, case filing_type when '10-K' then 0 when '20-F' then 1 when '40-F' then 2 when '10-Q' then 3 when '8-K' then 4 else 5 end as rank from c)"


@query(f"{_CAND} select doc, period_key, value, filing_type, part, count(*) over (partition by doc, period_key) as n_candidates from r qualify row_number() over (partition by doc, period_key order by rank, line, part, value, label, filing_type) = 1")
def resolve_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _candidates(spark, sf_dir).withColumn("rank", R.filing_rank(F.col("period_key"), F.col("filing_type")))
    return R.winners(c, ("doc", "period_key"), ("rank", "line", "part", "value", "label", "filing_type"), ("value", "filing_type", "part"))


@query(f"{_CAND} select doc, period_key, cast(sum(cast(value as decimal(20,6))) as double) as value, count(*) as n_parts from (select doc, period_key, label, line, max(value) as value from c group by all) group by doc, period_key")
def additive_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.additive(_candidates(spark, sf_dir), ("doc", "period_key"), ("label", "line"))


def _filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of fields from several filings, in file order; every rule of the fold occurs."""
    c = _candidates(spark, sf_dir).select("doc", "line", "part", "filing_type", "value", "label")
    return c.select(
        (F.col("doc") % 997).cast("string").alias("ticker"), F.lit("FY2000").alias("period_key"), F.element_at(F.array(F.lit("ingresos"), F.lit("eps_basic")), (F.col("doc") % 2 + 1).cast("int")).alias("field"), "filing_type",
        F.concat_ws("-", F.col("doc").cast("string"), F.col("line").cast("string"), F.col("part").cast("string"), F.col("label"), F.col("value").cast("string")).alias("file"),
        F.dense_rank().over(W.partitionBy(F.col("doc") % 997).orderBy("doc", "line", "part", "label", "value")).alias("file_ord"),
        F.when(F.col("part") % 3 == 0, F.round(F.col("value") / 1000) * 1000).otherwise(F.col("value")).alias("value"),
        (F.col("part") % 3).cast("int").alias("affinity"), (F.col("line") % 3 - 1).cast("int").alias("semantic"), (F.col("part") % 11 == 0).alias("rescaled"), (F.col("part") % 13 == 0).alias("restated"), (F.col("part") % 7 != 0).alias("has_key"),
        (F.col("part") % 17 == 0).alias("weighted"), (F.col("line") % 2 == 0).alias("primary"), (F.col("part") % 4 == 0).alias("ixbrl"),
    )


_EPS = "field = 'eps_basic'"
#: The fold as a walk over each group's rows in order; e is the winner so far, n the next row.
_FOLD = """with recursive c as (select l_orderkey as doc, l_linenumber as line, l_partkey as part, l_extendedprice as value, l_returnflag as label, ['10-K','10-Q','8-K','20-F','6-K'][l_suppkey % 5 + 1] as filing_type from lineitem),
v as (select cast(doc % 997 as varchar) as ticker, 'FY2000' as period_key, ['ingresos', 'eps_basic'][doc % 2 + 1] as field, case when filing_type in ('10-K', '20-F') then 1 when filing_type in ('10-Q', '6-K') then 2 when filing_type = '8-K' then 3 else 4 end as prio,
  dense_rank() over (partition by doc % 997 order by doc, line, part, label, value) as file_ord, concat_ws('-', doc, line, part, label, value) as file, case when part % 3 = 0 then round(value / 1000) * 1000 else value end as value, part % 3 as affinity, line % 3 - 1 as semantic,
  part % 11 = 0 as rescaled, part % 13 = 0 as restated, part % 7 <> 0 as has_key, part % 17 = 0 as weighted, line % 2 = 0 as prim, part % 4 = 0 as tagged from c),
o as (select ticker, period_key, field, v as w, row_number() over (partition by ticker, period_key, field order by prio, file_ord, file, value) as rn from v where {}),
fold as (
  select ticker, period_key, field, w, rn, cast([] as varchar[]) as reasons from o where rn = 1
  union all
  select ticker, period_key, field, case when take then n else e end, rn, list_distinct(list_append(reasons, case when exact then 'quality_override_rescaled' else 'duplicate_conflict' end)) from (
    select *, case when n.prio < e.prio then true when n.prio > e.prio then exact when not (e.has_key and n.has_key) then false
      when choice is not null then choice = 'new' when n.affinity < e.affinity then not near when n.affinity = e.affinity then e.semantic > 0 and n.semantic < e.semantic else false end as take from (
      select *, n.prio > e.prio and e.rescaled and not n.rescaled as exact, case when field = 'eps_basic' then case
        when e.restated <> n.restated then case when n.restated then 'new' else 'existing' end when e.weighted <> n.weighted then case when e.weighted then 'new' else 'existing' end
        when near then 'existing' when e.value = 0 or n.value = 0 then null
        when e.prim <> n.prim and abs(e.value - n.value) / greatest(abs(e.value), abs(n.value)) >= 0.25 then case when not e.prim and (e.tagged or e.weighted) then 'new' when not n.prim and (n.tagged or n.weighted) then 'existing' end end end as choice from (
        select f.ticker, f.period_key, f.field, f.w as e, o.w as n, o.rn, f.reasons, f.field = 'eps_basic' and f.w.value * o.w.value > 0 and abs(f.w.value - o.w.value) <= greatest(abs(f.w.value), abs(o.w.value)) * 0.05 as near
        from fold f join o on o.ticker = f.ticker and o.period_key = f.period_key and o.field = f.field and o.rn = f.rn + 1)))),
ends as (select ticker, period_key, field, max(rn) as rn from o group by all)
select ticker, period_key, field, f.w.value as value, f.w.file as file, rn - 1 as n_discarded, list_sort(f.reasons) as reasons from fold f join ends using (ticker, period_key, field, rn)"""


def _told(merged: DataFrame) -> DataFrame:
    return merged.withColumn("reasons", F.array_join("reasons", ","))


@query(f"select * replace (array_to_string(reasons, ',') as reasons) from ({_FOLD.format('true')})")
def merge_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _told(R.merge(_filings(spark, sf_dir)))


@query(f"select * replace (array_to_string(reasons, ',') as reasons) from ({_FOLD.format(_EPS)})")
def eps_restatement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _told(R.merge(_filings(spark, sf_dir).where(F.col("field") == "eps_basic")))


@query(f"with {A.TRUTH_SQL} select coalesce(f.ticker, t.ticker) as ticker, coalesce(f.period_key, t.period_key) as period_key, coalesce(f.field, t.field) as field, coalesce(f.value, t.expected) as value, case when f.value is null then 'manual' else 'table' end as method from long_facts f full join truth t on f.ticker = t.ticker and f.period_key = t.period_key and f.field = t.field")
def override_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    manual = A.truth(spark, sf_dir).select("ticker", "period_key", "field", F.col("expected").alias("value"))
    return R.override_missing(A.long_facts(spark, sf_dir), manual)


@query("with v as (select l_orderkey as doc, l_linenumber % 4 * 3 as scale, l_linenumber as line from lineitem where l_linenumber % 4 <> 0), n as (select doc, scale, count(*) as n, min(line) as first from v group by all) select doc, scale, n from n qualify row_number() over (partition by doc order by n desc, first) = 1")
def mode_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = A.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") % 4 * 3).alias("scale"), F.col("l_linenumber").alias("line")).where("scale <> 0")
    return R.mode(v, "doc", "scale", "line")


@query(f"with {A.LONG_SQL} select ticker, period_key, period_type, year, field, value from long_facts")
def unpivot_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.long_facts(spark, sf_dir)


QUERIES, ORACLE_SQL = query.queries, query.sql

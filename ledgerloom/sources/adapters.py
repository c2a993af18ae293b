"""Financial facts, truth and candidates carried by the test tables.

An issuer is a supplier's nation and a fiscal period the calendar quarter, half-year or year of a shipment. Money is summed as
decimals, so that totals don't depend on the partitioning. The same rules stand in FACTS_SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FLOWS = ("ingresos", "cost_of_revenue", "gross_profit", "ebit", "net_income", "cfo", "capex")
STOCKS = ("total_assets", "total_liabilities", "total_equity", "total_debt", "cash_and_equivalents", "shares_outstanding")
EXTRA = ("cfi", "cff", "delta_cash")
FIELDS = FLOWS + STOCKS + EXTRA

#: Issuers whose fourth quarters, and whose second and later quarters, aren't filed; the last year isn't complete.
NO_Q4, HALF_YEARLY, LAST_YEAR = 3, 5, 2001


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(x: Column) -> Column:
    return F.sum(x.cast("decimal(20,6)"))


def _base(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Quarterly decimal sums of flows by supplier nation and of stocks by customer nation."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("ticker"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    price, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    net = price * (1 - disc)
    sums = {
        "ingresos": price,
        "cost_of_revenue": price * disc,
        "gross_profit": price - price * disc,
        "ebit": net * (tax + 0.1),
        "net_income": F.when(F.col("l_returnflag") == "R", -net * (1 - tax)).otherwise(net * (1 - tax)),
        "cfo": F.when(F.col("l_linestatus") == "F", net).otherwise(F.lit(0.0)),
        "capex": F.when(F.col("l_returnflag") == "A", -price * tax).otherwise(F.lit(0.0)),
        "shares_outstanding": F.col("l_quantity"),
    }
    by = [F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("quarter")]
    # by supplier first, so that the join takes a few rows of each
    each = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", *by).agg(*[_money(v).alias(k) for k, v in sums.items()])
    flows = each.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("s_nationkey", "year", "quarter").agg(*[F.sum(k).alias(k) for k in sums])
    flows = flows.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).drop("s_nationkey")
    total, status = F.col("o_totalprice"), F.col("o_orderstatus")
    some = lambda s: _money(F.when(status == s, total).otherwise(F.lit(0.0)))
    stocks = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"))
        .agg(_money(total).alias("total_assets"), some("O").alias("total_liabilities"), some("F").alias("total_equity"), some("P").alias("cash_and_equivalents"))
        .withColumnRenamed("c_nationkey", "n_nationkey")
    )
    return flows, stocks


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (issuer, period): period_key, period_type, year, ord, end_date and the fields as doubles."""
    flows, stocks = _base(spark, sf_dir)
    q = flows.join(stocks, ["n_nationkey", "year", "quarter"], "left")
    sums = [c for c in (*FLOWS, "shares_outstanding", "total_assets", "total_liabilities", "total_equity", "cash_and_equivalents")]

    one, text, quarter, nation = F.lit(1), lambda c: F.col(c).cast("string"), F.col("quarter"), F.col("n_nationkey")

    def kind(name: str, holds: Column, key: Column, ord_: Column, month: Column) -> Column:
        return F.when(holds, F.struct(F.lit(name).alias("period_type"), key.alias("period_key"), ord_.cast("int").alias("ord"), month.cast("int").alias("month")))

    # a quarter counts for its year, for itself and for its half-year: the sums by quarter are made once
    kinds = F.array_compact(F.array(
        kind("annual", F.col("year") < LAST_YEAR, F.concat(F.lit("FY"), text("year")), one, F.lit(12)),
        kind("quarterly", ~((quarter == 4) & (nation % NO_Q4 == 0)) & ~((nation % HALF_YEARLY == 0) & (quarter > 1)), F.concat(F.lit("Q"), text("quarter"), F.lit("-"), text("year")), quarter, quarter * 3),
        kind("semestral", quarter <= 2, F.concat(F.lit("H1-"), text("year")), one, F.lit(6)),
    ))
    every = q.withColumn("k", F.explode(kinds)).groupBy("ticker", "n_nationkey", "year", "k").agg(*[F.sum(c).alias(c) for c in sums])
    every = every.select("n_nationkey", "ticker", "k.period_key", "k.period_type", "year", "k.ord", F.last_day(F.make_date("year", "k.month", F.lit(1))).alias("end_date"), *[F.col(c).cast("double").alias(c) for c in sums])
    every = every.withColumn("total_debt", F.col("total_liabilities") * 0.5)
    every = every.select(
        "ticker", "period_key", "period_type", "year", "ord", "end_date", *FLOWS, *STOCKS,
        (F.col("capex") * 2).alias("cfi"),
        F.when(F.col("year") % 2 == 0, -F.col("cfo") / 2).alias("cff"),
        F.when(F.col("n_nationkey") % 4 != 0, F.col("cfo") + F.col("capex") * 2 - F.col("cfo") / 2).alias("delta_cash"),
    )
    return _kept(every, sf_dir)


#: The facts that were asked for last: a few rows per issuer and year, read several times by most plans.
_last: dict[str, DataFrame] = {}


def _kept(facts: DataFrame, sf_dir: str) -> DataFrame:
    """facts of this folder, held in memory until those of another are asked for; one table at a time is."""
    old = _last.get(sf_dir)
    if old is not None and old.sparkSession is facts.sparkSession and old.storageLevel.useMemory:
        return old
    for held in _last.values():
        if held.sparkSession is facts.sparkSession:
            held.unpersist()
    _last.clear()
    _last[sf_dir] = facts.persist()
    return facts


def long_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, period_key, field, value): one row per non-null value."""
    return unpivoted(facts(spark, sf_dir))


def unpivoted(wide: DataFrame) -> DataFrame:
    return wide.unpivot(["ticker", "period_key", "period_type", "year"], list(FIELDS), "field", "value").where("value is not null")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated values made of the facts by a fixed rule: some altered, some missing from the facts, some not curated."""
    f = long_facts(spark, sf_dir)
    pick = F.pmod(F.col("year") * 7 + F.length("ticker") * 3 + F.length("field") * 5 + F.length("period_key"), F.lit(23))
    kept = f.where(pick != 11)
    value = F.when(pick == 3, F.col("value") * 1.05).when(pick == 5, F.col("value") / 1000).when(pick == 7, -F.col("value")).otherwise(F.col("value"))
    return kept.select("ticker", F.when(pick == 13, F.concat("period_key", F.lit("x"))).otherwise(F.col("period_key")).alias("period_key"), "period_type", "field", value.alias("expected"))


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, market_cap, price, shares): account balances of an issuer's suppliers stand in for a market snapshot."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    cap = _money(F.col("s_acctbal") * 1000).cast("double")
    return s.groupBy(F.col("n_name").alias("ticker")).agg(cap.alias("market_cap"), F.count("*").cast("double").alias("shares"))


_M = "sum(cast({} as decimal(20,6)))"
_SUMS = ", ".join(f"sum({c}) as {c}" for c in (*FLOWS, "shares_outstanding", "total_assets", "total_liabilities", "total_equity", "cash_and_equivalents"))
_CAST = ", ".join(f"cast({c} as double) as {c}" for c in (*FLOWS, "shares_outstanding", "total_assets", "total_liabilities", "total_equity", "cash_and_equivalents"))

#: CTEs that end in ``facts``; the oracle's own reading of the rules above.
FACTS_SQL = f"""flows as (
  select n_nationkey, n_name as ticker, cast(year(l_shipdate) as int) as year, cast(quarter(l_shipdate) as int) as quarter,
    {_M.format('l_extendedprice')} as ingresos, {_M.format('l_extendedprice * l_discount')} as cost_of_revenue,
    {_M.format('l_extendedprice - l_extendedprice * l_discount')} as gross_profit,
    {_M.format('l_extendedprice * (1 - l_discount) * (l_tax + 0.1)')} as ebit,
    {_M.format("case when l_returnflag = 'R' then -(l_extendedprice * (1 - l_discount)) * (1 - l_tax) else l_extendedprice * (1 - l_discount) * (1 - l_tax) end")} as net_income,
    {_M.format("case when l_linestatus = 'F' then l_extendedprice * (1 - l_discount) else 0.0 end")} as cfo,
    {_M.format("case when l_returnflag = 'A' then -l_extendedprice * l_tax else 0.0 end")} as capex,
    {_M.format('l_quantity')} as shares_outstanding
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by all),
stocks as (
  select c_nationkey as n_nationkey, cast(year(o_orderdate) as int) as year, cast(quarter(o_orderdate) as int) as quarter,
    {_M.format('o_totalprice')} as total_assets, {_M.format("case when o_orderstatus = 'O' then o_totalprice else 0.0 end")} as total_liabilities,
    {_M.format("case when o_orderstatus = 'F' then o_totalprice else 0.0 end")} as total_equity, {_M.format("case when o_orderstatus = 'P' then o_totalprice else 0.0 end")} as cash_and_equivalents
  from orders join customer on o_custkey = c_custkey group by all),
q as (select * from flows left join stocks using (n_nationkey, year, quarter)),
rolled as (
  select n_nationkey, ticker, 'FY' || year as period_key, 'annual' as period_type, year, 1 as ord, make_date(year, 12, 31) as end_date, {_SUMS} from q where year < {LAST_YEAR} group by n_nationkey, ticker, year
  union all
  select n_nationkey, ticker, 'Q' || quarter || '-' || year, 'quarterly', year, quarter, last_day(make_date(year, quarter * 3, 1)), {_SUMS} from q
  where not (quarter = 4 and n_nationkey % {NO_Q4} = 0) and not (n_nationkey % {HALF_YEARLY} = 0 and quarter > 1) group by n_nationkey, ticker, year, quarter
  union all
  select n_nationkey, ticker, 'H1-' || year, 'semestral', year, 1, make_date(year, 6, 30), {_SUMS} from q where quarter <= 2 group by n_nationkey, ticker, year),
cast_ as (select n_nationkey, ticker, period_key, period_type, year, ord, end_date, {_CAST} from rolled),
facts as (
  select ticker, period_key, period_type, year, ord, end_date, {', '.join(FLOWS)}, total_assets, total_liabilities, total_equity, total_liabilities * 0.5 as total_debt, cash_and_equivalents, shares_outstanding,
    capex * 2 as cfi, case when year % 2 = 0 then -cfo / 2 end as cff, case when n_nationkey % 4 <> 0 then cfo + capex * 2 - cfo / 2 end as delta_cash
  from cast_)"""

LONG_SQL = f"""{FACTS_SQL},
long_facts as (select ticker, period_key, period_type, year, field, value from (unpivot facts on {', '.join(FIELDS)} into name field value value))"""

TRUTH_SQL = f"""{LONG_SQL},
picked as (select *, (year * 7 + length(ticker) * 3 + length(field) * 5 + length(period_key)) % 23 as pick from long_facts),
truth as (
  select ticker, case when pick = 13 then period_key || 'x' else period_key end as period_key, period_type, field,
    case when pick = 3 then value * 1.05 when pick = 5 then value / 1000 when pick = 7 then -value else value end as expected
  from picked where pick <> 11)"""

MARKET_SQL = "market as (select n_name as ticker, cast(sum(cast(s_acctbal * 1000 as decimal(20,6))) as double) as market_cap, cast(count(*) as double) as shares from supplier join nation on s_nationkey = n_nationkey group by n_name)"

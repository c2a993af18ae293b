"""Rules of single operators on small hand-made frames."""

from datetime import date

from pyspark.sql import functions as F

from ledgerloom.functions import periods, text
from ledgerloom.operators import catalogue, gates, resolve, tables, ttm


def cells(spark, col, *values):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r[0] for r in df.orderBy("k").select(col(F.col("v"))).collect()]


def test_numbers(spark):
    got = cells(spark, text.parse_number, "1,234", "(1,234)", "-500", "—", "1.234,56", "$ 12", "( 7", "12%", "NM", "", "x", None)
    assert got == [1234.0, -1234.0, -500.0, None, 1234.56, 12.0, -7.0, 12.0, None, None, None, None]
    assert cells(spark, text.parse_displayed, "", "—", "3") == [0.0, 0.0, 3.0]
    assert cells(spark, text.to_float, "1.5B", "42K", "N/A", "-12.5%", "1,234") == [1.5e9, 42e3, None, -12.5, 1234.0]


def test_periods(spark):
    assert cells(spark, periods.period_type, "FY2024", "q3-2024", "H1-2024", "9M-2024", "2024") == ["annual", "quarterly", "semestral", "ytd", "unknown"]
    assert cells(spark, periods.period_end, "FY2024", "Q1-2023", "H1-2024", "x") == [date(2024, 12, 31), date(2023, 3, 31), date(2024, 6, 30), None]


def facts(spark, rows):
    names = ["ticker", "period_key", *ttm.SUMMABLE]
    df = spark.createDataFrame([(t, k, *[float(v) if v is not None else None for v in vs]) for t, k, vs in rows], ", ".join(["ticker string", "period_key string", *[f"{c} double" for c in ttm.SUMMABLE]]))
    k = F.col("period_key")
    return df.select(*names, periods.period_type(k).alias("period_type"), periods.period_year(k).alias("year"), periods.period_ordinal(k).alias("ord"), periods.period_end(k).alias("end_date"))


def test_cascade(spark):
    same = lambda v: [v] * 7
    rows = [("A", f"Q{q}-2023", same(q)) for q in (1, 2, 3)] + [("A", "FY2023", same(20))]  # a fourth quarter of 14 is made
    rows += [("B", "H1-2022", same(4)), ("B", "H1-2023", same(6)), ("B", "FY2022", same(10))]
    rows += [("C", "FY2021", [5, 1, 1, None, None, None, None]), ("C", "FY2022", [6, None, None, None, None, None, None])]
    rows += [("D", f"Q{q}-{y}", same(1)) for q, y in ((1, 2020), (2, 2020), (3, 2020), (1, 2023))] + [("D", "FY2020", same(9))]
    rows += [("E", "Q1-2023", same(1))]
    got = {r.ticker: (r.metodo, r.ingresos, r.rejected) for r in ttm.cascade(facts(spark, rows)).collect()}
    assert got == {"A": ("suma_4_trimestres", 20.0, False), "B": ("semestral_FY_H1", 12.0, False), "C": ("FY0_fallback", 5.0, False), "D": ("FY0_fallback", 9.0, True), "E": ("no_disponible", None, False)}


def test_critical_skip_fails(spark):
    g = spark.createDataFrame([("A", "BALANCE_IDENTITY", True, "SKIP"), ("B", "EV_SANITY", False, "WARNING"), ("C", "EV_SANITY", False, "PASS")], "ticker string, gate string, critical boolean, status string")
    assert {r.ticker: (r.confidence, r.status) for r in gates.summary(g).collect()} == {"A": (90, "FAIL"), "B": (95, "PARTIAL"), "C": (100, "PASS")}


def merged(spark, *rows):
    schema = "ticker string, period_key string, field string, filing_type string, file string, file_ord int, value double, affinity int, semantic int, rescaled boolean, restated boolean, has_key boolean"
    r = resolve.merge(spark.createDataFrame([("T", "FY2020", *x) for x in rows], schema)).collect()
    return {x.field: (x.value, x.n_discarded, list(x.reasons)) for x in r}


def test_merge(spark):
    assert merged(spark, ("ingresos", "10-Q", "q", 0, 1.0, 0, 0, False, False, True), ("ingresos", "10-K", "k", 1, 2.0, 0, 0, False, False, True)) == {"ingresos": (2.0, 1, ["duplicate_conflict"])}
    assert merged(spark, ("ingresos", "10-K", "a", 0, 1.0, 1, 0, False, False, True), ("ingresos", "10-K", "b", 1, 2.0, 0, 0, False, False, True))["ingresos"][0] == 2.0
    assert merged(spark, ("eps_basic", "10-K", "a", 0, 1.0, 1, 0, False, False, True), ("eps_basic", "10-K", "b", 1, 1.04, 0, 0, False, False, True))["eps_basic"][0] == 1.0
    assert merged(spark, ("ingresos", "10-K", "a", 0, 1.0, 0, 0, True, False, True), ("ingresos", "8-K", "b", 1, 3.0, 0, 0, False, False, True))["ingresos"] == (3.0, 1, ["quality_override_rescaled"])
    assert merged(spark, ("ingresos", "10-K", "a", 0, 1.0, 0, 5, False, False, True), ("ingresos", "10-K", "b", 1, 3.0, 0, 2, False, False, True))["ingresos"][0] == 3.0
    assert merged(spark, ("ingresos", "10-K", "a", 0, 1.0, 0, 0, False, False, True))["ingresos"] == (1.0, 0, [])


def test_merge_of_values_per_share(spark):
    schema = "ticker string, period_key string, field string, filing_type string, file string, file_ord int, value double, affinity int, semantic int, rescaled boolean, restated boolean, has_key boolean, weighted boolean, primary boolean, ixbrl boolean"

    def value(first, second):
        rows = [("T", "FY2020", "eps_basic", "10-K", f, k, v, 0, 0, False, *x) for k, (f, v, *x) in enumerate((("a", *first), ("b", *second)))]
        return resolve.merge(spark.createDataFrame(rows, schema)).first().value

    plain = (False, True, False, True, False)  # restated, has_key, weighted, primary, ixbrl
    assert value((1.0, *plain), (2.0, True, True, False, False, False)) == 2.0
    assert value((1.0, False, True, True, True, False), (2.0, *plain)) == 2.0
    assert value((1.0, False, True, False, False, True), (1.3, *plain)) == 1.0  # 23 % apart
    assert value((1.0, False, True, False, False, True), (1.5, *plain)) == 1.5
    assert value((1.0, False, True, False, False, False), (1.5, *plain)) == 1.0
    assert value((0.0, False, True, False, False, True), (1.5, *plain)) == 0.0


def test_aliases(spark):
    labels = spark.createDataFrame([("Net sales (Note 3)",), ("Total net sales of goods",), ("sales",), ("– Basic",)], "label string")
    aliases = spark.createDataFrame([("net sales", "ingresos", 0), ("sales", "other", 1)], "alias string, canonical string, ord int")
    got = {r.label: (r.canonical, r.how) for r in catalogue.resolve_aliases(labels, aliases).collect()}
    assert got == {"Net sales (Note 3)": ("ingresos", "exact"), "Total net sales of goods": ("ingresos", "fuzzy"), "sales": ("other", "exact"), "– Basic": (None, "none")}


def test_ixbrl_skips_dimensions_and_negates(spark):
    html = '<xbrli:context id="a"><xbrli:startDate>2020-01-01</xbrli:startDate><xbrli:endDate>2020-12-31</xbrli:endDate></xbrli:context><xbrli:context id="b"><xbrli:instant>2020-12-31</xbrli:instant><xbrldi:explicitMember>x</xbrldi:explicitMember></xbrli:context><ix:nonFraction name="g:Rev" contextRef="a" sign="-">1,000</ix:nonFraction><ix:nonFraction name="g:Rev" contextRef="b">7</ix:nonFraction>'
    docs = spark.createDataFrame([("d", html), ("e", None)], "doc string, text string")
    concepts = spark.createDataFrame([("Rev", "ingresos", 0)], "concept string, field string, preference int")
    assert [(r.doc, r.period, r.field, r.value) for r in tables.ixbrl_facts(docs, concepts).collect()] == [("d", "FY2020", "ingresos", -1000.0)]


def test_empty_layouts(spark):
    docs = spark.createDataFrame([("d", None), ("e", "")], "doc string, text string")
    assert all(tables.cells(docs, k).count() == 0 for k in ("markdown", "aligned", "vertical", "prose"))

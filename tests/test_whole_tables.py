"""The * queries process every row of their tables, not the part that the given SQL of their namesakes takes."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
Q = entry.queries()


def test_no_row_is_left_out(spark):
    table = lambda n: spark.read.parquet(f"{SF}/{n}.parquet")
    lines, suppliers = table("lineitem"), {r[0] for r in table("supplier").select("s_suppkey").collect()}
    want = {r[0] * 10 + r[1] for r in lines.select("l_orderkey", "l_linenumber", "l_suppkey").collect() if r[2] in suppliers}
    assert {r.row_id for r in Q["nearest_anchor"](spark, SF).collect()} == want
    prices = {f"{r[0]:.2f}%" for r in lines.where("l_linenumber % 8 = 2").select("l_extendedprice").collect()}
    for name in ("number_parse", "number_displayed"):
        got = {r.cell: r.value for r in Q[name](spark, SF).collect()}
        assert prices <= set(got) and all(abs(got[c] - float(c[:-1])) < 1e-9 for c in prices)
    docs = {str(r[0]): float(r[1]) for r in table("documents").select("doc_id", "n_chars").collect()}
    assert {r.doc: r.value for r in Q["narrative_values"](spark, SF).collect()} == docs


def test_every_alias_takes_part(spark):
    part = spark.read.parquet(f"{SF}/part.parquet").select("p_partkey", "p_type", "p_brand").collect()
    first = {}
    for key, kind, brand in part:
        first[kind, brand] = min(key, first.get((kind, brand), key))
    best = {}
    for (kind, brand), key in first.items():
        alias = kind.lower() if key % 3 == 0 else f"{kind} {brand}".lower()
        best[alias] = max(best.get(alias, (-1, "")), (key, f"f{key % 9}"))
    got = {r.label: r.canonical for r in Q["alias_exact"](spark, SF).collect()}
    plain = {k: best[k.lower()][1] for k in {p[1] for p in part} & set(got) if k.lower() in best}
    assert plain and all(got[k] == v for k, v in plain.items())
    fuzzy = {r.label: (r.canonical, r.how) for r in Q["alias_fuzzy"](spark, SF).collect()}
    assert {k: v[0] for k, v in fuzzy.items() if v[1] == "exact"} == got

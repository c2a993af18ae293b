"""source_numbering against its SQL where an issuer has sources of more than three digits; the test tables hold fewer."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as entry


def test_numbers_of_four_digits_equal_the_sql(spark, tmp_path):
    n = 2_100
    tables = {
        "customer": pa.table({"c_custkey": pa.array([1, 2]), "c_nationkey": pa.array([7, 8])}),
        "orders": pa.table({"o_orderkey": pa.array(range(n)), "o_custkey": pa.array([1 if k % 3 else 2 for k in range(n)]), "o_orderdate": pa.array([f"1995-01-{k % 28 + 1:02d}" for k in range(n)])}),
    }
    duck = duckdb.connect()
    for name, t in tables.items():
        pq.write_table(t, tmp_path / f"{name}.parquet")
        duck.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet')")
    got = sorted(map(tuple, entry.queries()["source_numbering"](spark, str(tmp_path)).select("c_nationkey", "source_id", "o_orderkey").collect()))
    assert got == sorted(duck.execute(entry.oracle_sql()["source_numbering"]).fetchall())
    assert len(got) == n

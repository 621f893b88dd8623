"""The mart of the workloads, on a few rows of its own."""

import datetime as dt

from workloads import answers


def test_facts_are_written_once(spark, tmp_path, monkeypatch):
    day = dt.datetime(1997, 3, 1)
    tables = {
        "customer": ([(1, "C1", 3, 10.0)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double"),
        "nation": ([(3, "N3", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "orders": (
            [(7, 1, "F", 50.0, day, "1-URGENT")],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (
            [(7, 2, 1, 3.0, 20.0, 0.0, 0.0, "A", "F", day), (7, 2, 2, 1.0, 30.0, 0.0, 0.0, "R", "F", day)],
            "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,"
            " l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    written, materialize = [], answers.materialize

    def counted(df):
        written.append(df.columns)
        return materialize(df)

    monkeypatch.setattr(answers, "materialize", counted)
    rows = answers.store(spark, str(tmp_path)).mart.filter("indicator_id = 101 and measure_code = 'zahl'").collect()
    # flags A and R, their totals over the status, and the total of both, each as first known and as revised
    assert sorted(r.indicator_value_numeric for r in rows) == sorted([20, 20, 30, 30, 50] * 2)
    assert all("geo_value" not in columns for columns in written)  # publish writes the facts, the store the catalogue

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daytally.sources import generated_tables as g


def test_the_first_line_of_a_key_decides_even_if_its_part_is_unknown(spark, tmp_path):
    spark.createDataFrame([(1, "Brand#1")], "p_partkey long, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, 1)], "s_suppkey long, s_nationkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(1, "PERU")], "n_nationkey long, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    day = lambda n: dt.datetime(1995, 1, n)
    lines = [(1, 1, day(1), 1), (1, 1, day(2), 1), (2, 1, day(1), 9), (2, 1, day(2), 1), (3, 1, day(3), 1)]
    rows = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz, l_partkey long").withColumn("l_suppkey", F.lit(1).cast("long"))
    for name in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"):
        rows = rows.withColumn(name, F.lit(1.0))
    rows.withColumns({"l_returnflag": F.lit("N"), "l_linestatus": F.lit("O")}).write.parquet(f"{tmp_path}/lineitem.parquet")
    kept = g.kept_incidents(spark, str(tmp_path))
    assert sorted((r.id, r.ts, r[g.TYPE], r[g.LOCATION]) for r in kept.collect()) == [(1, day(1), "Brand#1", "PERU"), (3, day(3), "Brand#1", "PERU")]
    assert kept.columns == [*g.KEYS, "ts", "l_partkey", "l_suppkey", g.TYPE, g.LOCATION]

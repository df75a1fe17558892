from __future__ import annotations

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from daytally.sources import keyed_table as k


@pytest.fixture
def stored(spark):
    return spark.createDataFrame([("1/1/05", 1, "a"), ("1/2/05", 2, "b")], "Date string, n int, `x.y` string")


def test_last_update_replaces_the_whole_record(spark, rows, stored):
    updates = spark.createDataFrame(
        [("1/2/05", 7, "old", 1), ("1/2/05", None, None, 2), ("1/3/05", 3, "new", 1), (None, 9, "no key", 1)],
        "Date string, n int, `x.y` string, seq int",
    )
    out = k.upsert(stored, updates, "Date", ["seq"])
    assert out.columns == stored.columns
    assert rows(out) == [("1/1/05", 1, "a"), ("1/2/05", None, None), ("1/3/05", 3, "new")]


def test_written_to_a_new_path(spark, rows, stored, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    k.write_table(stored, old)
    updates = spark.createDataFrame([("1/1/05", 5, "z", 1)], "Date string, n int, `x.y` string, seq int")
    out = k.upsert_to(spark, old, updates, "Date", ["seq"], new)
    assert rows(out) == [("1/1/05", 5, "z"), ("1/2/05", 2, "b")]
    assert rows(k.read_table(spark, old)) == rows(stored)
    with pytest.raises(Exception):
        k.write_table(stored, old)


def test_partitioned_write(spark, tmp_path, stored):
    path = str(tmp_path / "p")
    k.write_table(stored, path, ["Date"])
    assert k.read_table(spark, path).filter("Date = '1/1/05'").count() == 1


def test_records_may_differ_in_columns(spark, stored):
    updates = spark.createDataFrame([("1/2/05", 4, 9, 1)], "Date string, n int, `Type: z` int, seq int")
    out = k.upsert(stored, updates, "Date", ["seq"])
    assert out.columns == ["Date", "n", "x.y", "Type: z"]
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert got == {"1/1/05": (1, "a", None), "1/2/05": (4, None, 9)}


def month():
    return F.date_format("day", "yyyy-MM")


def days(spark, start, n, text):
    first = dt.date.fromisoformat(start)
    return spark.createDataFrame([(first + dt.timedelta(i), i, text) for i in range(n)], "day date, n int, text string")


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_an_update_writes_the_parts_it_touches_and_no_other(spark, rows, tmp_path):
    path = str(tmp_path / "days")
    k.write_parts(days(spark, "2005-01-01", 365, "old"), path, "day", month())
    before = files(path)
    assert {f.split("/")[0] for f in before} == {f"{k.PART}=p2005-{m:02d}" for m in range(1, 13)}
    updates = days(spark, "2005-03-30", 4, "new").unionByName(days(spark, "2006-01-01", 1, "new")).withColumn("seq", F.lit(1))
    updates = updates.unionByName(updates.withColumns({"seq": F.lit(0), "text": F.lit("late")}))
    out = k.upsert_parts(spark, path, updates, "day", ["seq"], month())
    after = files(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.split("/")[0][-2:] for f in before if f not in same} == {"03", "04"}
    assert {f.split("/")[0] for f in after if f not in same} == {f"{k.PART}=p{m}" for m in ("2005-03", "2005-04", "2006-01")}
    found = {r.day: (r.n, r.text) for r in out.collect()}
    want = {dt.date(2005, 1, 1) + dt.timedelta(i): (i, "old") for i in range(365)}
    want |= {dt.date(2005, 3, 30) + dt.timedelta(i): (i, "new") for i in range(4)} | {dt.date(2006, 1, 1): (0, "new")}
    assert found == want and out.count() == 366
    assert out.columns == ["day", "n", "text", k.PART]


def test_an_update_reads_the_parts_it_touches(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "days")
    k.write_parts(days(spark, "2005-01-01", 365, "old"), path, "day", month())
    plans = []
    replaced = k._replaced
    monkeypatch.setattr(k, "_replaced", lambda old, latest, key: plans.append(old) or replaced(old, latest, key))
    k.upsert_parts(spark, path, days(spark, "2005-06-01", 3, "new").withColumn("seq", F.lit(1)), "day", ["seq"], month())
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan or "PartitionFilters: [(_part" in plan or "IN (p2005-06)" in plan
    assert "p2005-06" in plan and "p2005-07" not in plan


def test_parts_of_updates_with_new_columns_and_without_rows(spark, tmp_path):
    path = str(tmp_path / "days")
    k.write_parts(days(spark, "2005-01-01", 60, "old"), path, "day", month())
    before = files(path)
    none = days(spark, "2005-01-01", 1, "x").withColumns({"day": F.lit(None).cast("date"), "seq": F.lit(1)})
    assert k.upsert_parts(spark, path, none, "day", ["seq"], month()).count() == 60 and files(path) == before
    more = spark.createDataFrame([(dt.date(2005, 1, 2), 9.5, 1)], "day date, extra double, seq int")
    out = k.upsert_parts(spark, path, more, "day", ["seq"], month())
    assert [tuple(r) for r in out.where("extra is not null or n is null").select("day", "n", "text", "extra").collect()] == [(dt.date(2005, 1, 2), None, None, 9.5)]
    assert out.count() == 60
    with pytest.raises(ValueError, match="order"):
        k.upsert_parts(spark, path, more, "day", [], month())


def test_lookups_read_the_row_groups_that_hold_the_key(spark, tmp_path):
    path = str(tmp_path / "ranges")
    df = spark.range(200_000).select(((F.col("id") * 7919) % 200_000).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    k.write_ranges(df, path, ["key"], row_group_bytes=256 << 10)
    spans = []
    for file in Path(path).glob("*.parquet"):
        parquet = pq.ParquetFile(file).metadata
        spans += [(g.column(0).statistics.min, g.column(0).statistics.max, g.num_rows) for g in map(parquet.row_group, range(parquet.num_row_groups))]
    spans.sort()
    assert len(spans) > 20 and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))  # no two share a key
    found = k.read_table(spark, path).where("key between 123456 and 123460")
    assert sorted(r.key for r in found.collect()) == list(range(123456, 123461))
    scan = found._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [IsNotNull(key), GreaterThanOrEqual(key,123456), LessThanOrEqual(key,123460)]" in scan.toString()
    read = next(int(m.value()) for m in [scan.collectLeaves().head().metrics().get("numOutputRows").get()])
    assert read <= 2 * max(n for _, _, n in spans) < 20_000


def test_parts_whose_names_need_care(spark, tmp_path):
    path, part = str(tmp_path / "odd parts"), F.substring("key", 1, 4)
    rows = [("a/b 1", 1), ("a%2F", 2), ("", 3), ("x=y:", 4), ("é{}[", 5), ("2005-01", 6), ("2005", 7)]
    stored = spark.createDataFrame([*rows, ("zzzz", 8)], "key string, n int")
    k.write_parts(stored, path, "key", part)
    updates = spark.createDataFrame([(key, -n, 1) for key, n in rows], "key string, n int, seq int")
    out = k.upsert_parts(spark, path, updates, "key", ["seq"], part)
    assert sorted((r.key, r.n) for r in out.collect()) == sorted([*((key, -n) for key, n in rows), ("zzzz", 8)])

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daytally.operators.dedupe import dedupe_keep_first
from daytally.sources import csv_files as c


def put(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def ragged(tmp_path):
    return put(tmp_path / "ragged.csv", "a,b,c", "1,2,3", "1,2", "1,2,3,4", '"x,y",2,3', "1,2,3,")


def test_long_rows_are_skipped_and_short_rows_padded(spark, rows, ragged):
    got = rows(c.read_skip_long_rows(spark, ragged, ["a", "b", "c"]))
    assert got == [("1", "2", None), ("1", "2", "3"), ("1", "2", "3"), ("x,y", "2", "3")]


def test_long_rows_are_skipped_when_few_columns_are_read(spark, ragged):
    df = c.read_skip_long_rows(spark, ragged, ["a", "b", "c"]).select("b")
    assert [r.b for r in df.collect()] == ["2"] * 4


def test_many_surplus_cells_are_skipped(spark, rows, tmp_path):
    path = put(tmp_path / "long.csv", "a,b", "1,2", "1,2,3,4,5,6")
    assert rows(c.read_skip_long_rows(spark, path, ["a", "b"])) == [("1", "2")]


def test_quotes_inside_quotes(spark, rows, tmp_path):
    path = put(tmp_path / "q.csv", "a,b", '"say ""hi""",\\')
    assert rows(c.read_header_names(spark, path)) == [('say "hi"', "\\")]


def test_header_gives_names_and_text(spark, tmp_path):
    path = put(tmp_path / "h.csv", "Date,Tavg", "1/5/05,71", "1/6/05,")
    df = c.read_header_names(spark, path)
    assert df.dtypes == [("Date", "string"), ("Tavg", "string")]
    assert [tuple(r) for r in df.orderBy("Date").collect()] == [("1/5/05", "71"), ("1/6/05", None)]
    assert c.header_columns(spark, path) == ["Date", "Tavg"]


def test_period_files_match_by_name_and_keep_their_order(spark, tmp_path):
    one = put(tmp_path / "1.csv", "id,kind", "1,first", "2,first", "1,second")
    two = put(tmp_path / "2.csv", "kind,id,extra", "third,1,x", "third,3,x")
    df = c.read_period_files(spark, [(one, ["id", "kind"]), (two, ["kind", "id", "extra"])])
    ordered = df.orderBy(*c.READ_ORDER).select("id", "kind", "extra").collect()
    assert [tuple(r) for r in ordered] == [
        ("1", "first", None), ("2", "first", None), ("1", "second", None), ("1", "third", "x"), ("3", "third", "x"),
    ]


def test_first_row_is_the_same_however_the_files_are_split(spark, rows, tmp_path):
    lines = [f"{i % 50},row{i:05d}" for i in range(5000)]
    path = put(tmp_path / "big.csv", "id,text", *lines)
    want = sorted((str(i), f"row{i:05d}") for i in range(50))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "7000b", "1500b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = c.read_period_files(spark, [(path, ["id", "text"])])
            first = dedupe_keep_first(df, ["id"], c.READ_ORDER).select("id", "text")
            assert sorted(rows(first)) == want
        assert df.rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_missing_tokens_become_null(spark):
    df = spark.createDataFrame([("NA", "NA"), ("NaN", "x"), ("", "y"), (None, "z"), ("ok", "OTHER")], "a string, b string")
    got = [tuple(r) for r in c.missing_to_null(df, ["a"]).orderBy("b").collect()]
    assert got == [(None, "NA"), ("ok", "OTHER"), (None, "x"), (None, "y"), (None, "z")]


def test_provenance(spark, tmp_path):
    put(tmp_path / "one.csv", "a", "1")
    put(tmp_path / "two.csv", "a", "2")
    df = c.read_header_names(spark, [str(tmp_path / "one.csv"), str(tmp_path / "two.csv")])
    named = df.select("a", F.substring_index(c.provenance(), "/", -1).alias("file"))
    assert sorted(tuple(r) for r in named.collect()) == [("1", "one.csv"), ("2", "two.csv")]


def test_a_folder_counts_in_the_order_of_its_file_names(spark, tmp_path):
    folder = tmp_path / "period"
    folder.mkdir()
    put(folder / "b.csv", "id,kind", "1,second", "2,only")
    put(folder / "a.csv", "id,kind", "1,first", "1,again")
    df = c.read_period_files(spark, [(str(folder), ["id", "kind"])])
    first = dedupe_keep_first(df, ["id"], c.READ_ORDER).select("id", "kind")
    assert sorted(tuple(r) for r in first.collect()) == [("1", "first"), ("2", "only")]


def test_a_filled_cell_past_an_empty_surplus_cell_makes_a_line_long(spark, rows, tmp_path):
    path = put(tmp_path / "l.csv", "a,b,c", "4,5,6,,x", "7,8,9,y", "1,2,3,,", '1,"2,2",3,""', '1,2,"3","z"', '1,2,3,","')
    assert rows(c.read_skip_long_rows(spark, path, ["a", "b", "c"])) == [("1", "2", "3"), ("1", "2,2", "3")]


def test_headers_of_any_order_behind_one_path(spark, rows, tmp_path):
    """Column order, an extra column, odd file names, blank first lines and files without a line."""
    folder = tmp_path / "mixed [1] files"
    folder.mkdir()
    put(folder / "a.csv", "x,y", "1,2")
    put(folder / "b%41 c.csv", "y,x", "20,10")
    put(folder / "c{d}.csv", "", "y,x", "200,100")
    put(folder / "d.csv", "z,x", "7,8", "9,")
    (folder / "e.csv").write_text("")
    path = str(tmp_path / "mixed*")
    assert rows(c.read_header_names(spark, path).select("x", "y", "z")) == [(None, None, "9"), ("1", "2", None), ("10", "20", None), ("100", "200", None), ("8", None, "7")]
    tagged = c.read_period_files(spark, [path])
    assert [tuple(r) for r in tagged.orderBy(*c.READ_ORDER).select("x", "y", "z").collect()] == [
        ("1", "2", None), ("10", "20", None), ("100", "200", None), ("8", None, "7"), (None, None, "9"),
    ]


def test_one_read_for_each_distinct_header(spark, tmp_path):
    for i in range(12):
        put(tmp_path / f"{i:02d}.csv", "a,b" if i % 2 else "b,a", f"{i},{i + 100}")
    groups = c.by_header(spark, str(tmp_path))
    assert [(columns, len(files)) for columns, files in groups] == [(["b", "a"], 6), (["a", "b"], 6)]
    plan = c.read_tagged_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2


def test_paths_count_in_the_order_given_and_files_in_that_of_their_names(spark, tmp_path):
    for folder, text in (("z", "first"), ("a", "second")):
        (tmp_path / folder).mkdir()
        put(tmp_path / folder / "same.csv", "id,kind" if folder == "z" else "kind,id", f"1,{text}" if folder == "z" else f"{text},1")
        put(tmp_path / folder / "more.csv", "kind,id", f"{text} before,1")
    df = c.read_period_files(spark, [str(tmp_path / "z"), str(tmp_path / "a")])
    got = [tuple(r) for r in df.orderBy(*c.READ_ORDER).select("id", "kind").collect()]
    assert got == [("1", "first before"), ("1", "first"), ("1", "second before"), ("1", "second")]
    one = c.read_period_files(spark, [str(tmp_path / "z" / "same.csv"), str(tmp_path / "a" / "same.csv")])
    assert [r.kind for r in one.orderBy(*c.READ_ORDER).collect()] == ["first", "second"]


def test_long_lines_by_the_width_of_their_own_header(spark, rows, tmp_path):
    put(tmp_path / "a.csv", "x,y", "1,2", "1,2,3")
    put(tmp_path / "b.csv", "z,y,x", "1,2,3", "1,2,3,4", "1,2")
    df = c.read_period_files(spark, [str(tmp_path)]).select("x", "y", "z")
    assert rows(df) == [(None, "2", "1"), ("1", "2", None), ("3", "2", "1")]


def test_the_header_pass_reads_heads_only(spark, tmp_path):
    """A file of many splits is one task, which stops after its first line."""
    put(tmp_path / "big.csv", "a,b", *["1,2"] * 200_000, "x" * 100)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10000b")
        assert [(place, line) for _, place, line in c.first_lines(spark, str(tmp_path))] == [(0, "a,b")]
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "10000b"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_no_header_at_all(spark, tmp_path):
    (tmp_path / "e.csv").write_text("\n\n")
    assert c.read_header_names(spark, str(tmp_path)).count() == 0
    with pytest.raises(ValueError, match="header"):
        c.read_tagged_files(spark, str(tmp_path))


def test_another_header_than_the_one_given_is_an_error(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    put(folder / "a.csv", "x,y", "1,2")
    put(folder / "b.csv", "y,x", "20,10")
    with pytest.raises(Exception, match="(?i)header"):
        c.read_period_files(spark, [(str(folder), ["x", "y"])]).collect()


def test_files_of_one_name_in_two_folders_have_an_order(spark, rows, tmp_path):
    for part in ("p=1", "p=2"):
        (tmp_path / part).mkdir()
        put(tmp_path / part / "f.csv", "id,kind", f"1,{part}")
    df = c.read_period_files(spark, [(str(tmp_path), ["id", "kind"])])
    assert rows(dedupe_keep_first(df, ["id"], c.READ_ORDER).select("id", "kind")) == [("1", "p=1")]

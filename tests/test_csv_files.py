"""CSV files as other programs write them: headers that differ, quotes, line ends in values, whole numbers as doubles."""

from __future__ import annotations

import csv

import pytest

from fleetfeatures.sources import files


def _schema(spark, text):
    return spark.createDataFrame([], text).schema


def _dataset(tmp_path, name="d.csv", **parts):
    folder = tmp_path / name
    folder.mkdir(parents=True)
    for part, text in parts.items():
        (folder / f"{part}.csv").write_text(text, newline="")
    return str(folder)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_files_are_read_by_their_own_header(spark, tmp_path):
    path = _dataset(tmp_path, one="a,b\n10,20\n", two="b,a\n200,100\n", three="B,c,A\n2,x,1\n", four="a\n7\n", five="", six="\n\na,b\n5,6\n")
    got = files.read_csv(spark, path, _schema(spark, "a int, b int"))
    assert _rows(got) == sorted([(1, 2), (5, 6), (7, None), (10, 20), (100, 200)], key=repr)
    wide = files.read_csv(spark, path)
    assert {c.lower() for c in wide.columns} == {"a", "b", "c"} and wide.count() == 5
    assert sorted(r["a"] for r in wide.toDF(*[c.lower() for c in wide.columns]).collect()) == [1, 5, 7, 10, 100]
    with pytest.raises(ValueError, match="speed"):
        files.read_csv(spark, path, _schema(spark, "speed int"))


def test_names_with_blanks_and_signs(spark, tmp_path):
    path = _dataset(tmp_path / "a b%20c", "ü d.csv", **{"p 1+": "a,b\n1,2\n", "q%[x]": "b,a\n4,3\n"})
    assert _rows(files.read_csv(spark, path, _schema(spark, "a int, b int"))) == [(1, 2), (3, 4)]


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_quotes_commas_and_line_ends(spark, tmp_path, ends):
    values = ['say "hi", you', "two\nlines", 'a "quoted\nline", too', "back\\slash\\", '"', 'x""y', "plain", "5\" pipe", "ends with \\"]
    folder = tmp_path / "q.csv"
    folder.mkdir()
    for part, rows in (("one", values[:4]), ("two", values[4:])):
        with open(folder / f"{part}.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator=ends)
            writer.writerow(["n", "text"])
            writer.writerows((i, v) for i, v in enumerate(rows))
    with open(folder / "three.csv", "w", newline="") as out:
        out.write(f"text,n{ends}unquoted 5 inch,7{ends}")
    got = files.read_csv(spark, str(folder), _schema(spark, "n int, text string"))
    assert sorted(r.text for r in got.collect()) == sorted([*values, "unquoted 5 inch"])
    assert sorted(r.n for r in got.collect()) == sorted([*range(4), *range(5), 7])
    spans = {r.path.rsplit("/", 1)[1]: r.spans for r in files.headers(spark, str(folder)).collect()}
    assert spans == {"one.csv": True, "two.csv": False, "three.csv": False}


def test_written_files_read_back(spark, tmp_path):
    rows = [(1, 'a "b" c'), (2, "x,\ny"), (3, "\\"), (4, '"'), (5, "NA and more"), (6, "é"), (7, " blanks "), (8, "x\t")]
    df = spark.createDataFrame(rows, "n int, text string")
    files.write_csv(df, str(tmp_path / "w.csv"))
    assert _rows(files.read_csv(spark, str(tmp_path / "w.csv"), df.schema)) == rows


def test_whole_numbers_in_any_form(spark, tmp_path):
    text = "n,b\n2.0,1\n1e3,1\n1152921504606846977.0,2\n9223372036854775807,1\n2.5,1\n1e30,1\n-3.000,300\n x,1\nNA,7.0\n 8 ,1\n"
    path = _dataset(tmp_path, one=text)
    schema = _schema(spark, "n long, b tinyint")
    got = [r.n for r in files.read_csv(spark, path, schema).collect()]
    assert got == [2, 1000, 1152921504606846977, 9223372036854775807, None, None, -3, None, None, 8]
    assert {tuple(r) for r in files.unreadable(spark, path, schema).collect()} == {("n", 9, 3), ("b", 10, 1)}


def test_one_large_file_is_still_split(spark, tmp_path):
    path = _dataset(tmp_path, one="a,b\n" + "1,\"x\"\n" * 40_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        got = files.read_csv(spark, path, _schema(spark, "a int, b string"))
        assert got.rdd.getNumPartitions() > 4 and got.count() == 40_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_headers_sort_no_lines(spark, tmp_path):
    """The pass over the text keeps one buffer per file: lines were sorted by their file before, a task's whole text in memory."""
    (tmp_path / "a.csv").write_text('\nk,note\n1,"two\nlines"\n')
    (tmp_path / "b.csv").write_text('k,note\n1,"one ""line"""\n')
    found = files.headers(spark, str(tmp_path))
    rows = {r.path.rsplit("/", 1)[1]: (r.header, r.spans) for r in found.collect()}
    assert rows == {"a.csv": ("k,note", True), "b.csv": ("k,note", False)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan

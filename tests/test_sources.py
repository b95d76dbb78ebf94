import csv
import os
import random

import pytest

from rivalry import session
from rivalry.sources import files


def test_csv_round_trip(spark, rows, tmp_path):
    """Quotes, commas and empty cells survive; every column comes back as text."""
    df = spark.createDataFrame([("5'11\"", "a, b", 1), (None, 'say "x"', 2)], "height string, `Sig. str.` string, n int")
    files.write_csv(df, str(tmp_path / "t.csv"))
    got = files.read_raw(spark, str(tmp_path / "t.csv"))
    assert {f.dataType.simpleString() for f in got.schema.fields} == {"string"}
    assert rows(got) == [("5'11\"", "a, b", "1"), (None, 'say "x"', "2")]
    known = files.read_raw(spark, str(tmp_path / "t.csv"), ["height", "Sig. str.", "n"])
    assert rows(known) == rows(got)


def test_table_reads_only_listed_columns(spark, tmp_path):
    files.write_table(spark.range(5).selectExpr("id", "id * 2 as b", "'x' as c"), str(tmp_path / "t.parquet"))
    df = files.read_table(spark, str(tmp_path / "t.parquet"), ["b"])
    assert "ReadSchema: struct<b:bigint>" in df._jdf.queryExecution().executedPlan().toString()


def test_json_and_lines(spark, tmp_path):
    df = spark.createDataFrame([({"a": ["x", None]}, "u1")], "m map<string,array<string>>, url string")
    files.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first()["m"]["a"] == ["x", None]
    files.write_lines(df, "url", str(tmp_path / "l"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "l")).collect()] == ["u1"]


def test_pages(spark, rows, tmp_path):
    """One row per page file, whatever its lines; other files are not read."""
    for name, text in (("b.html", "<p>\n2\n</p>"), ("a.html", "<p>1</p>"), ("c.txt", "no")):
        (tmp_path / name).write_text(text)
    assert rows(files.read_pages(spark, str(tmp_path))) == [("a", "<p>1</p>"), ("b", "<p>\n2\n</p>")]


def test_records(spark, rows):
    schema = spark.createDataFrame([], "a int, b string").schema
    one = files.table_from_records(spark, [{"a": 1, "b": "x"}, {"a": 2}], schema)
    two = spark.createDataFrame([(3, 1.5)], "a int, c double")
    assert rows(files.union_records(one, two)) == [(1, "x", None), (2, None, None), (3, None, 1.5)]


def test_stored_table_is_a_scan(spark):
    df = session.stored(spark.range(10).selectExpr("id", "id % 2 as k"))
    plan = df.select("k")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "struct<k:bigint>" in plan and df.count() == 10


class Context:
    def __init__(self, master, conf):
        self.master, self.folder, self.conf = master, None, conf

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, named=None):
        self.sparkContext = Context(master, {})
        self.conf = {"spark.checkpoint.dir": named} if named else {}


def test_shared_folder_is_required_on_a_cluster():
    named = Session("yarn", "hdfs:///shared")
    session.ensure_checkpoint_dir(named)
    assert named.sparkContext.folder == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session("spark://host:7077"))
    local = Session("local[2]")
    session.ensure_checkpoint_dir(local)
    assert os.path.isdir(local.sparkContext.folder)


def test_csv_cells_may_hold_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"two\nlines"\n2,"a ""quote"""\n')
    got = [tuple(r) for r in files.read_raw(spark, str(tmp_path / "a.csv")).orderBy("id").collect()]
    assert got == [("1", "two\nlines"), ("2", 'a "quote"')]


@pytest.mark.parametrize("size", [64, 301, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_records_are_found_from_any_split(spark, rows, tmp_path, size, end):
    """Splits of a few bytes begin inside cells, quotes and records; all agree with one task."""
    pick = random.Random(size)
    cells = ["", "plain", '"quo""ted"', '"a, b"', '"two\nlines"', '"""\n"""', '"\n\n\n"', '"x' + "\ny" * 60 + '"', "é" * 30]
    for name in ("one", "two"):
        lines = ['"id\n1",b,"c ""d"""'] + [
            ",".join([str(k), pick.choice(cells), pick.choice(cells)]) for k in range(120)
        ]
        (tmp_path / f"{name}.csv").write_bytes((end.join(lines) + end * 2).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = files.read_raw(spark, str(tmp_path))
        lines = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        assert got.columns == ["id\n1", "b", 'c "d"'] and (lines > 30 or size > 1000)
        want = []
        for name in ("one", "two"):
            with open(tmp_path / f"{name}.csv", newline="") as handle:
                read = list(csv.reader(handle))[1:]
            want += [tuple(c or None for c in r) for r in read if r]
        assert len(want) == 240
        assert rows(got) == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
        assert rows(files.read_raw(spark, str(tmp_path), list("abc"))) == rows(got)
        if end == "\n":
            one_task = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
            assert rows(one_task.csv(str(tmp_path)).toDF(*"abc")) == rows(got.toDF(*"abc"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")

import io
import os
import tempfile
import zipfile

import pytest

from riskloom.registry import ORACLES, QUERIES
from riskloom.session import scratch_dir
from riskloom.sources import files
from riskloom.sources.store import append_rows, ensure_table, outside_retention


def zipped(**members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, text in members.items():
            z.writestr(name.replace("_", "."), text)
    return buffer.getvalue()


def put(folder, name, content):
    with open(os.path.join(folder, name), "wb") as f:
        f.write(content)


def test_archives_of_a_folder(spark, monkeypatch):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    put(folder, "a.zip", zipped(notes_txt="x", one_CSV='k,v\n1,"a, b"\n2,c\n', two_csv="k,v\n9,z\n"))
    put(folder, "b.csv", b"k\n3\n\xff4\n")
    rows = sorted((os.path.basename(r.path), r.line, r.k, r.v) for r in files.read_zip_csv(spark, folder, ["k", "v"]).collect())
    assert rows == [("a.zip", 1, "1", "a, b"), ("a.zip", 2, "2", "c"), ("b.csv", 1, "3", None), ("b.csv", 2, "4", None)]


@pytest.mark.parametrize("content, message", [(zipped(notes_txt="x"), "no CSV file"), (b"<!doctype><HTML></HTML>", "HTML")])
def test_archives_without_csv(spark, content, message):
    df = spark.createDataFrame([("p", bytearray(content))], "path string, content binary")
    with pytest.raises(Exception, match=message):
        files.expand_archives(df, ["k"]).collect()


def test_csv_types(spark):
    path = scratch_dir(spark, "csv")
    files.write_csv(spark.createDataFrame([(1, 2.5, None)], "a int, b double, c string"), path, ["c", "a", "b"])
    assert files.read_csv_strings(spark, path, ["c", "a", "b"]).first().asDict() == {"c": None, "a": "1", "b": "2.5"}
    assert dict(files.read_csv_inferred(spark, path).dtypes)["b"] == "double"
    assert dict(files.read_csv_inferred(spark, path, "c string, a bigint, b double").dtypes)["a"] == "bigint"


def test_tables(spark):
    path = scratch_dir(spark, "table")
    name = "t_" + path.rsplit("-", 1)[1]
    ensure_table(spark, name, "a int, b string", location=path)
    ensure_table(spark, name, "a int, b string")
    df = spark.createDataFrame([("x", 1)], "b string, a int")
    append_rows(df, name)
    append_rows(df.filter("a > 5"), name)
    append_rows(df, name)
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "x"), (1, "x")]


def test_retention_bounds(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-06-30 00:00:00' - make_dt_interval(d) AS at, d FROM VALUES 0, 29, 30, 60, 90, 91 AS v(d)")
    assert [r.d for r in outside_retention(df, "at", "2024-06-30 00:00:00").collect()] == [0, 29, 91]


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry

    entry.queries()
    assert set(ORACLES) <= set(QUERIES)


class FakeSession:
    """Only the settings of a session."""

    def __init__(self, **settings):
        self.settings = {k.replace("__", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_folder_follows_the_session():
    shared = FakeSession(spark__master="yarn", spark__checkpoint__dir="/shared/area/")
    assert scratch_dir(shared, "x").startswith("/shared/area/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession(spark__master="yarn"), "x")


def test_csv_strings_keep_quotes_and_line_breaks(spark, tmp_path):
    rows = [('a "b" c', "x\ny", "1"), (",", "z", None)]
    path = str(tmp_path / "quoted")
    files.write_csv(spark.createDataFrame(rows, "a string, b string, c string"), path, ["b", "c", "a"])
    got = files.read_csv_strings(spark, path, ["a", "b", "c", "d"], line_breaks=True).collect()
    assert sorted((r.a, r.b, r.c, r.d) for r in got) == sorted([(*rows[1], None), (*rows[0], None)])

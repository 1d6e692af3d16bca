"""Sinks: what lies in the folder after an export."""

import csv
import glob
import io
import json
import os
import sqlite3
import uuid
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from rowferry import Engine
from rowferry.functions.text import display_width
from rowferry.sinks import manifest, shards
from rowferry.sinks.files import list_files, open_path
from rowferry.sinks.shards import ShardsWritten, ShardWriter


@pytest.fixture
def engine(spark):
    return Engine(spark)


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def parts(path):
    return sorted(glob.glob(f"{path}/part-*"))


def listed(path):
    """The manifest of a folder."""
    return manifest.load(*open_path(str(path)))


def content(path):
    return [open(p, encoding="utf-8", newline="").read() for p in parts(path)]


ODD = [("a,b", 'say "x"', "line\nbreak"), (" lead", "trail ", ""), (None, "\\", "tab\t"),
       ("#c", "cr\rx", "'q'"), ("", "", "")]


def test_csv_quoting(spark, engine, out):
    df = spark.createDataFrame(ODD, "a string, b string, c string").coalesce(1)
    assert engine.export(df, "csv", out).rows == 5
    (text,) = content(out)
    rows = list(csv.reader(io.StringIO(text, newline="")))
    assert rows == [["a", "b", "c"]] + [[v or "" for v in row] for row in ODD]


def test_csv_single_empty_column(spark, engine, out):
    df = spark.createDataFrame([("",), (None,), ("x",)], "a string").coalesce(1)
    engine.export(df, "csv", out, no_headers=True)
    assert content(out) == ['""\n""\nx\n']


def test_csv_null_value(spark, engine, out):
    df = spark.createDataFrame([("", 1), (None, None)], "a string, b int").coalesce(1)
    engine.export(df, "csv", out, null_value="NULL")
    assert content(out) == ["a,b\n,1\nNULL,NULL\n"]


def test_empty_results_keep_their_frame(spark, engine, tmp_path):
    for n, df in enumerate((spark.createDataFrame([], "a int, b string"),
                            spark.range(10).selectExpr("id as a", "'x' as b").where("a < 0"))):
        for fmt, expected in (("json", "[\n\n]"), ("csv", "a,b\n"),
                              ("text", "┌─┬─┐\n│a│b│\n└─┴─┘\n")):
            path = str(tmp_path / f"{fmt}{n}")
            assert engine.export(df, fmt, path).rows == 0
            assert content(path) == [expected], fmt


def test_json_parts_are_arrays(spark, engine, out):
    df = spark.range(1000).selectExpr("id", "concat('n', id) as name").repartition(3)
    report = engine.export(df, "json", out, max_rows_per_file=100, compact=True)
    assert report.rows == 1000 and report.files == len(parts(out)) >= 10
    rows = [row for text in content(out) for row in json.loads(text)]
    assert sorted(r["id"] for r in rows) == list(range(1000))
    found = listed(out)
    assert found["rows"] == 1000 and all(f["rows"] <= 100 for f in found["files"])


def test_json_pretty_text(spark, engine, out):
    df = spark.sql("select 1 as a, 'x\"y' as b, 1e20D as c union all select 2, null, 0.5D").coalesce(1)
    engine.export(df, "json", out, indent=2)
    assert content(out) == [
        '[\n{\n  "a": 1,\n  "b": "x\\"y",\n  "c": 100000000000000000000\n},\n'
        '{\n  "a": 2,\n  "b": null,\n  "c": 0.5\n}\n]']


def test_order_by_gives_parts_in_order(spark, engine, out):
    df = spark.range(5000).select(F.expr("5000 - id").alias("k")).repartition(4)
    engine.export(df, "json", out, order_by=["k"], compact=True)
    keys = [row["k"] for text in content(out) for row in json.loads(text)]
    assert keys == sorted(keys) and len(keys) == 5000


def test_partitions_spread_rows_evenly(spark, engine, tmp_path):
    df = spark.range(1000).select(F.expr("1000 - id").alias("k")).coalesce(1)
    report = engine.export(df, "json", str(tmp_path / "a"), partitions=4, compact=True)
    sizes = [len(json.loads(text)) for text in content(tmp_path / "a")]
    assert report.files == 4 and sum(sizes) == 1000 and max(sizes) < 300
    engine.export(df, "json", str(tmp_path / "b"), partitions=4, order_by=["k"], compact=True)
    keys = [row["k"] for text in content(tmp_path / "b") for row in json.loads(text)]
    assert keys == list(range(1, 1001)) and len(parts(tmp_path / "b")) == 4


def test_html_page(spark, engine, out):
    df = spark.sql("select '<i>' as `a&b`, X'27' as raw").coalesce(1)
    engine.export(df, "html", out, title="T<>")
    (page,) = content(out)
    assert "<title>T&lt;&gt;</title>" in page and "<th>a&amp;b</th>" in page
    assert "<tr>\n    <td>&lt;i&gt;</td>\n    <td>\\&#x27;</td>\n</tr>\n</tbody>" in page


def brute_table(names, rows, width):
    """The table drawn in plain Python, cell by cell."""
    cells = [[[n] for n in names]] + [[(v.splitlines() or [""]) for v in row] for row in rows]
    widths = [max(width(line) for row in cells for line in row[i]) for i in range(len(names))]
    rule = lambda a, b, c: a + b.join("─" * w for w in widths) + c
    drawn = []
    for row in cells:
        height = max(len(c) for c in row)
        lines = ["│" + "│".join(
            (c[i] if i < len(c) else "") + " " * (w - width(c[i] if i < len(c) else ""))
            for c, w in zip(row, widths)) + "│" for i in range(height)]
        drawn.append("\n".join(lines))
    middle = "\n" + rule("├", "┼", "┤") + "\n"
    return rule("┌", "┬", "┐") + "\n" + middle.join(drawn) + "\n" + rule("└", "┴", "┘") + "\n"


def test_text_table_with_line_breaks(spark, engine, out):
    rows = [("one", "1\n22\n\n4"), ("日本\nx", ""), ("", "end\n"), ("a\r\nb", "\n\n"), ("e\u0301", "z")]
    df = spark.createDataFrame(rows, "name string, v string").coalesce(1)
    engine.export(df, "text", out)
    lines = {line for row in rows for cell in row for line in cell.splitlines()} | {"", "name", "v"}
    sized = spark.createDataFrame([(x,) for x in lines], "s string").select("s", display_width(F.col("s")).alias("w"))
    widths = {r.s: r.w for r in sized.collect()}
    assert content(out) == [brute_table(["name", "v"], rows, widths.__getitem__)]


def test_text_table_of_documents(spark, engine, out):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    engine.export(docs.coalesce(1), "text", out)
    rows = [(str(r.doc_id), r.text) for r in docs.collect()]
    lines = {line for row in rows for cell in row for line in cell.split("\n")} | {"doc_id", "text", ""}
    sized = spark.createDataFrame([(x,) for x in lines], "s string").select("s", display_width(F.col("s")).alias("w"))
    widths = {r.s: r.w for r in sized.collect()}
    assert all("\r" not in t and "\x0b" not in t and "\u2028" not in t for _, t in rows)
    assert content(out) == [brute_table(["doc_id", "text"], rows, widths.__getitem__)]


def test_vertical_sorted(spark, engine, out):
    df = spark.sql("select 2 as b, 'x' as a, null as c").coalesce(1)
    engine.export(df, "text-vertical", out, sort_columns=True)
    assert content(out) == ["──────────\na: x\nb: 2\nc: \n"]


def test_debug_dump(spark, engine, out):
    df = spark.sql("select 1L as a, 'x' as b union all select null, null").coalesce(1)
    engine.export(df, "debug", out)
    assert content(out) == [
        '#prepare_for_results\n#columns\nColumnInfo { name: "a", data_type: I64 }'
        'ColumnInfo { name: "b", data_type: String }\nI64(1)String("x")\nNoneNone\n']


def test_parquet_all_types(spark, engine, out):
    df = spark.sql("select 1L as a, cast(2 as smallint) as b, date'2020-01-01' as d, "
                   "timestamp_ntz'2020-01-01 01:02:03' as t, time'01:02:03' as tm, null as n, 'abcd' as s")
    engine.export(df, "parquet", out, truncate=2)
    row = spark.read.parquet(out)
    assert row.first().s == "ab ...(2 bytes trimmed)" and row.first().b == 2
    assert dict(row.dtypes)["tm"].startswith("time") and dict(row.dtypes)["n"] == "string"


def test_sqlite_shards(spark, engine, out):
    df = spark.sql("select id, cast(id as float) as f, id > 5 as flag, X'00' as b, "
                   "timestamp_ntz'2020-01-01 01:02:03.9' as `t t`, null as n from range(10)").repartition(2)
    engine.export(df, "sqlite", out, table="my table", max_rows_per_file=3)
    rows, ddl = [], set()
    for path in parts(out):
        db = sqlite3.connect(path)
        rows += db.execute('select * from "my table"').fetchall()
        ddl.add(db.execute("select sql from sqlite_master").fetchone()[0])
    assert sorted(rows)[6] == (6, 6.0, 1, b"\x00", "2020-01-01 01:02:03", None) and len(rows) == 10
    assert ddl == {'CREATE TABLE "my table" ("id" integer, "f" float, "flag" bool, "b" blob, '
                   '"t t" datetime, "n" text)'}


def test_unsigned_overflow_fails(spark, engine, out):
    df = spark.sql("select cast(18446744073709551615 as decimal(20,0)) as u")
    with pytest.raises(Exception, match="does not fit 64 signed bits"):
        engine.export(df, "sqlite", out)


def test_xlsx_parts(spark, engine, out):
    df = spark.sql("select 5L as n, ' <a>_x0041_' as s, date'2020-01-01' as d, true as b, 0.1D as x").coalesce(1)
    engine.export(df, "xlsx", out)
    book = zipfile.ZipFile(parts(out)[0])
    for name in book.namelist():
        ElementTree.fromstring(book.read(name))
    sheet = book.read("xl/worksheets/sheet1.xml").decode()
    assert '<c><v>5</v></c>' in sheet and '<c s="1"><v>43831</v></c>' in sheet
    assert '<t xml:space="preserve"> &lt;a&gt;_x005F_x0041_</t>' in sheet
    assert '<c t="b"><v>1</v></c><c><v>0.1</v></c>' in sheet and '<col min="3" max="3"' in sheet
    assert "yyyy-mm-ddThh:mm:ss" in book.read("xl/styles.xml").decode()


def test_xlsx_refuses_what_a_cell_cannot_hold(spark, engine, out):
    with pytest.raises(Exception, match="more than 32767 characters"):
        engine.export(spark.sql("select repeat('x', 32768) as s"), "xlsx", out)
    with pytest.raises(Exception, match="control character"):
        engine.export(spark.sql("select 'a\\u0001' as s"), "ods", out)


def test_xlsx_control_characters(spark, engine, out):
    df = spark.createDataFrame([("a\x01\x1fb\n\uffff",)], "s string")
    engine.export(df, "xlsx", out)
    sheet = zipfile.ZipFile(parts(out)[0]).read("xl/worksheets/sheet1.xml").decode()
    assert ">a_x0001__x001F_b\n_xFFFF_</t>" in sheet
    ElementTree.fromstring(sheet)


def test_ods_parts(spark, engine, out):
    df = spark.sql("select 1.5D as n, ' two  blanks\\nline' as s, date'2020-01-01' as d, false as b").coalesce(1)
    engine.export(df, "ods", out)
    book = zipfile.ZipFile(parts(out)[0])
    assert book.namelist()[0] == "mimetype" and book.infolist()[0].compress_type == zipfile.ZIP_STORED
    sheet = book.read("content.xml").decode()
    ElementTree.fromstring(sheet)
    assert 'office:value-type="float" office:value="1.5"/>' in sheet
    assert "<text:p><text:s/>two <text:s/>blanks</text:p><text:p>line</text:p>" in sheet
    assert 'office:date-value="2020-01-01T00:00:00"/>' in sheet and 'office:boolean-value="false"/>' in sheet


def test_failed_export_keeps_the_old_result(spark, engine, out):
    engine.export(spark.range(3), "json", out, compact=True)
    before = content(out)
    with pytest.raises(Exception, match="boom"):
        engine.export(spark.range(3).selectExpr("if(id = 2, raise_error('boom'), id) as id"), "json", out)
    assert content(out) == before
    assert len(listed(out)["files"]) == len(parts(out))
    engine.export(spark.range(1), "json", out, compact=True)
    assert content(out) == ['[{"id":0}]']


def attempt_file(folder, job, attempt, text):
    name = f"part-0000000000-00000-{job}-{attempt}"
    (folder / name).write_text(text)
    return name


@pytest.mark.parametrize("overwrite", [True, False])
def test_stray_attempts_are_not_published(tmp_path, overwrite):
    """Files of an attempt that never reported go with the commit."""
    writer = ShardWriter({"path": str(tmp_path), "job": "j"}, overwrite)
    attempt_file(tmp_path, "j", 1, "stray")
    good = attempt_file(tmp_path, "j", 2, "good")
    writer.commit([ShardsWritten([(good, 1)])])
    assert content(tmp_path) == ["good"] and [f["file"] for f in listed(tmp_path)["files"]] == [good]


class Killed(Exception):
    pass


@pytest.mark.parametrize("overwrite", [True, False])
def test_a_commit_killed_midway_leaves_the_old_result(tmp_path, monkeypatch, overwrite):
    old = attempt_file(tmp_path, "a", 1, "old")
    ShardWriter({"path": str(tmp_path), "job": "a"}, True).commit([ShardsWritten([(old, 1)])])
    new = attempt_file(tmp_path, "b", 1, "new")
    writer, plain = ShardWriter({"path": str(tmp_path), "job": "b"}, overwrite), manifest.json.dumps
    names = lambda: [os.path.basename(p) for p, _ in list_files(str(tmp_path))]

    def die(*_):
        raise Killed

    monkeypatch.setattr(manifest.json, "dumps", die)  # the manifest is opened but never filled
    with pytest.raises(Killed):
        writer.commit([ShardsWritten([(new, 1)])])
    assert names() == [old] and (tmp_path / old).read_text() == "old"
    (tmp_path / "_manifest-0000000007-c.json").write_text('{"rows": 3, "files": [{"fi')  # or only in part
    assert names() == [old]
    monkeypatch.setattr(manifest.json, "dumps", plain)
    writer.commit([ShardsWritten([(new, 1)])])
    assert names() == ([new] if overwrite else [old, new])
    writer.abort([])  # what is published stays
    assert new in names() and (tmp_path / new).exists()


def test_publishing_moves_nothing(spark, engine, out, monkeypatch):
    engine.export(spark.range(5), "json", out, compact=True, partitions=2)
    inodes = {os.stat(p).st_ino for p in parts(out)}
    engine.export(spark.range(5, 9), "json", out, compact=True, partitions=2, mode="append")
    assert inodes < {os.stat(p).st_ino for p in parts(out)} and listed(out)["rows"] == 9
    source = "".join(open(m.__file__).read() for m in (shards, manifest))
    assert ".move(" not in source and "rename" not in source
    # what another job is writing meanwhile is not part of the result
    open(f"{out}/part-0000000000-00000-other-7.json", "w").write("[")
    files = engine.files(out)
    assert len(files) == 4 and spark.read.schema("id long").json(files, multiLine=True).count() == 9
    with pytest.raises(ValueError, match="another format"):
        engine.export(spark.range(1), "csv", out, mode="append")


def test_duplicate_names(spark, engine, tmp_path):
    df = spark.sql("select 1 as a, 2 as a")
    engine.export(df, "text-vertical", str(tmp_path / "v"))
    assert content(tmp_path / "v") == ["──────────\na: 1\na: 2\n"]
    with pytest.raises(ValueError, match="distinct column names"):
        engine.export(df, "json", str(tmp_path / "j"))


def test_unknown_format(spark, engine, out):
    with pytest.raises(ValueError, match="unknown format"):
        engine.export(spark.range(1), "pdf", out)
    with pytest.raises(ValueError, match="needs a path"):
        engine.export(spark.range(1), "csv")
    with pytest.raises(TypeError, match="unsupported column type"):
        engine.export(spark.sql("select array(1) as a"), "csv", out)


def test_saved_table(spark, engine):
    engine.export(spark.sql("select true as b, 1.5f as f, 'x' as s"), "table", table="saved_rows")
    row = spark.table("saved_rows").first()
    assert row == (1, 1.5, "x")


def test_text_table_never_cuts(spark, engine, out):
    from rowferry.sinks.lines import TableLayout

    for rows in (spark.sql("select 123456789 as a"), spark.sql("select 'much too long' as a")):
        with pytest.raises(Exception, match="wider than its column"):
            engine.export(rows, "text", out, layout=TableLayout([3], False))


@pytest.mark.parametrize("fmt", ["csv", "json", "sqlite", "parquet", "xlsx"])
def test_modes_are_alike(spark, engine, out, fmt):
    rows = spark.range(3)
    assert engine.export(rows, fmt, out, partitions=1, mode="errorifexists").files == 1
    with pytest.raises(FileExistsError):
        engine.export(rows, fmt, out, mode="errorifexists")
    assert engine.export(rows, fmt, out, mode="ignore").rows == 0
    assert engine.export(rows, fmt, out, partitions=1, mode="append").files == 1
    if fmt in ("json", "sqlite", "xlsx"):
        assert listed(out)["rows"] == 6 and len(listed(out)["files"]) == 2
        assert len([f for f in os.listdir(out) if f.startswith("_manifest")]) == 1


def test_debug_header_escapes_names(spark, engine, out):
    engine.export(spark.range(1).toDF('a"b'), "debug", out)
    assert 'name: "a\\"b"' in content(out)[0]


def test_serials_of_early_dates(spark):
    from rowferry.functions.cells import stage_xlsx
    from pyspark.sql import types as T

    days = spark.sql("select * from values (date'1900-01-01'), (date'1900-02-28'), (date'1900-03-01') as t(d)")
    found = [r[0] for r in days.select(stage_xlsx(F.col("d"), T.DateType()).value).collect()]
    assert found == [1, 59, 61]
    with pytest.raises(Exception, match="before 1900"):
        spark.sql("select date'1899-12-31' as d").select(stage_xlsx(F.col("d"), T.DateType()).value).collect()


def test_an_export_leaves_the_session_as_it_was(spark, engine, out):
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, "9000")
    engine.export(spark.range(1), "csv", out)
    assert spark.conf.get(name) == "9000"
    spark.conf.unset(name)


def test_a_path_means_the_same_place_to_every_sink(spark, engine, tmp_path):
    """Below a default file system that leads elsewhere, as on a cluster."""
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.viewfs.mounttable.here.link./data", f"file://{tmp_path}")
    conf.set("fs.defaultFS", "viewfs://here")
    try:
        for fmt in ("csv", "json", "sqlite"):
            assert engine.export(spark.range(3), fmt, f"/data/{fmt}", partitions=1).files == 1
            assert len(parts(tmp_path / fmt)) == 1
    finally:
        conf.set("fs.defaultFS", before)


def test_sqlite_files_are_bounded_by_bytes(spark, engine, out):
    rows = spark.range(5000).selectExpr("id", "repeat('x', 1000) as v").coalesce(1)
    report = engine.export(rows, "sqlite", out, max_bytes_per_file=1 << 20)
    assert report.files >= 3 and report.rows == 5000
    assert all(os.path.getsize(p) < 4 << 20 for p in parts(out))
    counts = [sqlite3.connect(p).execute("select count(*) from data").fetchone()[0] for p in parts(out)]
    assert sum(counts) == 5000


def test_times_of_day_over_jdbc(spark, engine):
    from rowferry.sources.jdbc import JdbcSource, read_jdbc

    derby = JdbcSource(url="jdbc:derby:memory:times;create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    rows = spark.sql("select 1 as k, time'12:34:56.5' as t")
    engine.export(rows, "table", url=derby.url, table="times", properties={"driver": derby.driver},
                  column_types="t varchar(20)")
    assert read_jdbc(spark, derby, 'select "t" as t from times').first()[0] == "12:34:56"

"""Sinks over whole tables: written, read back and compared with the input."""

from __future__ import annotations

import re
import zipfile
from io import BytesIO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import functions as F

from rowferry.plans.scalars import html_sql, number_sql
from rowferry.plans.sources import database
from rowferry.plans.tables import load
from rowferry.sinks.export import export
from rowferry.sinks.lines import RECORD_RULE, html_rows
from rowferry.sources.jdbc import read_jdbc
from rowferry.sources.query import scratch_path
from rowferry.sources.sqlite import read_sqlite

CSV_READ = {"header": True, "escape": '"', "nullValue": "\x00"}


def _written(spark, sf, name, fmt, columns=("*",), **options):
    path = scratch_path(spark, fmt)
    export(load(spark, sf, name).select(*columns), fmt, path, **options)
    return path


def snk_csv(spark, sf):
    path = _written(spark, sf, "lineitem", "csv")
    return spark.read.options(**CSV_READ).csv(path)


def snk_csv_text(spark, sf):
    """Texts with quotes, commas and line breaks."""
    path = _written(spark, sf, "documents", "csv", ("doc_id", "text", "source"))
    return spark.read.options(**CSV_READ, multiLine=True).csv(path).fillna("")


def snk_parquet(spark, sf):
    path = _written(spark, sf, "documents", "parquet")
    return spark.read.parquet(path)


def snk_json_array(spark, sf):
    path = _written(spark, sf, "customer", "json")
    kinds = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return spark.read.schema(kinds).json(path, multiLine=True)


def snk_json_compact(spark, sf):
    path = _written(spark, sf, "events", "json", compact=True, max_rows_per_file=2000)
    kinds = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"
    return spark.read.schema(kinds).json(path, multiLine=True)


def snk_jsonlines(spark, sf):
    path = _written(spark, sf, "conversations", "jsonlines")
    return spark.read.schema("conv_id bigint, turn bigint, role string, text string").json(path)


def snk_html(spark, sf):
    path = _written(spark, sf, "pages", "html", title="pages")
    rows = spark.read.text(path, lineSep="</tr>\n").where(F.contains("value", F.lit("<td>")))
    return rows.select(F.regexp_replace("value", r"(?s)^.*?<tbody>\n", "").alias("row"))


def snk_html_rows(spark, sf):
    return html_rows(load(spark, sf, "customer"))


def snk_text_table(spark, sf):
    path = _written(spark, sf, "orders", "text")
    lines = spark.read.text(path).where(F.startswith("value", F.lit("│")))
    # every part file repeats the header
    return lines.where(~F.startswith("value", F.lit("│o_orderkey"))).withColumnRenamed("value", "line")


def snk_vertical(spark, sf):
    path = _written(spark, sf, "part", "text-vertical")
    records = spark.read.text(path, lineSep=RECORD_RULE + "\n").where("value <> ''")
    return records.select(F.rtrim("value", F.lit("\n")).alias("record"))


def snk_debug(spark, sf):
    path = _written(spark, sf, "customer", "debug")
    lines = spark.read.text(path).where(~F.col("value").rlike("^(#|ColumnInfo)"))
    return lines.withColumnRenamed("value", "line")


def snk_sqlite(spark, sf):
    path = _written(spark, sf, "part", "sqlite", table="parts")
    return read_sqlite(spark, path, table="parts")


def snk_table(spark, sf):
    source = database(spark)
    properties = {"driver": source.driver} if source.driver else {}
    events = load(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    export(events, "table", url=source.url, table="events_out", properties=properties)
    rows = read_jdbc(spark, source, "select * from events_out", partitions=8)
    return rows.toDF(*[c.lower() for c in rows.columns])


def _workbook_cells(spark, path, columns):
    """All data rows of the shards as text, each file parsed in a stream."""
    schema = ", ".join(f"{c} string" for c in columns)

    def parse(batches):
        for batch in batches:
            for content in batch["content"]:
                book = zipfile.ZipFile(BytesIO(content))
                xlsx = "xl/workbook.xml" in book.namelist()
                part = "xl/worksheets/sheet1.xml" if xlsx else "content.xml"
                rows, first = [], True
                for _, node in ElementTree.iterparse(book.open(part)):
                    if node.tag.rsplit("}", 1)[-1] in ("row", "table-row"):
                        if not first:  # the first row of a file is its header
                            rows.append([cell_value(cell) for cell in node])
                        first = False
                        node.clear()
                    if len(rows) > 5000:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(parse, schema)


def cell_value(cell):
    typed = [v for k, v in cell.attrib.items() if re.search(r"}(date-|boolean-)?value$", k)]
    return typed[0] if typed else "".join(cell.itertext())


def snk_xlsx(spark, sf):
    path = _written(spark, sf, "orders", "xlsx", max_rows_per_file=4000)
    return _workbook_cells(spark, path, load(spark, sf, "orders").columns)


def snk_ods(spark, sf):
    path = _written(spark, sf, "part", "ods")
    return _workbook_cells(spark, path, load(spark, sf, "part").columns)


SUMMARY_FORMATS = (
    "csv", "json", "jsonlines", "html", "text", "text-vertical", "debug", "parquet", "sqlite",
    "xlsx", "ods",
)


def snk_summary(spark, sf):
    """The row count each sink reports, counted while writing."""
    suppliers = load(spark, sf, "supplier")
    reports = [
        (fmt, export(suppliers, fmt, scratch_path(spark, fmt)).rows) for fmt in SUMMARY_FORMATS
    ]
    return spark.createDataFrame(reports, "format string, n bigint")


QUERIES = {
    f.__name__: f
    for f in (
        snk_csv, snk_csv_text, snk_parquet, snk_json_array, snk_json_compact, snk_jsonlines,
        snk_html, snk_html_rows, snk_text_table, snk_vertical, snk_debug, snk_sqlite, snk_table,
        snk_xlsx, snk_ods, snk_summary,
    )
}


def row_sql(values) -> str:
    cells = " || ".join(f"'    <td>' || {v} || '</td>' || chr(10)" for v in values)
    return f"'<tr>' || chr(10) || {cells}"


def padded_sql(name: str, value: str, table: str) -> str:
    width = f"(select greatest({len(name)}, max(length({value}))) from {table})"
    return f"rpad({value}, {width}::integer, ' ')"


ORDER_TEXTS = {
    "o_orderkey": "o_orderkey::varchar", "o_custkey": "o_custkey::varchar",
    "o_orderstatus": "o_orderstatus", "o_totalprice": number_sql("o_totalprice"),
    "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
    "o_orderpriority": "o_orderpriority",
}

ORACLES = {
    "snk_csv": f"""
        select l_orderkey::varchar as l_orderkey, l_partkey::varchar as l_partkey,
               l_suppkey::varchar as l_suppkey, l_linenumber::varchar as l_linenumber,
               {number_sql('l_quantity')} as l_quantity,
               {number_sql('l_extendedprice')} as l_extendedprice,
               {number_sql('l_discount')} as l_discount, {number_sql('l_tax')} as l_tax,
               l_returnflag, l_linestatus,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as l_shipdate from lineitem""",
    "snk_csv_text": "select doc_id::varchar as doc_id, text, source from documents",
    "snk_parquet": f"""
        select doc_id, text, lang, source, n_chars from documents""",
    "snk_json_array": "select * from customer",
    "snk_json_compact": """
        select * replace (strftime(ts, '%Y-%m-%d %H:%M:%S') as ts) from events""",
    "snk_jsonlines": "select conv_id, turn, role, text from conversations",
    "snk_html": f"""
        select {row_sql(['page_id', html_sql('url'), html_sql('html')])} as row from pages""",
    "snk_html_rows": f"""
        select {row_sql(['c_custkey', html_sql('c_name'), 'c_nationkey',
                         number_sql('c_acctbal'), html_sql('c_mktsegment')])}
               || '</tr>' || chr(10) as line from customer""",
    "snk_text_table": "select '│' || "
        + " || '│' || ".join(padded_sql(n, v, "orders") for n, v in ORDER_TEXTS.items())
        + " || '│' as line from orders",
    "snk_vertical": f"""
        select 'p_partkey: ' || p_partkey || chr(10) || 'p_name: ' || p_name || chr(10)
               || 'p_brand: ' || p_brand || chr(10) || 'p_type: ' || p_type || chr(10)
               || 'p_size: ' || p_size || chr(10) || 'p_retailprice: '
               || {number_sql('p_retailprice')} as record from part""",
    "snk_debug": """
        select 'I64(' || c_custkey || ')String("' || c_name || '")I32(' || c_nationkey
               || ')F64(' || cast(c_acctbal as varchar) || ')String("' || c_mktsegment || '")'
               as line from customer""",
    "snk_sqlite": "select * replace (p_size::bigint as p_size) from part",
    "snk_table": "select event_id, ts, user_id, event_type, value from events",
    "snk_xlsx": f"""
        select o_orderkey::varchar as o_orderkey, o_custkey::varchar as o_custkey, o_orderstatus,
               {number_sql('o_totalprice')} as o_totalprice,
               {number_sql("epoch(o_orderdate)::bigint / 86400.0::double + 25569")} as o_orderdate,
               o_orderpriority from orders""",
    "snk_ods": f"""
        select p_partkey::varchar as p_partkey, p_name, p_brand, p_type,
               p_size::varchar as p_size, {number_sql('p_retailprice')} as p_retailprice
        from part""",
    "snk_summary": "select format, (select count(*) from supplier) as n from (values "
        + ", ".join(f"('{f}')" for f in SUMMARY_FORMATS) + ") t(format)",
}

"""One way into every sink: ``export(df, format, path, **options)``."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from rowferry.functions.cellvalue import is_time
from rowferry.functions.debug import unified_type
from rowferry.operators.normalise import ddl_types, table_columns, to_parquet_columns
from rowferry.sinks import lines, manifest
from rowferry.sinks.files import list_files, open_path, qualify
from rowferry.sinks.jdbctable import write_table
from rowferry.sinks.framed import FramedText
from rowferry.sinks.sqlitefile import SqliteFiles
from rowferry.sinks.workbook import SHEET_COLUMNS, Workbook


@dataclass(frozen=True)
class ExportReport:
    rows: int
    seconds: float
    files: int


class _Export:
    """State of one export: the frame, the target and the row counter."""

    def __init__(self, df: DataFrame, path: str, truncate, max_rows, mode):
        self.path, self.truncate, self.max_rows, self.mode = path, truncate, max_rows, mode
        self.observation = Observation()
        self.spark = df.sparkSession
        # Counted while the rows pass by: no second job.
        self.df = df.observe(self.observation, F.count(F.lit(1)).alias("rows"))

    def native(self, df: DataFrame):
        if self.path and self.mode == "append" and manifest.load(*open_path(self.path)):
            raise ValueError(f"{self.path} holds a result with a manifest, of another format")
        writer = df.write.mode(self.mode)
        return writer.option("maxRecordsPerFile", self.max_rows) if self.max_rows else writer

    def shards(self, df: DataFrame, source, **options):
        self.spark.dataSource.register(source)
        options = {k: v for k, v in options.items() if v is not None}
        if self.max_rows:
            options["maxrows"] = str(self.max_rows)
        job = uuid.uuid4().hex[:12]
        try:
            df.write.format(source.name()).mode(self.mode).options(job=job, **options).save(self.path)
        except Exception:
            # tasks that Spark has only just told to stop may still have written after its own clean-up
            fs, root = open_path(self.path)
            for _ in range(10):
                time.sleep(0.1)
                if not manifest.withdraw(fs, root, job):
                    break
            raise


def _csv(e: _Export, no_headers=False, null_value=""):
    rows = lines.text_rows(e.df, e.truncate)
    # a record of one empty field is written as two quotes, else it would read as no record
    empty = '""' if len(rows.columns) == 1 else ""
    if null_value:
        rows = e.df.select(*[
            F.when(c.isNotNull(), text).alias(name)
            for name, c, text in (
                (n, c, lines.cell_text(c, t, e.truncate)) for n, c, t in lines._named(e.df)
            )
        ])
    e.native(rows).options(
        header=not no_headers, escape='"', nullValue=null_value or empty, emptyValue=empty,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(e.path)


def _json(e: _Export, compact=False, indent=4):
    start, between, end = ("[", ",", "]") if compact else ("[\n", ",\n", "\n]")
    rows = lines.json_rows(e.df, e.truncate, compact, indent)
    e.shards(rows, FramedText, prefix=start, separator=between, suffix=end, extension=".json")


def _jsonlines(e: _Export):
    e.native(lines.json_rows(e.df, e.truncate, compact=True)).text(e.path)


def _html(e: _Export, title=""):
    start, end = lines.html_frame(e.df.columns, title)
    e.shards(lines.html_rows(e.df, e.truncate), FramedText,
             prefix=start, suffix=end, extension=".html")


def _text(e: _Export, layout=None):
    # The widths need the whole result first, so the frame is read twice. Only the second
    # pass is observed.
    widths = layout.widths
    middle = "\n" + lines.table_rule("middle", widths) + "\n"
    top = lines.table_rule("top", widths) + "\n" + lines.table_header(e.df, layout)
    # A file of no rows has no rule between header and rows, so the rule leads each row.
    rows = lines.table_rows(e.df, layout, e.truncate)
    rows = rows.select(F.concat(F.lit(middle), "line").alias("line"))
    bottom = "\n" + lines.table_rule("bottom", widths) + "\n"
    e.shards(rows, FramedText, prefix=top, suffix=bottom)


def _vertical(e: _Export, sort_columns=False):
    e.native(lines.vertical_rows(e.df, e.truncate, sort_columns)).text(e.path)


def _debug(e: _Export):
    rows = lines.debug_rows(e.df).select(F.concat("line", F.lit("\n")).alias("line"))
    e.shards(rows, FramedText, prefix=lines.debug_header(e.df))


def _parquet(e: _Export):
    e.native(to_parquet_columns(e.df, e.truncate)).parquet(e.path)


def _sqlite(e: _Export, table="data", max_bytes_per_file=None):
    rows = table_columns(e.df, e.truncate, temporal_text=True)
    e.shards(rows, SqliteFiles, table=table, maxbytes=max_bytes_per_file, columns=json.dumps(e.df.columns),
             ddl=json.dumps(list(ddl_types(e.df).values())))


def _table(e: _Export, url=None, table="data", batch_size=500, properties=None,
           column_types=None, connections=None):
    """A database table over JDBC, or a table of the session's catalog if there is no url."""
    rows = table_columns(e.df, e.truncate)
    if url is None:
        e.native(rows).saveAsTable(table)
        return
    # databases over JDBC get times of day as text: Spark has no JDBC type for them
    rows = rows.withColumns({
        f.name: F.time_trunc(F.lit("SECOND"), F.col(f"`{f.name}`")).cast("string")
        for f in rows.schema.fields if is_time(f.dataType)})
    options = {"url": url, "batchsize": str(batch_size), **(properties or {})}
    write_table(rows, table, options, e.mode, column_types, connections)


def _workbook(kind: str):
    def write(e: _Export):
        if len(e.df.columns) > SHEET_COLUMNS:
            raise ValueError(f"a sheet holds at most {SHEET_COLUMNS} columns")
        render = lines.xlsx_rows if kind == "xlsx" else lines.ods_rows
        styles = [_style(f.dataType) for f in e.df.schema.fields]
        e.shards(render(e.df, e.truncate), Workbook, kind=kind,
                 columns=json.dumps(e.df.columns), styles=json.dumps(styles))

    return write


def _style(dtype: T.DataType) -> str | None:
    if isinstance(dtype, T.DateType):
        return "date"
    if is_time(dtype):
        return "time"
    return "datetime" if unified_type(dtype) in ("DateTime", "Timestamp") else None


FORMATS = {
    "csv": _csv, "json": _json, "jsonlines": _jsonlines, "html": _html, "text": _text,
    "text-vertical": _vertical, "debug": _debug, "parquet": _parquet, "sqlite": _sqlite,
    "table": _table, "xlsx": _workbook("xlsx"), "ods": _workbook("ods"),
}


def export(
    df: DataFrame,
    fmt: str,
    path: str | None = None,
    *,
    truncate: int | None = None,
    order_by: list | None = None,
    partitions: int | None = None,
    max_rows_per_file: int | None = None,
    mode: str = "overwrite",
    **options,
) -> ExportReport:
    """Write ``df`` and report rows, seconds and files.

    ``order_by`` sorts the whole result by range, so that part names sort in row order;
    without it the order is undefined. ``partitions`` spreads the rows evenly over that many
    tasks first, for sources of few splits such as one database cursor or one row group.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; known: {', '.join(FORMATS)}")
    if path is None and fmt != "table":
        raise ValueError(f"format {fmt!r} needs a path")
    started = time.monotonic()
    if path is not None:
        path = qualify(df.sparkSession, path)
    if partitions and not order_by:
        df = df.repartition(partitions)
    if order_by:
        df = df.repartitionByRange(partitions, *order_by) if partitions else df.orderBy(*order_by)
        df = df.sortWithinPartitions(*order_by) if partitions else df
    if mode not in ("overwrite", "append", "ignore", "errorifexists", "error"):
        raise ValueError(f"unknown mode {mode!r}")
    before = set()
    if path and mode != "overwrite":
        before = _present(path)
        if before and mode == "ignore":
            return ExportReport(0, time.monotonic() - started, 0)
        if before and mode != "append":
            raise FileExistsError(path)
        mode = "append"
    if fmt == "text" and "layout" not in options:
        options["layout"] = lines.table_layout(df, truncate)
    job = _Export(df, path, truncate, max_rows_per_file, mode)
    FORMATS[fmt](job, **options)
    rows = job.observation.get["rows"]
    files = len(_present(path) - before) if path else 0
    return ExportReport(rows, time.monotonic() - started, files)


def _present(path: str) -> set[str]:
    try:
        return {name for name, _ in list_files(path)}
    except FileNotFoundError:
        return set()

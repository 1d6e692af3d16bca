"""Folders of SQLite files as one table, read in parallel.

A task reads one file, or one part of the rows of a large file, in the order of their row ids. Where a large file is
cut is found once, by a job with a task per file. Filters given with a read are evaluated inside the files as far as
SQLite can tell them (``sqlite_filters.py``), so rows that do not match never leave them and indexes are used.

Files are opened in place where the path is a mounted folder. From object stores a file's bytes are fetched
first; such a file is never split, so it is fetched once, and one larger than ``FETCH_BYTES`` is refused.
"""

from __future__ import annotations

import json
import sqlite3

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from rowferry.sinks.files import list_files, open_path, qualify
from rowferry.sinks.sqlitefile import quote
from rowferry.sources.query import scratch_path
from rowferry.sources.sqlite_filters import conditions, from_text, normalised, spark_filter, to_text

BATCH_ROWS = 4096
SPLIT_BYTES = 128 * 1024 * 1024
FETCH_BYTES = 2 << 30
# Files that SQLite keeps beside a live database, and the names of the row id.
COMPANIONS = ("-wal", "-shm", "-journal")
ROW_IDS = ("rowid", "_rowid_", "oid")

CATALOG_SCHEMA = (
    "file string, table_name string, column_name string, column_type string, not_null int, "
    "default_value string, pk int, ordinal int"
)
STORAGE_SCHEMA = (
    "ordinal int, column_name string, integers boolean, reals boolean, texts boolean, "
    "blobs boolean, undecodable boolean"
)


CUTS_SCHEMA = "file string, part int, lower long, upper long"


class SqliteFleet(DataSource):
    """Options path, suffix, and table or query; kind rows, count, storage, cuts or catalog; init (one script);
    cuts (a file of found cut points); filters."""

    @classmethod
    def name(cls):
        return "rowferry_sqlite"

    def schema(self):
        kind = self.options.get("kind", "rows")
        if kind == "rows":
            raise ValueError("give a schema, or read through read_sqlite, which infers one")
        return {"catalog": CATALOG_SCHEMA, "count": "n long", "cuts": CUTS_SCHEMA}.get(kind, STORAGE_SCHEMA)

    def reader(self, schema):
        return FleetReader(dict(self.options), schema)


class FilePart(InputPartition):
    """A file, or its row ids from ``lower`` to below ``upper`` (None: to the end)."""

    def __init__(self, path: str, lower: int | None = None, upper: int | None = None):
        self.path, self.lower, self.upper = path, lower, upper


class FleetReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.path = options["path"]
        self.table, self.query = options.get("table"), options.get("query")
        self.kind = options.get("kind", "rows")
        self.init = json.loads(options.get("init") or "[]")
        self.suffix = options.get("suffix", "")
        self.split = int(options.get("splitbytes") or SPLIT_BYTES)
        self.fetch = int(options.get("fetchbytes") or FETCH_BYTES)
        self.cuts = options.get("cuts")
        self.schema = schema
        wanted = from_text(options["filters"]) if "filters" in options else []
        self.conditions = [c for c in conditions(wanted, schema) if c is not None]

    def partitions(self):
        """From the folder listing and the found cut points; no SQLite file is opened on the driver."""
        fs, _ = open_path(self.path)
        found, cuts = [], _load_cuts(self.cuts) if self.cuts else {}
        for path, size in _files(self.path, self.suffix):
            if size > self.fetch and not isinstance(fs, pafs.LocalFileSystem):
                raise ValueError(
                    f"{path} has {size} bytes and would be fetched whole into memory; the limit is {self.fetch}. "
                    "Put it on a mounted folder or into several files, or raise fetch_bytes.")
            if self.kind == "cuts":
                if size > self.split:
                    found.append(FilePart(path))
                continue
            found.extend(FilePart(path, *bounds) for bounds in cuts.get(path, [(None, None)]))
        return found

    def read(self, partition: FilePart):
        fs, _ = open_path(self.path)
        db = connect(fs, partition.path)
        try:
            for statement in self.init:
                try:
                    db.executescript(statement)
                except sqlite3.Error as error:
                    raise RuntimeError(f"{partition.path}, the init statement failed:\n{statement}\n{error}") from error
            if self.kind == "catalog":
                yield from self._catalog(db, partition)
            elif self.kind == "cuts":
                yield from self._cuts(db, partition, fs)
            elif self.kind == "count":
                text, args = self._select(db, partition)
                yield db.execute(f"select count(*) from ({text})", args).fetchone()
            elif self.kind == "storage":
                yield from self._storage(db, partition)
            else:
                yield from self._rows(db, partition)
        finally:
            db.close()

    def _select(self, db, partition: FilePart) -> tuple[str, tuple]:
        """The statement for a part of the rows, with its bound values."""
        source = quote(self.table) if self.table else f"({self.query.strip().rstrip(';')})"
        found, args = [], []
        if partition.lower is not None or partition.upper is not None:
            row_id = _row_id(db, self.table)
            for sign, bound in ((">=", partition.lower), ("<", partition.upper)):
                if bound is not None:
                    found.append(f"{row_id} {sign} ?")
                    args.append(bound)
        utf8 = not any(c.order for c in self.conditions) or db.execute("pragma encoding").fetchone() == ("UTF-8",)
        for c in self.conditions:
            if utf8 or not c.order:
                found.append(c.sql)
                args.extend(c.values)
        where = f" where {' and '.join(found)}" if found else ""
        return f"select {self._wanted()} from {source}{where}", tuple(args)

    def _wanted(self) -> str:
        """The columns of the schema, so that others are never read; all, while it is not known."""
        if self.kind == "count":
            return "1"
        if self.kind == "rows" and self.table:
            return ", ".join(quote(f.name) for f in self.schema.fields) or "1"
        return "*"

    def _cuts(self, db, partition, fs):
        """Bounds of parts of equal row counts, so far apart or crowded ids make no part larger.

        One count and one walk over the ids, whatever the number of parts."""
        row_id = _row_id(db, self.table)
        if row_id is None:  # a view or a table without row ids cannot be cut
            return
        table = quote(self.table)
        (count,) = db.execute(f"select count(*) from {table}").fetchone()
        parts = min(count, -(-_size(fs, partition.path) // self.split))
        if parts < 2:
            return
        # the row that starts part p is row number (count * p) // parts, from 0
        starts = db.execute(
            f"select id from (select {row_id} as id, row_number() over (order by {row_id}) - 1 as n from {table}) "
            "where n > 0 and n * ?2 / ?1 <> (n - 1) * ?2 / ?1", (count, parts))
        bounds = [None, *(row[0] for row in starts), None]
        for part, (lower, upper) in enumerate(zip(bounds, bounds[1:])):
            yield (partition.path, part, lower, upper)

    def _rows(self, db, partition):
        text, args = self._select(db, partition)
        db.text_factory = bytes  # cells stay raw; a whole batch is decoded at once
        cursor = db.execute(text, args)
        names = [c[0] for c in cursor.description]
        fields = self.schema.fields
        missing = [f.name for f in fields if f.name not in names]
        if missing:
            raise ValueError(f"{partition.path} has no column {', '.join(missing)}")
        places = [names.index(f.name) for f in fields]
        while rows := cursor.fetchmany(BATCH_ROWS):
            columns = list(zip(*rows))
            arrays = [
                arrow_column(columns[i], f.dataType, partition.path, f.name)
                for i, f in zip(places, fields)
            ]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    def _storage(self, db, partition):
        """Which storage classes occur per column; one row per column and task."""
        text, args = self._select(db, partition)
        names = [c[0] for c in db.execute(f"select * from ({text}) limit 0", args).description]
        kinds = ("integer", "real", "text", "blob")
        wanted = [f"max(typeof({name}) = '{kind}')" for name in map(quote, names) for kind in kinds]
        found = db.execute(f"select {', '.join(wanted)} from ({text})", args).fetchone()
        flags = [[bool(v) for v in found[4 * i:4 * i + 4]] for i in range(len(names))]
        raw = self._undecodable(db, text, args, [n for n, f in zip(names, flags) if f[2] or f[3]])
        for i, name in enumerate(names):
            yield (i, name, *flags[i], name in raw)

    @staticmethod
    def _undecodable(db, text, args, names) -> set[str]:
        """The columns with a text or blob that is not UTF-8; Arrow checks whole batches of cells."""
        bad: set[str] = set()
        if not names:
            return bad
        db.text_factory = bytes
        cells = ", ".join(f"case when typeof({c}) in ('text', 'blob') then {c} end" for c in map(quote, names))
        cursor = db.execute(f"select {cells} from ({text})", args)
        while len(bad) < len(names) and (rows := cursor.fetchmany(BATCH_ROWS)):
            for name, column in zip(names, zip(*rows)):
                if name not in bad and not is_text(pa.array(column, pa.binary())):
                    bad.add(name)
        return bad

    def _catalog(self, db, partition):
        for (table,) in db.execute("select name from sqlite_master").fetchall():
            for place, name, kind, required, default, key in db.execute(
                f"pragma table_info({quote(table)})"
            ):
                yield (partition.path, table, name, kind, required, default, key, place)


def _files(path: str, suffix: str) -> list[tuple[str, int]]:
    return [(name, size) for name, size in list_files(path, suffix) if not name.endswith(COMPANIONS)]


def _size(fs: pafs.FileSystem, path: str) -> int:
    return fs.get_file_info(path).size


def _load_cuts(path: str) -> dict[str, list[tuple]]:
    fs, inside = open_path(path)
    with fs.open_input_file(inside) as stream:
        return json.loads(stream.read())


def _row_id(db, table: str) -> str | None:
    """A name of the row id that no column hides; none for views and tables without row ids."""
    kinds = db.execute("select type, wr from pragma_table_list where lower(name) = lower(?)", (table,)).fetchall()
    if len(kinds) != 1 or tuple(kinds[0]) != ("table", 0):
        return None
    taken = {row[1].lower() for row in db.execute(f"pragma table_xinfo({quote(table)})")}
    return next((name for name in ROW_IDS if name not in taken), None)


def is_text(cells: pa.Array) -> bool:
    """Whether all cells are UTF-8."""
    try:
        cells.cast(pa.string())
    except pa.ArrowInvalid:
        return False
    return True


def connect(fs: pafs.FileSystem, path: str) -> sqlite3.Connection:
    if isinstance(fs, pafs.LocalFileSystem):
        from urllib.parse import quote as url_quote

        return sqlite3.connect(f"file:{url_quote(path)}?mode=ro", uri=True)
    db = sqlite3.connect(":memory:")
    with fs.open_input_file(path) as stream:
        db.deserialize(stream.read())
    return db


def arrow_column(values, dtype: T.DataType, path: str, name: str) -> pa.Array:
    """Cells of any storage class (texts as bytes) as one typed column; what does not fit fails the job."""
    try:
        if isinstance(dtype, T.LongType):
            return pa.array(values, pa.int64())
        if isinstance(dtype, T.DoubleType):
            return pa.array(_plain(values, float, (int, bytes)), pa.float64())
        if isinstance(dtype, T.StringType):
            return pa.array(_plain(values, _numeral, (int, float)), pa.binary()).cast(pa.string())
        if isinstance(dtype, T.BinaryType):
            return pa.array(_plain(values, _numeral, (int, float)), pa.binary())
    except (pa.ArrowInvalid, pa.ArrowTypeError, ValueError, TypeError) as error:
        raise ValueError(f"{path}, column {name}: {error}") from error
    raise TypeError(f"SQLite columns are bigint, double, string or binary, not {dtype}")


def _plain(values, convert, kinds):
    """The values, converted one by one only if the batch holds any of these kinds."""
    if set(map(type, values)).isdisjoint(kinds):
        return values
    return [convert(v) if isinstance(v, kinds) else v for v in values]


def _numeral(value) -> bytes:
    return str(value).encode()


def _reader(spark: SparkSession, path: str, **options):
    spark.dataSource.register(SqliteFleet)
    options = {k: str(v) for k, v in options.items() if v is not None}
    return spark.read.format(SqliteFleet.name()).options(path=qualify(spark, path), **options)


def storage_classes(spark: SparkSession, path: str, table=None, query=None, **rest) -> DataFrame:
    """Per column which storage classes occur in the whole fleet, and the type that fits all.

    Integers only give bigint, with reals double, any text string, blobs string if all are
    valid UTF-8 and binary otherwise. Each task reduces its file to one row per column.
    """
    rest.setdefault("cuts", find_cuts(spark, path, table, **rest))
    per_task = _reader(spark, path, table=table, query=query, kind="storage", **rest).load()
    flags = ("integers", "reals", "texts", "blobs", "undecodable")
    found = per_task.groupBy("column_name").agg(
        F.min("ordinal").alias("ordinal"), *[F.bool_or(f).alias(f) for f in flags]
    )
    kind = (
        F.when(F.col("undecodable"), "binary")
        .when(F.col("texts") | F.col("blobs"), "string")
        .when(F.col("reals"), "double")
        .when(F.col("integers"), "bigint")
        .otherwise("string")
    )
    return found.select("ordinal", "column_name", *flags, kind.alias("spark_type"))


def find_cuts(spark: SparkSession, path: str, table: str | None, splitbytes: int | None = None, suffix: str | None = None,
              **rest) -> str | None:
    """Cut points of the files larger than a part, found by one task a file, kept in a file below the shared folder.

    None where nothing is to be cut. The driver holds a pair of ids per part, as it will hold the parts."""
    whole = qualify(spark, path)
    large = any(size > (splitbytes or SPLIT_BYTES) for _, size in _files(whole, suffix or ""))
    if not table or not large or not isinstance(open_path(whole)[0], pafs.LocalFileSystem):
        return None
    rows = _reader(spark, path, table=table, kind="cuts", splitbytes=splitbytes, suffix=suffix, **rest).load()
    cuts: dict[str, list[tuple]] = {}
    for row in sorted(rows.collect(), key=lambda r: (r.file, r.part)):
        cuts.setdefault(row.file, []).append((row.lower, row.upper))
    if not cuts:
        return None
    target = qualify(spark, scratch_path(spark, "cuts") + ".json")
    fs, inside = open_path(target)
    with fs.open_output_stream(inside, compression=None) as out:
        out.write(json.dumps(cuts).encode())
    return target


def read_sqlite(
    spark: SparkSession,
    path: str,
    table: str | None = None,
    query: str | None = None,
    schema: str | T.StructType | None = None,
    init: list[str] | tuple[str, ...] = (),
    split_bytes: int | None = None,
    suffix: str | None = None,
    columns: list[str] | None = None,
    fetch_bytes: int | None = None,
    filters: list[tuple] = (),
) -> DataFrame:
    """Rows of ``table`` or ``query`` from every file; the schema is inferred unless given.

    Inference is a pass of its own over every cell, so give ``schema`` where it is known. ``columns``
    reads only these of a table. A table larger than ``split_bytes`` is read by several tasks; where to cut is
    found when this is called, by walking the row ids of such files once.

    ``filters`` are (column, operator, value), such as ``("k", ">", 5)``, ``("v", "in", ["a", "b"])`` or ``("v", "is
    null")``; all must hold, with Spark's meaning. They are evaluated inside the files where they can be and by Spark
    otherwise. Cells of rows left out are not checked against the schema.

    A query runs once per file, in one task: an aggregate, ``distinct`` or ``limit`` in it is per file. For
    one answer about all files read ``table`` and use Spark on the result.
    """
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    rest = _rest(init, split_bytes, suffix)
    rest["fetchbytes"] = fetch_bytes
    rest["cuts"] = find_cuts(spark, path, table, **rest)
    if schema is None:
        found = storage_classes(spark, path, table, query, **rest).orderBy("ordinal").collect()
        schema = T.StructType([
            T.StructField(r.column_name, T._parse_datatype_string(r.spark_type)) for r in found
        ])
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    wanted = normalised(filters)
    shown = schema if columns is None else T.StructType([schema[name] for name in columns])
    # a filter that SQLite cannot tell exactly is checked again, so its column is read as well
    inexact = [f for f, c in zip(wanted, conditions(wanted, schema)) if c is None or not c.exact]
    extra = dict.fromkeys(f[0] for f in wanted if f[0] not in shown.names)
    whole = T.StructType([*shown.fields, *[schema[name] for name in extra]])
    rows = _reader(spark, path, table=table, query=query, filters=to_text(wanted) if wanted else None, **rest).schema(whole).load()
    for wanted_again in inexact:
        rows = rows.where(spark_filter(wanted_again))
    return rows.drop(*extra) if extra else rows


def _rest(init, split_bytes, suffix) -> dict:
    return {"splitbytes": split_bytes, "init": json.dumps(list(init)) if init else None, "suffix": suffix}


def count_sqlite(spark: SparkSession, path: str, table: str | None = None, query: str | None = None, init=(),
                 split_bytes: int | None = None, suffix: str | None = None) -> DataFrame:
    """One row ``n``: the rows of all files, counted inside them.

    A file is counted once, in one task; cutting it would need its count first, so ``split_bytes`` changes nothing.
    """
    parts = _reader(spark, path, table=table, query=query, kind="count", **_rest(init, split_bytes, suffix)).load()
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def sqlite_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Columns of all tables of all files."""
    return _reader(spark, path, kind="catalog").load()

"""SQLite file shards: each task fills its own database files with one table."""

from __future__ import annotations

import json
import sqlite3

from pyspark.sql.datasource import DataSource

from rowferry.sinks.shards import ShardWriter

# A shard is built in memory and written once, so its bytes are bounded.
SHARD_BYTES = 256 << 20
STEP_ROWS = 1000


class SqliteFiles(DataSource):
    """Write typed rows; options table, columns and ddl (JSON lists)."""

    @classmethod
    def name(cls):
        return "rowferry_sqlite_files"

    def writer(self, schema, overwrite):
        return SqliteWriter(dict(self.options), overwrite)


def quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class SqliteWriter(ShardWriter):
    extension = ".sqlite"
    step = STEP_ROWS

    def __init__(self, options, overwrite):
        super().__init__(options, overwrite)
        self.max_bytes = int(options.get("maxbytes") or SHARD_BYTES)
        self.table = options.get("table", "data")
        self.columns = json.loads(options["columns"])
        self.ddl = json.loads(options["ddl"])

    def open_shard(self, stream):
        return SqliteShard(self, stream)

    def is_full(self, shard):
        return shard.size() >= self.max_bytes


class SqliteShard:
    def __init__(self, writer: SqliteWriter, stream):
        self.stream = stream
        self.db = sqlite3.connect(":memory:", isolation_level=None)
        names = [quote(c) for c in writer.columns]
        fields = ", ".join(f"{n} {t}" for n, t in zip(names, writer.ddl))
        self.db.execute(f"create table {quote(writer.table)} ({fields})")
        marks = ", ".join("?" for _ in names)
        self.insert = f"insert into {quote(writer.table)} ({', '.join(names)}) values ({marks})"

    def add(self, batch):
        columns = [column.to_pylist() for column in batch.columns]
        self.db.execute("begin")
        self.db.executemany(self.insert, zip(*columns))
        self.db.execute("commit")

    def size(self) -> int:
        (pages,), (page,) = (self.db.execute(f"pragma {name}").fetchone() for name in ("page_count", "page_size"))
        return pages * page

    def close(self):
        self.stream.write(self.db.serialize())
        self.db.close()

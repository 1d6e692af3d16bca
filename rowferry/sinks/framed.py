"""Framed text: ready-made lines between a prefix and a suffix, in every part file."""

from __future__ import annotations

from pyspark.sql.datasource import DataSource

from rowferry.sinks.shards import ShardWriter, text_bytes


class FramedText(DataSource):
    """Write a one-column frame of strings; options prefix, separator, suffix, extension."""

    @classmethod
    def name(cls):
        return "rowferry_framed"

    def writer(self, schema, overwrite):
        return FramedWriter(dict(self.options), overwrite)


class FramedWriter(ShardWriter):
    def __init__(self, options, overwrite):
        super().__init__(options, overwrite)
        self.extension = options.get("extension", ".txt")
        self.prefix = options.get("prefix", "").encode()
        self.separator = options.get("separator", "").encode()
        self.suffix = options.get("suffix", "").encode()

    def open_shard(self, stream):
        return FramedShard(self, stream)


class FramedShard:
    def __init__(self, frame: FramedWriter, stream):
        self.frame, self.stream = frame, stream
        self.empty = True
        stream.write(frame.prefix)

    def add(self, batch):
        if not self.empty:
            self.stream.write(self.frame.separator)
        self.stream.write(text_bytes(batch.column(0), self.frame.separator))
        self.empty = False

    def close(self):
        self.stream.write(self.frame.suffix)

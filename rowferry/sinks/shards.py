"""The part-file writer shared by the framed text, workbook and SQLite sinks.

Spark renders and partitions the rows; a task only packs finished rows into its part files.
Every attempt writes files of its own into the folder; the driver's commit lists those of the successful
attempts in a new manifest (``manifest.py``) and deletes the others, so lost executors, retries and
speculative copies leave nothing behind, and an existing result stays until its replacement is complete.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

from rowferry.sinks import manifest
from rowferry.sinks.files import open_path


@dataclass
class ShardsWritten(WriterCommitMessage):
    files: list[tuple[str, int]] = field(default_factory=list)


class ShardWriter(DataSourceArrowWriter):
    """Subclasses say how one part file is opened; see ``open_shard``."""

    extension = ""
    step = 0  # rows handed to a shard at once, 0 for whole batches

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path = options["path"]
        self.job = options["job"]
        self.max_rows = int(options.get("maxrows") or 0)
        self.overwrite = overwrite

    def open_shard(self, stream):
        """An object with ``add(batch)`` and ``close()`` that writes to ``stream``."""
        raise NotImplementedError

    def is_full(self, shard) -> bool:
        """Whether a shard has reached its bound of bytes, for those built in memory."""
        return False

    def _name(self, partition: int, place: int, attempt: int) -> str:
        return f"part-{partition:010d}-{place:05d}-{self.job}-{attempt}{self.extension}"

    def write(self, iterator):
        context = TaskContext.get()
        partition, attempt = context.partitionId(), context.taskAttemptId()
        fs, root = open_path(self.path)
        fs.create_dir(root, recursive=True)
        done = ShardsWritten()
        shard = stream = None
        rows = 0

        def start():
            nonlocal shard, stream, rows
            name = self._name(partition, len(done.files), attempt)
            done.files.append((name, 0))
            stream = fs.open_output_stream(f"{root}/{name}", compression=None)
            shard, rows = self.open_shard(stream), 0

        def finish():
            nonlocal shard
            shard.close()
            stream.close()
            done.files[-1] = (done.files[-1][0], rows)
            shard = None

        for batch in iterator:
            while batch.num_rows:
                if shard is None:
                    start()
                room = self.max_rows - rows if self.max_rows else batch.num_rows
                head = batch.slice(0, min(room, self.step or room))
                shard.add(head)
                rows += head.num_rows
                batch = batch.slice(head.num_rows)
                if self.max_rows and rows >= self.max_rows or self.is_full(shard):
                    finish()
        # An empty result still gives one file with its header.
        if shard is None and not done.files and partition == 0:
            start()
        if shard is not None:
            finish()
        return done

    def commit(self, messages):
        fs, root = open_path(self.path)
        fs.create_dir(root, recursive=True)
        written = [f for m in messages if m is not None for f in m.files]
        if not written:  # a frame without partitions runs no task
            name = self._name(0, 0, 0)
            with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
                self.open_shard(out).close()
            written = [(name, 0)]
        # The first task's header-only file is needed only when there is nothing else.
        kept = [f for f in written if f[1]] or written[:1]
        manifest.publish(fs, root, self.job, [{"file": name, "rows": rows} for name, rows in kept], self.overwrite)

    def abort(self, messages):
        fs, root = open_path(self.path)
        manifest.withdraw(fs, root, self.job)


def text_bytes(column: pa.Array, separator: bytes) -> pa.Buffer | bytes:
    """All strings of an Arrow column joined by a separator, without a Python loop."""
    import pyarrow.compute as pc

    column = column.cast(pa.large_binary())
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(column)], pa.int64()), column)
    return pc.binary_join(whole, pa.scalar(separator, pa.large_binary()))[0].as_buffer()

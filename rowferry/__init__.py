"""rowferry: ferry query results from databases and Spark tables into files, at Spark scale."""

import sys

from pyspark import cloudpickle

# Executors get the package's classes inside the serialised task, so nothing has to be
# installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from rowferry.engine import Engine  # noqa: E402
from rowferry.sinks.export import ExportReport  # noqa: E402

__all__ = ["Engine", "ExportReport"]

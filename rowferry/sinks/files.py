"""Opening paths from Python tasks and from the driver, on any file system Arrow reaches."""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyarrow import fs as pafs
from pyspark.sql import SparkSession


def qualify(spark: SparkSession, path: str) -> str:
    """The full URI of a path, by the rules of Hadoop's file systems, as Spark's own sources read it.

    A path without a scheme belongs to the default file system, and a mount point to what it leads
    to, so driver, tasks and Spark's sinks all mean the same place. Call it once, on the driver.
    """
    jvm = spark._jvm
    whole = jvm.org.apache.hadoop.fs.Path(path)
    system = whole.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = system.makeQualified(whole)
    # only what exists can be resolved: the nearest folder above that does
    inside, folder = [], whole
    while folder.getParent() is not None and not system.exists(folder):
        inside.insert(0, folder.getName())
        folder = folder.getParent()
    try:
        folder = system.resolvePath(folder)
    except Py4JJavaError:
        return whole.toString()
    return "/".join([folder.toString().rstrip("/"), *inside])


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path inside it for a URI or a plain absolute path."""
    if path.startswith("s3a://"):  # Hadoop's name for the same store
        path = "s3" + path[len("s3a"):]
    if path.startswith("file:") and not path.startswith("file://"):
        path = path[len("file:"):]
    if "://" not in path:
        path = os.path.abspath(path)
    return pafs.FileSystem.from_uri(path)


def list_files(path: str, suffix: str = "") -> list[tuple[str, int]]:
    """Data files below ``path`` with their sizes, sorted by path; or the file itself.

    A folder with a manifest has the files it lists, others all visible ones."""
    from rowferry.sinks import manifest

    fs, root = open_path(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return [(root, info.size)]
    found, listed = [], manifest.load(fs, root)
    if listed is not None:
        names = {f["file"] for f in listed["files"]}
        return sorted((e.path, e.size) for e in fs.get_file_info(pafs.FileSelector(root))
                      if e.base_name in names and e.base_name.endswith(suffix))
    for entry in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
        inside = entry.path[len(root):].strip("/").split("/")
        hidden = any(part.startswith(("_", ".")) for part in inside)
        if entry.type == pafs.FileType.File and not hidden and entry.path.endswith(suffix):
            found.append((entry.path, entry.size))
    return sorted(found)


def result_files(spark: SparkSession, path: str) -> list[str]:
    """The files of an export as paths for Spark's readers, whatever else lies in the folder meanwhile."""
    whole = qualify(spark, path)
    _, root = open_path(whole)
    prefix = whole[: len(whole) - len(root)] if whole.endswith(root) else ""
    return [prefix + name for name, _ in list_files(whole)]

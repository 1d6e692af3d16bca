"""Which files of a folder are its result.

A job writes its files into the folder itself, under names of its own, and then one manifest that lists the result.
The manifest with the highest number that is complete holds, so publishing is the writing of one small file: no
data file is moved, on no kind of store, and whoever reads through the manifest sees the old result or the
new one. Files that no manifest needs any more are deleted after that.
"""

from __future__ import annotations

import json
import re

from pyarrow import fs as pafs

NAME = re.compile(r"_manifest-(\d{10})-(\w+)\.json")


def load(fs: pafs.FileSystem, root: str, entries: list[pafs.FileInfo] | None = None) -> dict | None:
    """The manifest that holds; None for a folder without one.

    One that a lost writer left incomplete does not parse and is passed over."""
    if entries is None:
        entries = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    for name in sorted((e.base_name for e in entries if NAME.fullmatch(e.base_name)), reverse=True):
        with fs.open_input_file(f"{root}/{name}") as stream:
            raw = stream.read()
        try:
            return json.loads(raw)
        except ValueError:
            continue
    return None


def publish(fs: pafs.FileSystem, root: str, job: str, files: list[dict], overwrite: bool) -> dict:
    """Make ``files`` (each file and rows) the result, or for an append part of it; then tidy up.

    Of an append without an earlier manifest, the visible files of other writers are part of the result too."""
    entries = fs.get_file_info(pafs.FileSelector(root))
    before = load(fs, root, entries)
    if overwrite:
        earlier = []
    elif before is not None:
        earlier = before["files"]
    else:
        earlier = [{"file": e.base_name, "rows": None} for e in entries if e.type == pafs.FileType.File
                   and not e.base_name.startswith(("_", ".")) and f"-{job}-" not in e.base_name]
    listed = sorted([*earlier, *files], key=lambda f: f["file"])
    body = {"rows": sum(f["rows"] or 0 for f in listed), "files": listed}
    numbers = [int(found[1]) for e in entries if (found := NAME.fullmatch(e.base_name))]
    name = f"_manifest-{max(numbers, default=0) + 1:010d}-{job}.json"
    with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
        out.write(json.dumps(body).encode())
    # The result is published. What follows may be lost without harm to who reads through the manifest.
    keep = {name, "_SUCCESS", *(f["file"] for f in listed)}
    for entry in entries:
        own = f"-{job}-" in entry.base_name or NAME.fullmatch(entry.base_name)
        if entry.base_name in keep or not (overwrite or own):
            continue
        if entry.type == pafs.FileType.Directory:
            fs.delete_dir(entry.path)
        else:
            fs.delete_file(entry.path)
    with fs.open_output_stream(f"{root}/_SUCCESS", compression=None):
        pass
    return body


def withdraw(fs: pafs.FileSystem, root: str, job: str) -> int:
    """Delete the files of a job that failed before it published; how many there were."""
    entries = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    listed = {f["file"] for f in (load(fs, root, entries) or {"files": ()})["files"]}
    own = [e for e in entries if e.type == pafs.FileType.File and f"-{job}-" in e.base_name]
    if any(e.base_name in listed for e in own):
        return 0
    for entry in own:
        fs.delete_file(entry.path)
    return len(own)

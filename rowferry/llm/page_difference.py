"""Main text of web pages by differencing pages with near URLs.

Pages are put in the order of their hosts and URL paths, and each is paired with the nearest page of its host
whose lines differ. The lines of the two are aligned by longest common subsequence, and the lines they
share are deleted as template.

All blocks of every page are aligned, menus and footers too, and what the mark-up says is evidence beside the alignment:

* furniture that the mark-up declares (menus, headers, footers, sidebars, forms, adverts, notices, comments) goes even if
  the partner has other furniture; scripts and styles are no lines at all;
* a shared line inside a marked article stays, as a passage that two articles quote is no template;
* a line outside every mark stays if it is no template and the mark holds only a teaser, fewer words than such lines together.

Pages that share most of their prose are copies, which say nothing about templates: the next nearest page is the
partner then. Only lines of prose count there, so a long menu over a short text makes no copy.

A line that a page repeats is aligned by its number: the second occurrence with the second one. So a
line is unique in its page and the common subsequence is an increasing one, found in n log n steps
however long the page is.

Pages are spread by ranges of host, path and id, so a host with a third of all pages is spread over many tasks;
where no page before will do, a page is paired with the nearest one after it in its range.

Defined results: null html is an empty page with empty text; a null or odd URL has an empty host of its own; a page alone with
its host loses nothing; repeated rows each get their text; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
from collections import deque
from dataclasses import dataclass, field
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowferry.llm.page_text import ARTICLE, PLAIN, blocks


@dataclass(frozen=True)
class DifferenceSettings:
    """Pages that share more than ``copy_share`` of their words in lines of ``prose_words`` words or more (of the
    smaller one) are copies. A partner is sought among the ``reach`` nearest different pages on either side."""

    copy_share: float = 0.8
    prose_words: int = 8
    reach: int = 4


def _read(batches):
    for batch in batches:
        read = [blocks(h.as_py()) for h in batch.column(3)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([r[0] for r in read], pa.list_(pa.string())),
             pa.array([r[1] for r in read], pa.list_(pa.int8()))],
            names=["page_id", "url", "at", "lines", "parts"])


def shared_lines(a: list[str], b: list[str]) -> set[int]:
    """The places in ``a`` of its longest common subsequence with ``b``."""
    def numbered(lines):
        seen: dict[str, int] = {}
        for line in lines:
            seen[line] = seen.get(line, 0) + 1
            yield line, seen[line]

    places = {key: j for j, key in enumerate(numbered(b))}
    ends: list[int] = []  # the least last place in b of an increasing run of each length
    last: list[int] = []  # where in a that run ends
    before: dict[int, int | None] = {}
    for i, key in enumerate(numbered(a)):
        j = places.get(key)
        if j is None:
            continue
        k = bisect.bisect_left(ends, j)
        before[i] = last[k - 1] if k else None
        if k == len(ends):
            ends.append(j)
            last.append(i)
        else:
            ends[k], last[k] = j, i
    out, i = set(), last[-1] if last else None
    while i is not None:
        out.add(i)
        i = before[i]
    return out


def template(lines: list[str], other: list[str], settings: DifferenceSettings) -> set[int] | None:
    """The places in ``lines`` of what both pages share, None if they are copies."""
    shared = shared_lines(lines, other)

    def prose(some):
        sizes = (len(line.split()) for line in some)
        return sum(size for size in sizes if size >= settings.prose_words)

    copied = prose(lines[i] for i in shared)
    if copied and copied > settings.copy_share * min(prose(lines), prose(other)):
        return None
    return shared


def article(lines: list[str], parts: list[int], shared: set[int]) -> list[str]:
    """The lines that are main text, given the places of the template."""
    own = {i for i, part in enumerate(parts) if part == PLAIN and i not in shared}
    marked = {i for i, part in enumerate(parts) if part == ARTICLE}
    words = lambda places: sum(len(lines[i].split()) for i in places)
    kept = marked if marked and words(own) <= words(marked) else marked | own
    return [line for i, line in enumerate(lines) if i in kept]


@dataclass
class Run:
    """Pages in a row with the same blocks: the blocks once, and the pages that still lack a partner."""

    lines: list[str]
    parts: list[int]
    digest: bytes
    text: str | None = None  # known once there is a partner
    tried: int = 0  # pages after this run that were copies of it
    waiting: list[tuple] = field(default_factory=list)

    def settle(self, shared: set[int]) -> list[tuple]:
        self.text = "\n\n".join(article(self.lines, self.parts, shared))
        out = [(page_id, url, self.text) for page_id, url in self.waiting]
        self.waiting = []
        return out


def _difference(batches, settings: DifferenceSettings):
    """Rows come in the order of host and path. Held: the last ``reach`` runs of a host."""
    def table(rows):
        ids, urls, texts = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"])

    host, runs = None, deque()

    def begin(run: Run) -> list[tuple]:
        """Pair a new run with the runs held, nearest first, and those of them that wait with it."""
        out = []
        for other in reversed(runs):
            if run.text is None and (shared := template(run.lines, other.lines, settings)) is not None:
                run.settle(shared)
            if other.text is None:
                other.tried += 1
                shared = template(other.lines, run.lines, settings)
                if shared is not None or other.tried == settings.reach:
                    out += other.settle(shared or set())
        runs.append(run)
        if len(runs) > settings.reach:
            runs.popleft()
        return out

    def end() -> list[tuple]:
        out = [row for run in runs if run.text is None for row in run.settle(set())]
        runs.clear()
        return out

    for batch in batches:
        out = []
        for page_id, url, at, lines, parts in zip(*(c.to_pylist() for c in batch.columns)):
            written = "\n".join(lines).encode("utf-8", "surrogatepass") + b"\0" + bytes(parts)
            digest = hashlib.sha256(written).digest()
            if host is None or at["host"] != host:
                out += end()
                host = at["host"]
            if not runs or runs[-1].digest != digest:
                out += begin(Run(lines, parts, digest))
            if runs[-1].text is None:
                runs[-1].waiting.append((page_id, url))
            else:
                out.append((page_id, url, runs[-1].text))
        if out:
            yield table(out)
    if rows := end():
        yield table(rows)


def main_text(pages: DataFrame, settings: DifferenceSettings = DifferenceSettings(), page_id="page_id", url="url",
              html="html") -> DataFrame:
    """Per row: page_id, url, text."""
    link = F.coalesce(F.col(url), F.lit(""))
    at = F.struct(
        F.lower(F.regexp_extract(link, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:]*)", 1)).alias("host"),
        F.regexp_extract(link, r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1).alias("path"))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), at.alias("at"),
                        F.col(html).alias("html"))
    # ranges come before reading, so their sampling needs no page; as many as the session's shuffles have
    ordered = rows.repartitionByRange("at.host", "at.path", "page_id").sortWithinPartitions("at.host", "at.path", "page_id")
    read = ordered.mapInArrow(
        _read, "page_id long, url string, at struct<host:string,path:string>, lines array<string>, parts array<byte>")
    return read.mapInArrow(partial(_difference, settings=settings), "page_id long, url string, text string")

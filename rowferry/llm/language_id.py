"""Language by rank-order profiles.

A text's letters, in lower case, are counted as 1- to 3-grams (words apart, their edges marked). The
most frequent grams, in order, are its profile; each language has such a profile from its sample of
labelled texts. The distance of two profiles is the sum of how far each gram of the text stands out
of place, and the language with the least distance is predicted.

The profiles are fitted on about ``rows_per_language`` rows of each language, chosen by a hash of the
id. Scoring reads whole texts.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if no
row has a language; equal distances go to the language first in order; equal counts to the gram with
the lower code; repeated rows are scored alike; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rowferry.llm.common import fold

SPACE = 32
SHIFT = 21  # bits of a code point


@dataclass(frozen=True)
class ProfileSettings:
    grams: int = 300
    rows_per_language: int = 2000


_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once per Python worker."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(gram codes ascending, counts) of a whole text; empty if it has no letter."""
    codes = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    codes = np.where(_letters()[codes], codes, SPACE)
    space = codes == SPACE
    codes = codes[~(space & np.concatenate(([False], space[:-1])))]
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    space = codes == SPACE
    two = codes[:-1] << SHIFT | codes[1:]
    three = (two[:-1] << SHIFT | codes[2:])[~space[1:-1]]
    grams = np.concatenate((codes[~space], two, three))
    grams.sort()
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    return grams[first], np.diff(np.concatenate((first, [len(grams)])))


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent grams, best first."""
    return grams[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """The profiles of all languages as one table of ranks."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.names, self.size = sorted(profiles), size
        self.codes = np.unique(np.array([g for p in profiles.values() for g in p], dtype=np.int64))
        self.ranks = np.full((len(self.codes) + 1, len(self.names)), -1, dtype=np.int64)
        for at, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.codes, profiles[name]), at] = np.arange(len(profiles[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the score is how much nearer the language is than the next one."""
        top = ranked(*gram_counts(text), self.size)
        if not len(top) or not self.names:
            return "und", 0.0
        at = np.searchsorted(self.codes, top)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != top)] = len(self.codes)
        ranks = self.ranks[at]
        away = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(top))[:, None])).sum(axis=0)
        order = np.argsort(away, kind="stable")
        best, second = away[order[0]], away[order[1]] if len(order) > 1 else self.size * len(top)
        return self.names[order[0]], float((second - best) / second) if second else 0.0


def _counted(batches):
    """Gram counts of a task's sample, added up per language before they are shuffled."""
    sums: dict[str, dict[int, int]] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            grams, counts = gram_counts(text)
            own = sums.setdefault(lang, {})
            for g, n in zip(grams.tolist(), counts.tolist()):
                own[g] = own.get(g, 0) + n
    for lang, own in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(own)), pa.array(list(own), pa.int64()), pa.array(list(own.values()), pa.int64())],
            names=["lang", "gram", "n"])


def learn_profiles(docs: DataFrame, settings: ProfileSettings, doc_id="doc_id", text="text", lang="lang") -> Profiles:
    """The driver gets one count per language, then the profiles: languages times ``grams`` rows."""
    rows = docs.where(F.col(lang).isNotNull() & (fold(doc_id) != 0)).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Profiles({}, settings.grams)
    scale = 1 << 30
    limits = F.create_map(*[F.lit(v) for name, n in sorted(sizes.items()) for v in (
        name, min(scale, settings.rows_per_language * scale // n))])
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < limits[F.col("lang")]).select("lang", "text")
    counts = sample.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = counts.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= settings.grams)
    profiles: dict[str, list[tuple[int, int]]] = {}
    for row in top.collect():
        profiles.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
    return Profiles({name: [g for _, g in sorted(p)] for name, p in profiles.items()}, settings.grams)


def predict_languages(docs: DataFrame, profiles: Profiles, doc_id="doc_id", text="text") -> DataFrame:
    """Per row: doc_id, lang_pred, score."""
    def run(batches):
        for batch in batches:
            found = [profiles.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")

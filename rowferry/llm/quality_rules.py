"""Quality rules by cross-document line frequency, in built-in expressions only.

Lines are normalised (trimmed, white space runs to one space, lower case) and hashed. Per host, the
distinct texts that hold a line are counted. A line above the limit is removed, and a document that
loses more than a share of its words is rejected.

Copies of one text count once. Near copies share whole passages, so their lines are frequent without
being boilerplate: a frequent line counts as boilerplate if, before or after it, no single neighbour
stands in more than half of its texts (a text's start and end are neighbours too). What always travels
with its neighbours and has the same surroundings is a copied passage, which is left to near-duplicate
removal. Frequent lines that follow one another in nearly all of their texts are a block, and a block goes
as a whole if any of its lines is boilerplate: all lines of a footer, not only the one next to the body.

Defined results: null text has no words and no lines; a null host is a host of its own; repeated rows
each get the same verdict; an empty table gives an empty result; other columns are ignored, and
carried through by ``apply_quality_rules``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rowferry.llm.common import WORD, bind, free_name, settle, spaced, words_of
from rowferry.llm.components import components

SYMBOLS = r"[^#*$%&|<>]+"


@dataclass(frozen=True)
class LineLimits:
    """A line is frequent when more than ``max_documents`` distinct texts of a host hold it, and more than
    ``max_per_mille`` of a thousand of the host's distinct texts. Two frequent lines are of one block if the second
    follows the first in at least ``block_percent`` percent of the texts of either.

    A document is rejected when more than ``max_removed_share`` of its words go, when it has fewer
    than ``min_words`` words, or when more than ``max_repeat_share`` of its words lie in 5-word
    windows that it repeats.
    """

    max_documents: int = 20
    max_per_mille: int = 1
    block_percent: int = 90
    max_removed_share: float = 0.7
    min_words: int = 10
    max_repeat_percent: int = 20


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(spaced(line), " {2,}", " ")))


def _lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(WORD)))


def _repeat_words(words: Column, width: int = 5) -> Column:
    """How many words lie in windows of ``width`` words that occur twice or more in the text."""

    def covered(windows: Column) -> Column:
        def at(ordered: Column) -> Column:
            again = F.filter(
                ordered,
                lambda x, i: F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)),
            )
            return bind(F.sort_array(F.transform(again, lambda x: x["i"])), lambda starts: F.aggregate(
                F.transform(starts, lambda p, i: F.least(
                    F.lit(width), F.coalesce(F.get(starts, i + 1) - p, F.lit(width)))),
                F.lit(0), lambda total, n: total + n))

        pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            bind(F.sort_array(pairs), at))

    def windows(all_words: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(1), F.size(all_words) - width + 1),
            lambda i: F.xxhash64(F.slice(all_words, i, width)),
        )
        return F.when(F.size(all_words) <= width, F.lit(0)).otherwise(bind(hashes, covered))

    return bind(words, windows)


def measured(docs: DataFrame, doc_id="doc_id", text="text", host="source") -> DataFrame:
    """Per row: the base counts, a key of the text, and its lines as hashes with their words."""
    text = F.col(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"), text.alias("text"),
        words_of(text).alias("words"), F.coalesce(_lines(text), F.array().cast("array<string>")).alias("lines"),
    )
    return rows.select(
        "doc_id", "host", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(F.coalesce("text", F.lit("")), SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.transform(F.transform("lines", normalised), lambda line: F.struct(
            F.xxhash64(line).alias("h"),
            (F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).alias("n"))).alias("lines"),
    )


def frequent_lines(texts: DataFrame, limits: LineLimits) -> DataFrame:
    """(host, h) of the lines to remove. ``texts``: one row per host and distinct text.

    Every count is combined before its shuffle, so a line that a third of all texts hold is a few
    rows per task. Blocks are the connected components among the frequent lines.
    """
    neighbours = F.transform("lines", lambda x, i: F.struct(
        x["h"].alias("h"), i.alias("i"),
        F.coalesce(F.get(F.col("lines"), i - 1)["h"], F.lit(0)).alias("before"),
        F.coalesce(F.get(F.col("lines"), i + 1)["h"], F.lit(0)).alias("after")))
    held = (
        texts.select("host", "text_key", F.explode(neighbours).alias("x"))
        .groupBy("host", "text_key", F.col("x.h").alias("h"))
        .agg(F.min(F.struct("x.i", "x.before", "x.after")).alias("first"))
        .select("host", "text_key", "h", "first.before", "first.after")
    )
    sides = held.select("host", "h", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("before").alias("beside")),
        F.struct(F.lit(1).alias("side"), F.col("after").alias("beside")))).alias("s"))
    hosts = texts.groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
    node = F.concat(F.when(F.col("host").isNull(), "-").otherwise("+"), F.coalesce("host", F.lit("")), F.lit("|"),
                    F.col("h").cast("string"))
    spread = (
        sides.groupBy("host", "h", "s.side", "s.beside").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("host", "h", "side").agg(F.sum("n").alias("n"), F.max(F.struct("n", "beside")).alias("most"))
        .groupBy("host", "h").agg(
            F.max("n").alias("n"), F.min("most.n").alias("most"),
            F.max(F.when(F.col("side") == 1, F.col("most"))).alias("next"))
        .where(F.col("n") > limits.max_documents)
    )
    common = settle(spread.alias("a").join(hosts.alias("b"), F.col("a.host").eqNullSafe(F.col("b.host"))).where(
        1000 * F.col("n") > limits.max_per_mille * F.col("texts")).select(
        "a.host", "h", F.col("n").alias("n_documents"), (F.col("most") * 2 <= F.col("n")).alias("varied"),
        F.col("next.beside").alias("next"), F.col("next.n").alias("together")).withColumn("node", node), "common-lines")
    strong = lambda side: 100 * F.col("a.together") >= limits.block_percent * F.col(f"{side}.n_documents")
    links = settle(common.alias("a").join(
        common.alias("b"), F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.next") == F.col("b.h")))
        .where(strong("a") & strong("b")).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")), "line-links")
    if links.isEmpty():
        return common.where("varied").select("host", "h", "n_documents")
    lines = common.join(components(links), "node", "left").withColumn("block", F.coalesce("label", "node"))
    return lines.join(lines.where("varied").select("block").distinct(), "block", "left_semi").select(
        "host", "h", "n_documents")


def judge(rows: DataFrame, limits: LineLimits) -> tuple[DataFrame, DataFrame]:
    """``rows`` of :func:`measured`, settled. Gives (the frequent lines, words removed per text)."""
    texts = rows.groupBy("host", "text_key").agg(F.any_value("lines").alias("lines"))
    frequent = frequent_lines(texts, limits)
    lines = texts.select("host", "text_key", F.explode("lines").alias("x")).select(
        "host", "text_key", "x.h", "x.n")
    hit = lines.alias("a").join(
        frequent.alias("b"), F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.h") == F.col("b.h")))
    removed = hit.groupBy("a.host", "a.text_key").agg(
        F.sum("n").alias("removed_words"), F.collect_set("a.h").alias("removed_lines"))
    return frequent, removed


def quality_rules(docs: DataFrame, limits: LineLimits = LineLimits(), doc_id="doc_id", text="text",
                  host="source") -> DataFrame:
    """Per row of ``docs``: doc_id, the base counts, the words removed, base_failed and kept."""
    rows = settle(measured(docs, doc_id, text, host), "quality-rows")
    _, removed = judge(rows, limits)
    base_failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    depleted = F.col("n_removed_words") > limits.max_removed_share * F.col("n_words")
    return (
        rows.drop("lines").alias("a").join(
            removed.alias("b"),
            F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.text_key") == F.col("b.text_key")), "left")
        .select("a.doc_id", "a.n_words", "a.word_chars", "a.n_symbols", "a.n_dup_lines", "a.n_repeat_words",
                F.coalesce("b.removed_words", F.lit(0)).cast("long").alias("n_removed_words"))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
    )


def apply_quality_rules(docs: DataFrame, limits: LineLimits = LineLimits(), text="text",
                        host="source", chars: str | None = "n_chars") -> DataFrame:
    """The documents kept, all their columns, without the removed lines.

    Lines are cut out of the original text; the others stay as they are. ``chars`` names a column
    that holds the text's length and is brought up to date, if there is one.
    """
    id_column = F.lit(0).alias("doc_id")
    rows = settle(measured(docs.select(id_column, F.col(text).alias("text"), F.col(host).alias("host")),
                           text="text", host="host"), "quality-rows")
    _, removed = judge(rows, limits)
    texts = rows.groupBy("host", "text_key").agg(
        F.any_value("n_words").alias("n_words"), F.any_value("n_repeat_words").alias("n_repeat_words"))
    verdicts = texts.alias("a").join(
        removed.alias("b"),
        F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.text_key") == F.col("b.text_key")), "left",
    ).select("a.host", "a.text_key", F.col("b.removed_lines").alias("lines"), (
        (F.col("n_words") >= limits.min_words)
        & (100 * F.col("n_repeat_words") <= limits.max_repeat_percent * F.col("n_words"))
        & (F.coalesce("b.removed_words", F.lit(0)) <= limits.max_removed_share * F.col("n_words"))
    ).alias("kept")).where("kept")
    # the verdict comes as one struct under a free name, so its names cannot clash with those of the documents
    own = free_name(docs, "verdict")
    cut = F.col(f"{own}.lines")
    left = F.array_join(F.filter(F.split(text, "\n"), lambda line: F.coalesce(
        ~F.array_contains(cut, F.xxhash64(normalised(line))), F.lit(True))
        | ~F.regexp_like(line, F.lit(WORD))), "\n")
    new_text = F.when(cut.isNull(), F.col(text)).otherwise(left)
    verdicts = verdicts.select(F.struct("host", "text_key", "lines").alias(own))
    kept = docs.join(
        verdicts,
        F.col(host).cast("string").eqNullSafe(F.col(f"{own}.host"))
        & (F.md5(F.coalesce(F.col(text), F.lit(""))) == F.col(f"{own}.text_key")))
    columns = []
    for name in docs.columns:
        if name == text:
            columns.append(new_text.alias(name))
        elif name == chars:
            columns.append(F.when(cut.isNull(), F.col(f"`{name}`")).otherwise(
                F.length(left)).cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(docs[f"`{name}`"])
    return kept.select(*columns)

"""Mixing sources to target weights by temperature, in built-in expressions only.

The token shares q of the sources become weights proportional to q^a. The exponent a is bisected
between 0 (all sources alike) and 1 (as they are): the least a whose weights keep the repetition limit
or come down to the target entropy. The budget gives each source its tokens; a source that needs
more than it has starts over.

Each pass over a source is a permutation of blocks: documents fall into blocks by a hash, the blocks
are ordered by a hash of the pass, so are the parts of a block, and the documents of a part by their
own hash. A partial pass takes documents in that order until the budget is reached. Where it ends is found
in three steps (block sums, then the sums of one block's parts, then one part's documents), so no
task ever holds a source, however large, and a row per source decides about all documents.

Defined results: null text has no tokens; a null source counts as the source with the empty name; sources without any
tokens go in once; repeated rows each go the same way; an empty table gives an empty result; other
columns are ignored, and carried through by ``mixed_documents``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowferry.llm.common import free_name, settle, words_of

STEPS = 30


@dataclass(frozen=True)
class MixTarget:
    """Give ``max_repeats`` or ``entropy_share`` (of the entropy of equal weights).

    ``budget_share`` is the budget as a share of all tokens. None means the least budget that uses
    every document at least once.
    """

    max_repeats: float | None = 2.0
    entropy_share: float | None = None
    budget_share: float | None = 1.0
    seed: int = 0


def _met(totals: DataFrame, target: MixTarget, exponent: float) -> bool:
    power = F.pow("share", F.lit(exponent))
    row = totals.agg(
        F.sum(power).alias("z"), F.max(power / F.col("share")).alias("high"), F.min(power / F.col("share")).alias("low"),
        F.sum(power * F.log(power)).alias("plogp"), F.count(F.lit(1)).alias("n")).first()
    if target.max_repeats is not None:
        repeats = row["high"] / row["low"] if target.budget_share is None else (
            target.budget_share * row["high"] / row["z"])
        return repeats <= target.max_repeats
    import math

    entropy = math.log(row["z"]) - row["plogp"] / row["z"]
    return entropy <= target.entropy_share * math.log(row["n"]) + 1e-12


def find_exponent(totals: DataFrame, target: MixTarget) -> float:
    """``totals``: one row per source with its share. One small job per step; one row comes back."""
    if totals.isEmpty() or _met(totals, target, 0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        if _met(totals, target, middle):
            high = middle
        else:
            low = middle
    return high


def _hash(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws("|", *parts))


def keyed(docs: DataFrame, target: MixTarget, doc_id: str, text: str, source: str) -> tuple[Column, Column, Column]:
    """(source, document hash, tokens) of each row."""
    src = F.coalesce(F.col(source).cast("string"), F.lit(""))
    key = _hash(F.lit(str(target.seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
                F.md5(F.coalesce(F.col(text), F.lit(""))))
    return src, key, F.size(words_of(F.col(text))).cast("long")


def _orders(source: Column, epoch: Column, key: Column) -> tuple[Column, Column]:
    block, part = F.substring(key, 1, 3), F.substring(key, 4, 3)
    epoch = epoch.cast("string")
    return _hash(source, epoch, block), _hash(source, epoch, block, part)


def mix_plan(rows: DataFrame, target: MixTarget) -> DataFrame:
    """Per source: weight, budget, full passes, and the order key at which the last, partial pass ends.

    ``rows``: settled (source, key, tokens).
    """
    sums = settle(rows.groupBy("source").agg(F.sum("tokens").alias("total")).where("total > 0"), "totals")
    tokens = sums.agg(F.sum("total")).first()[0] or 1
    totals = sums.withColumn("share", F.col("total") / F.lit(tokens))
    exponent = find_exponent(totals, target)
    power = F.pow("share", F.lit(exponent))
    z, high = totals.agg(F.coalesce(F.sum(power), F.lit(1.0)), F.coalesce(F.max(F.col("share") / power), F.lit(1.0))).first()
    # with no share given, each source gets at least its own tokens: the budget is the largest need
    budget = tokens * (target.budget_share if target.budget_share is not None else z * high)
    # a hair is added so that a budget meant to be a source's own tokens is not rounded to one less
    planned = totals.select(
        "source", "total", (power / z).alias("weight"), F.floor(budget * power / z + 1e-6).alias("budget"))
    planned = settle(planned.select("*", F.floor(F.col("budget") / F.col("total")).alias("full")).withColumn(
        "rest", F.col("budget") - F.col("full") * F.col("total")), "planned")

    k1, k2 = _orders(F.col("source"), F.col("full"), F.col("key"))
    placed = rows.where("tokens > 0").join(planned.where("rest > 0").select("source", "full", "rest"), "source").select(
        "source", "rest", k1.alias("k1"), k2.alias("k2"), "key", "tokens")

    def edge(sums, order, rest):
        """Where the running sum over ``order`` first goes above ``rest``: one row per source."""
        window = Window.partitionBy("source").orderBy(order)
        return (
            sums.withColumn("upto", F.sum("tokens").over(window)).where(F.col("upto") > F.col(rest))
            .groupBy("source").agg(F.min(F.struct(order, (F.col(rest) - F.col("upto") + F.col("tokens")).alias("left"))).alias("e"))
            .select("source", f"e.{order}", F.col("e.left").alias("left"))
        )

    first = edge(placed.groupBy("source", "k1").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest")), "k1", "rest")
    inside = settle(placed.drop("rest").join(first, ["source", "k1"]), "block")
    second = edge(inside.groupBy("source", "k2").agg(F.sum("tokens").alias("tokens"), F.first("left").alias("room")), "k2", "room")
    part = inside.drop("left").join(second, ["source", "k2"])
    documents = part.groupBy("source", "k1", "k2", "key").agg(F.sum("tokens").alias("tokens"), F.first("left").alias("left"))
    last = documents.withColumn("upto", F.sum("tokens").over(Window.partitionBy("source").orderBy("key"))).groupBy(
        "source", "k1", "k2").agg(F.max(F.when(F.col("upto") <= F.col("left"), F.col("key"))).alias("k3"))
    ends = last.select("source", F.concat("k1", "k2", F.coalesce("k3", F.lit(""))).alias("end"))
    return settle(planned.join(ends, "source", "left").select(
        "source", "total", "weight", "budget", "full", F.coalesce("end", F.lit("")).alias("end")), "mix-plan")


def _passes(full: Column, end: Column, source: Column, key: Column) -> Column:
    """The passes a document goes into: all the full ones, and the partial one if it comes before its end."""
    k1, k2 = _orders(source, full, key)
    taken = (end != "") & (F.concat(k1, k2, key) <= end)
    count = F.when(full.isNull(), F.lit(1)).otherwise(full + taken.cast("long"))
    return F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def mix(docs: DataFrame, target: MixTarget = MixTarget(), doc_id="doc_id", text="text", source="source") -> DataFrame:
    """One row per document and pass: doc_id, source, n_tokens, weight (of the source), epoch, and
    block and position, by which the rows of a pass are ordered."""
    src, key, tokens = keyed(docs, target, doc_id, text, source)
    rows = settle(docs.select(F.col(doc_id).alias("doc_id"), src.alias("source"), key.alias("key"), tokens.alias("tokens")), "mix-rows")
    plan = mix_plan(rows.select("source", "key", "tokens"), target)
    out = rows.join(plan.select("source", "weight", "full", "end"), "source", "left").select(
        "doc_id", "source", "tokens", "weight", "key",
        F.explode(_passes(F.col("full"), F.col("end"), F.col("source"), F.col("key"))).alias("epoch"))
    k1, k2 = _orders(F.col("source"), F.col("epoch"), F.col("key"))
    return out.select(
        "doc_id", "source", F.col("tokens").alias("n_tokens"), F.coalesce("weight", F.lit(0.0)).alias("weight"), "epoch",
        F.substring(k1, 1, 8).alias("block"), F.concat(F.substring(k2, 1, 8), F.substring("key", 1, 16)).alias("position"))


def mixed_documents(docs: DataFrame, target: MixTarget = MixTarget(), doc_id="doc_id", text="text",
                    source="source") -> DataFrame:
    """The documents as often as the mix takes them, all columns."""
    src, key, tokens = keyed(docs, target, doc_id, text, source)
    rows = settle(docs.select(src.alias("source"), key.alias("key"), tokens.alias("tokens")), "mix-rows")
    own = free_name(docs, "plan")
    plan = mix_plan(rows, target).select(F.struct("source", "full", "end").alias(own))
    joined = docs.join(plan, src == F.col(f"{own}.source"), "left")
    passes = _passes(F.col(f"{own}.full"), F.col(f"{own}.end"), src, key)
    return joined.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.explode(passes).alias("pass")).select("row.*")

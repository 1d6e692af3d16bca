"""Secrets: fixed patterns, and a battery of randomness tests, in built-in expressions only.

Base kinds are found by pattern. The battery looks at every other run of 20 or more token characters,
and at its parts of 20 or more between slashes and pluses, between dashes and underscores, and between
all of these, as keys follow paths and names. Shorter ones are not tested. It infers the encoding (the
smallest alphabet that has all characters), and tests the hypothesis that its characters are random: a chi-squared test of uniformity over eight
parts of the alphabet, a runs test about the alphabet's middle, and a lag-one serial correlation.
The chance that the least of three p-values is as small as found is the token's p-value.

Random tokens have p-values spread over 0 to 1, ordinary ones (words, paths, numbers) have them near
0, the nearer the longer they are. So false discoveries are controlled per stratum of encoding and
length (powers of two): the p-values above one half tell how many tokens of the stratum may be random
(twice their number, with one deviation added to its root, as few tokens tell little), and the least
threshold is taken at which the share of tokens above it that these do not explain stays below
``max_false_share``. Short tokens, where the tests tell little apart, thus face a higher threshold. No
token with a p-value below ``least`` is taken; a token alone in its stratum needs no more than that. Of
tokens in letters of one case the bare estimate counts, without the deviation: about half of
joined words of 20 letters and more have p-values above 0.05 (of other ordinary tokens about one in 24 at most), so a
lone token of such letters is not taken.

Defined results: null text counts as empty; repeated rows are judged alike; an empty table gives an
empty result; other columns are ignored, and carried through by ``redact_secrets``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rowferry.llm.common import bind, settle

# The patterns of the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"

TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
PARTS_OF_TOKEN = tuple(f"[A-Za-z0-9{marks}]{{20,}}={{0,2}}" for marks in ("+/", "_-", ""))
KINDS = ("assign", "access", "hex", "random")
PARTS = 8
# Each alphabet with the characters of a token that shows it, smallest first.
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = {
    "hex": (DIGITS + LOWER[:6], "^[0-9a-f]+$"),
    "HEX": (DIGITS + UPPER[:6], "^[0-9A-F]+$"),
    "lower": (LOWER, "^[a-z]+$"),
    "upper": (UPPER, "^[A-Z]+$"),
    "base32": (UPPER + DIGITS[2:8], "^[A-Z2-7]+=*$"),
    "base36": (DIGITS + LOWER, "^[0-9a-z]+$"),
    "BASE36": (DIGITS + UPPER, "^[0-9A-Z]+$"),
    "letters": (UPPER + LOWER, "^[A-Za-z]+$"),
    "base62": (DIGITS + UPPER + LOWER, "^[0-9A-Za-z]+$"),
    "base64": (UPPER + LOWER + DIGITS + "+/", "^[0-9A-Za-z+/]+=*$"),
    "base64url": (UPPER + LOWER + DIGITS + "-_", "^[0-9A-Za-z_-]+=*$"),
}

WORDLIKE = ("lower", "upper")  # joined words look much like random tokens there


@dataclass(frozen=True)
class Battery:
    max_false_share: float = 0.05
    least: float = 0.05
    grid: int = 1000


def _matches(text: Column, pattern: str, kind: int, keep=None, group: int = 0) -> Column:
    """array<struct<start,kind,end,token>> of a pattern's matches, in code points.

    Matches and the gaps between them come from one pattern each; their lengths add up to positions.
    """
    def placed(found: Column) -> Column:
        step = lambda state, x: F.struct(
            (state["at"] + x["gap"] + x["size"]).alias("at"),
            F.concat(state["out"], F.array(F.struct(
                (state["at"] + x["gap"]).alias("start"), F.lit(kind).alias("kind"),
                (state["at"] + x["gap"] + x["size"]).alias("end"), x["token"].alias("token")))).alias("out"))
        empty = F.array().cast("array<struct<start:int,kind:int,end:int,token:string>>")
        return F.aggregate(found, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda s: s["out"])

    gaps = F.split(text, pattern, -1)
    whole, token = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    found = F.transform(F.arrays_zip(gaps.alias("gaps"), whole.alias("whole"), token.alias("token")), lambda x: F.struct(
        F.length(x["gaps"]).alias("gap"), F.length(x["whole"]).alias("size"), x["token"].alias("token")))
    spans = placed(F.filter(found, lambda x: x["size"].isNotNull()))
    return F.filter(spans, keep) if keep is not None else spans


def _none() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int,token:string>>")


def base_spans(text: Column) -> Column:
    """The spans of the base kinds, by start, then kind."""
    assign = F.when(
        F.contains(text, F.lit(":")) | F.contains(text, F.lit("=")),
        _matches(text, ASSIGN, 0, lambda x: F.length(x["token"]) >= 8, group=2)).otherwise(_none())
    access = F.when(
        F.contains(text, F.lit("AKIA")),
        _matches(text, ACCESS, 1, lambda x: x["end"] - x["start"] >= 16)).otherwise(_none())
    hexes = F.when(F.regexp_like(text, F.lit(HEX)), _matches(text, HEX, 2)).otherwise(_none())
    return F.sort_array(F.concat(assign, access, hexes))


def other_tokens(text: Column, base: Column) -> Column:
    """Tokens and their parts that lie in no base span, by start."""
    loose = lambda x: ~F.exists(
        base, lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"]))
    found = F.concat(*[_matches(text, pattern, 3, loose) for pattern in (TOKEN, *PARTS_OF_TOKEN)])
    return F.when(F.regexp_like(text, F.lit(TOKEN)), F.sort_array(F.array_distinct(found))).otherwise(_none())


def encoding(token: Column) -> Column:
    """The place in ALPHABETS of the first that has all the token's characters."""
    chosen = F.lit(None).cast("int")
    for place, (_, shape) in reversed(list(enumerate(ALPHABETS.values()))):
        chosen = F.when(F.regexp_like(token, F.lit(shape)), F.lit(place)).otherwise(chosen)
    return chosen


def _two_sided(z: Column) -> Column:
    """The chance of a normal value at least so far from zero (a rational approximation of erfc)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), poly * F.exp(-x * x))


def _p_value(values: Column, size: Column, shares: Column) -> Column:
    """The combined p-value of alphabet positions under randomness; ``shares``: of the parts."""
    n, df = F.size(values), PARTS - 1
    total = lambda items: F.aggregate(items, F.lit(0.0), lambda a, x: a + x)

    def chi(parts):
        terms = F.transform(shares, lambda share, k: F.pow(
            F.size(F.filter(parts, lambda x: x == k)) - n * share, F.lit(2.0)) / (n * share))
        scaled = F.pow(total(terms) / df, F.lit(1 / 3))
        return (scaled - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))

    def runs(high):
        def z(ones):
            changes = F.size(F.filter(high, lambda x, i: (i > 0) & (x != F.get(high, i - 1))))
            mean = 2.0 * ones * (n - ones) / n + 1
            spread = (mean - 1) * (mean - 2) / (n - 1)
            return F.when(spread > 0, (changes + 1 - mean) / F.sqrt(F.greatest(spread, F.lit(1e-12)))).otherwise(
                F.lit(99.0))

        return bind(F.size(F.filter(high, lambda x: x)), z)

    def serial(centred):
        squares = total(F.transform(centred, lambda x: x * x))
        products = total(F.transform(centred, lambda x, i: x * F.coalesce(F.get(centred, i + 1), F.lit(0.0))))
        return F.when(squares > 0, (products / F.greatest(squares, F.lit(1e-12)) + 1.0 / n) * F.sqrt(n)).otherwise(
            F.lit(99.0))

    scores = F.array(
        bind(F.transform(values, lambda v: F.floor(v * PARTS / size)), chi),
        bind(F.transform(values, lambda v: v * 2 >= size), runs),
        bind(total(values) / n, lambda mean: bind(F.transform(values, lambda v: v - mean), serial)))
    # the first is one-sided: only too uneven counts speak against randomness
    chances = F.transform(scores, lambda z, i: bind(_two_sided(z), lambda p: F.when(i > 0, p).when(
        z > 0, p / 2).otherwise(1 - p / 2)))
    return 1 - F.pow(1 - F.array_min(chances), F.lit(3.0))


def judged(tokens: Column, grid: int) -> Column:
    """Each token with its stratum and the p-value as a step of the grid."""
    letters = [alphabet for alphabet, _ in ALPHABETS.values()]
    shares = [[sum(1 for v in range(len(a)) if v * PARTS // len(a) == part) / len(a) for part in range(PARTS)]
              for a in letters]
    table = F.array(*[F.struct(
        F.lit(a).alias("letters"), F.lit(float(len(a))).alias("size"),
        F.array(*[F.lit(s) for s in share]).alias("shares")) for a, share in zip(letters, shares)])

    def judge(x):
        body = F.regexp_replace(x["token"], "=", "")
        kind = encoding(x["token"])
        p = bind(F.get(table, kind), lambda a: bind(
            F.transform(F.split(body, ""), lambda c: (F.instr(a["letters"], c) - 1).cast("double")),
            lambda values: _p_value(values, a["size"], a["shares"])))
        return F.struct(
            x["start"], x["kind"], x["end"],
            F.concat_ws(":", kind.cast("string"), F.floor(F.log2(F.length(body))).cast("string")).alias("stratum"),
            F.floor(F.coalesce(p, F.lit(0.0)) * grid).cast("int").alias("step"))

    return F.transform(tokens, judge)


def scanned(docs: DataFrame, battery: Battery, doc_id="doc_id", text="text") -> DataFrame:
    """Per row: doc_id, the base spans and the judged tokens; no text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    rows = rows.withColumn("tokens", other_tokens(F.col("text"), F.col("base")))
    return rows.select("doc_id", "base", judged(F.col("tokens"), battery.grid).alias("tokens"))


def thresholds(rows: DataFrame, battery: Battery) -> dict[str, int]:
    """The least accepted step of each stratum: a few hundred at most, as encodings and powers of two are."""
    from pyspark.sql import Window

    steps = (
        rows.select(F.explode("tokens").alias("x")).groupBy("x.stratum", "x.step")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    wordlike = F.split("stratum", ":")[0].isin([str(k) for k, name in enumerate(ALPHABETS) if name in WORDLIKE])
    high = F.sum(F.when(F.col("step") * 2 >= battery.grid, F.col("n")).otherwise(0))
    random = steps.groupBy("stratum").agg(
        F.least(F.sum("n").cast("double"), F.when(F.first(wordlike), 2.0 * high).otherwise(
            2 * F.pow(F.sqrt(high) + 1, F.lit(2.0)))).alias("random"))
    stratum = Window.partitionBy("stratum")  # bounded: a row per step of the grid
    # between one token's step and the next lower one any threshold takes the same tokens: the lowest counts
    least = math.ceil(battery.least * battery.grid)
    above = steps.join(random, "stratum").select(
        "stratum", "random", "step", F.sum("n").over(stratum.orderBy(F.desc("step"))).alias("above"),
        F.greatest(F.lit(least), F.coalesce(F.lag("step").over(stratum.orderBy("step")) + 1, F.lit(0))).alias("limit"))
    false = F.col("above") - F.col("random") * (1 - F.col("limit") / battery.grid)
    return {
        row["stratum"]: row["limit"] for row in above.where(F.col("step") >= least)
        .where(false <= battery.max_false_share * F.col("above") + 1e-9).groupBy("stratum").agg(F.min("limit").alias("limit")).collect()
    }


def accepted(tokens: Column, limits: dict[str, int]) -> Column:
    """The tokens at or above their limits; of a token and its parts the longest."""
    if not limits:
        return F.filter(tokens, lambda x: F.lit(False))
    table = F.create_map(*[F.lit(v) for pair in sorted(limits.items()) for v in pair])
    found = F.filter(tokens, lambda x: F.coalesce(x["step"] >= table[x["stratum"]], F.lit(False)))
    return bind(found, lambda all_found: F.filter(all_found, lambda x: ~F.exists(
        all_found, lambda y: (y["start"] <= x["start"]) & (x["end"] <= y["end"])
        & (y["end"] - y["start"] > x["end"] - x["start"]))))


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"], x["kind"], x["end"]))


def secret_scan(docs: DataFrame, battery: Battery = Battery(), doc_id="doc_id", text="text") -> DataFrame:
    """Per row: doc_id, base and spans, as array<struct<start,kind,end>> sorted by start and kind."""
    rows = settle(scanned(docs, battery, doc_id, text), "secret-rows")
    limits = thresholds(rows, battery)
    return rows.select(
        "doc_id", _plain(F.col("base")).alias("base"),
        F.sort_array(F.concat(_plain(F.col("base")), _plain(accepted(F.col("tokens"), limits)))).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact_secrets(docs: DataFrame, battery: Battery = Battery(), text="text",
                   chars: str | None = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in brackets, all columns.

    Overlapping spans are replaced together, under the kind of the first. ``chars`` names a column
    of text lengths to bring up to date, if there is one. The thresholds come from a first pass that
    keeps the tokens only; the second pass is a projection.
    """
    first = settle(scanned(docs.select(F.lit(0).alias("doc_id"), F.col(text).alias("text")), battery)
                   .where(F.size("tokens") > 0), "secret-rows")
    limits = thresholds(first, battery)
    source, names = F.coalesce(F.col(text), F.lit("")), F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def merged(spans):
        step = lambda out, x: F.when(
            (F.size(out) > 0) & (x["start"] < F.element_at(out, -1)["end"]),
            F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(
                F.element_at(out, -1)["start"].alias("start"), F.element_at(out, -1)["kind"].alias("kind"),
                F.greatest(F.element_at(out, -1)["end"], x["end"]).alias("end"))))
        ).otherwise(F.concat(out, F.array(x)))
        return F.aggregate(spans, F.array().cast("array<struct<start:int,kind:int,end:int>>"), step)

    def cut(spans):
        before = F.transform(spans, lambda x, i: F.concat(
            F.substr(source, F.coalesce(F.get(spans, i - 1)["end"], F.lit(0)) + 1,
                     x["start"] - F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))),
            F.get(names, x["kind"])))
        return F.concat(F.array_join(before, ""), F.substr(source, F.element_at(spans, -1)["end"] + 1))

    base = base_spans(source)
    spans = bind(base, lambda b: F.sort_array(F.concat(
        _plain(b), _plain(accepted(judged(other_tokens(source, b), battery.grid), limits)))))
    new = bind(spans, lambda found: F.when(F.size(found) == 0, F.col(text)).otherwise(bind(merged(found), cut)))
    out = docs.withColumn(text, new)
    if chars in docs.columns:
        size = F.length(F.col(text)).cast(docs.schema[chars].dataType)
        changed = F.coalesce(size, F.col(f"`{chars}`"))
        out = out.withColumn(chars, changed)
    return out.select(*[out[f"`{name}`"] for name in docs.columns])

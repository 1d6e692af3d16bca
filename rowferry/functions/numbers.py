"""Numbers and booleans as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def integer_text(c: Column) -> Column:
    return c.cast("string")


def boolean_text(c: Column) -> Column:
    return c.cast("string")


def float_text(c: Column, single: bool = False) -> Column:
    """Shortest plain notation: no exponent, no trailing ``.0``; ``NaN``, ``inf``, ``-inf``.

    The JVM writes magnitudes from 0.001 to 10 million plainly and the others with an
    exponent, so the branches below go by magnitude. Beyond the exact integers, and below 1e-8, it often prints
    more digits than needed; there the fewest digits that read back the same are taken.
    """
    text, size = c.cast("string"), F.abs(c)
    exact = 2.0**24 if single else 2.0**53
    dot_zero = F.endswith(text, F.lit(".0"))
    plain = F.when(dot_zero, F.substring_index(text, ".", 1)).otherwise(text)
    return (
        F.when(((size >= 1e-3) & (size < 1e7)) | (c == 0), plain)
        .when(F.isnan(c) | (size == float("inf")), F.replace(text, F.lit("Infinity"), F.lit("inf")))
        # a small number of 17 digits may have one too many, as powers of two do
        .when((size >= 1e-8) & (size < exact) & ((size >= 1) | (F.length(text) < 21)), _without_exponent(text, c < 0))
        .when((size >= exact) & (size < 9.2e18), _fewest_digits(c, single))
        # far exponents are rare: bound as one lambda, they add next to no generated code for the others
        .otherwise(_bind(c, lambda v: _far(v, single)))
    )


def _far(c: Column, single: bool) -> Column:
    """Magnitudes below 1e-8 and from 9.2e18 on, and small numbers of many digits."""
    size = F.abs(c)
    digits = F.when((size >= 9.2e18) & (size < 1e37), _fewest_of_exact(c, size, single)).otherwise(
        _fewest_of_text(c.cast("string"), c, single))
    return _bind(digits, lambda scientific: _without_exponent(scientific, c < 0))


def _fewest_digits(c: Column, single: bool) -> Column:
    """A whole number between the exact integers and 9.2e18."""
    whole = c.cast("bigint")
    if single:
        kind = "float"
        rounded = [F.format_string(f"%.{p}E", c).cast("double").cast("bigint") for p in range(5, 9)]
    else:
        # Neighbours are at most 2048 apart, so no more than four digits can be spared.
        kind = "double"
        rounded = []
        for step in (10_000, 1_000, 100, 10):
            middle = whole + step // 2
            rounded.append(middle - F.pmod(middle, F.lit(step)))
    return F.coalesce(*[F.when(r.cast(kind) == c, r) for r in rounded], whole).cast("string")


def _without_exponent(scientific: Column, negative: Column) -> Column:
    """``-d.dddE±n`` written out."""
    mantissa = F.substring_index(scientific, "E", 1)
    exponent = F.substring_index(scientific, "E", -1).cast("int")
    shift = negative.cast("int")
    padded = F.concat(F.translate(mantissa, ".", ""), F.repeat(F.lit("0"), exponent))
    large = F.overlay(padded, F.lit("."), exponent + shift + 2, F.lit(0))
    large = F.rtrim(F.rtrim(large, F.lit("0")), F.lit("."))
    digits = F.rtrim(F.translate(mantissa, "-.", ""), F.lit("0"))
    small = F.concat(F.left(mantissa, shift), F.lit("0."), F.repeat(F.lit("0"), -1 - exponent), digits)
    return F.when(F.contains(scientific, F.lit("E-")), small).otherwise(large)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _rounded(digits: Column, exponent: Column, count: Column) -> Column:
    """The two roundings to ``count`` digits, the nearer first, in scientific notation without a point."""
    below = F.substring(digits, F.lit(1), count).cast("bigint")
    up = (F.substring(digits, count + 1, F.lit(1)) >= "5").cast("bigint")
    # nines may round up to one digit more
    return F.transform(F.array(below + up, below + 1 - up), lambda w: F.concat(
        w.cast("string"), F.lit("E"), (exponent + F.length(w.cast("string")) - count).cast("string")))


def _reads_as(scientific: Column, size: Column, kind: str) -> Column:
    """Whether the notation of ``_rounded`` reads back as the number."""
    digits, exponent = F.substring_index(scientific, "E", 1), F.substring_index(scientific, "E", -1).cast("int")
    return F.concat(digits, F.lit("E"), (exponent - F.length(digits) + 1).cast("string")).cast(kind) == size


def _fewest(digits: Column, exponent: Column, most: Column, size: Column, kind: str) -> Column:
    """The shortest rounding to at most ``most`` digits that reads back the same; null if none does."""
    tried = F.flatten(F.transform(F.sequence(F.lit(1), most), lambda k: _rounded(digits, exponent, k)))
    return F.get(F.filter(tried, lambda t: _reads_as(t, size, kind)), F.lit(0))


def _fewest_of_text(text: Column, c: Column, single: bool) -> Column:
    """From the JVM's own digits, of which some at the end may be too many."""
    kind, size = ("float" if single else "double"), F.abs(c)
    plain = F.ltrim(F.abs(c).cast("double").cast("string") if single else text, F.lit("-"))
    digits = F.rtrim(F.translate(F.substring_index(plain, "E", 1), ".", ""), F.lit("0"))
    exponent = F.substring_index(plain, "E", -1).cast("int")

    def shorter(d: Column) -> Column:
        if single:  # nine digits always tell a float; those of its double are exact enough to round from
            return _fewest(d, exponent, F.least(F.length(d), F.lit(9)), size, kind)
        # most numbers need all their digits: nothing shorter is sought where one digit less reads differently
        one_less = F.exists(_rounded(d, exponent, F.length(d) - 1), lambda t: _reads_as(t, size, kind))
        return F.when((F.length(d) > 1) & one_less, _fewest(d, exponent, F.length(d) - 1, size, kind))

    found = _bind(digits, shorter)
    return F.coalesce(F.concat(F.left(text, (c < 0).cast("int")), found), text)


def _fewest_of_exact(c: Column, size: Column, single: bool) -> Column:
    """From all digits of a whole number below 1e37, put together from parts that are exact."""
    big = size.cast("double")
    high = F.floor(big / 2.0**64)
    rest = big - high.cast("double") * 2.0**64
    middle = F.floor(rest / 2.0**32)
    low = (rest - middle.cast("double") * 2.0**32).cast("bigint")
    whole = (high.cast("decimal(18,0)") * F.lit(str(2**64)).cast("decimal(20,0)")
             + middle.cast("decimal(18,0)") * F.lit(2**32).cast("decimal(10,0)") + low.cast("decimal(18,0)"))
    kind = "float" if single else "double"
    found = _bind(whole.cast("decimal(38,0)").cast("string"), lambda d: _fewest(d, F.length(d) - 1, F.lit(17), size, kind))
    return F.concat(F.when(c < 0, "-").otherwise(""), found)

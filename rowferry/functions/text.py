"""Text: cutting by grapheme cluster, the note about what was cut, display width."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Code point ranges that take two terminal columns (East Asian Wide and
# Fullwidth of the public Unicode annex 11, plus the emoji blocks shown wide).
WIDE = (
    r"\x{1100}-\x{115F}\x{231A}-\x{231B}\x{2329}-\x{232A}\x{23E9}-\x{23EC}\x{23F0}\x{23F3}"
    r"\x{25FD}-\x{25FE}\x{2614}-\x{2615}\x{2648}-\x{2653}\x{267F}\x{2693}\x{26A1}"
    r"\x{26AA}-\x{26AB}\x{26BD}-\x{26BE}\x{26C4}-\x{26C5}\x{26CE}\x{26D4}\x{26EA}"
    r"\x{26F2}-\x{26F3}\x{26F5}\x{26FA}\x{26FD}\x{2705}\x{270A}-\x{270B}\x{2728}\x{274C}"
    r"\x{274E}\x{2753}-\x{2755}\x{2757}\x{2795}-\x{2797}\x{27B0}\x{27BF}\x{2B1B}-\x{2B1C}"
    r"\x{2B50}\x{2B55}\x{2E80}-\x{303E}\x{3041}-\x{33FF}\x{3400}-\x{4DBF}\x{4E00}-\x{A4CF}"
    r"\x{A960}-\x{A97C}\x{AC00}-\x{D7A3}\x{F900}-\x{FAFF}\x{FE10}-\x{FE19}\x{FE30}-\x{FE6B}"
    r"\x{FF01}-\x{FF60}\x{FFE0}-\x{FFE6}\x{1F004}\x{1F0CF}\x{1F18E}\x{1F191}-\x{1F19A}"
    r"\x{1F200}-\x{1F320}\x{1F32D}-\x{1F335}\x{1F337}-\x{1F37C}\x{1F37E}-\x{1F393}"
    r"\x{1F3A0}-\x{1F3CA}\x{1F3CF}-\x{1F3D3}\x{1F3E0}-\x{1F3F0}\x{1F3F4}\x{1F3F8}-\x{1F43E}"
    r"\x{1F440}\x{1F442}-\x{1F4FC}\x{1F4FF}-\x{1F53D}\x{1F54B}-\x{1F54E}\x{1F550}-\x{1F567}"
    r"\x{1F57A}\x{1F595}-\x{1F596}\x{1F5A4}\x{1F5FB}-\x{1F64F}\x{1F680}-\x{1F6C5}\x{1F6CC}"
    r"\x{1F6D0}-\x{1F6D2}\x{1F6EB}-\x{1F6EC}\x{1F6F4}-\x{1F6FC}\x{1F7E0}-\x{1F7EB}"
    r"\x{1F90C}-\x{1F93A}\x{1F93C}-\x{1F945}\x{1F947}-\x{1F9FF}\x{1FA70}-\x{1FAFF}"
    r"\x{20000}-\x{2FFFD}\x{30000}-\x{3FFFD}"
)
# Fixed value: code points that take no terminal column.
ZERO = r"\p{Mn}\p{Me}\p{Cf}\p{Cc}"


def truncate(c: Column, limit: int) -> Column:
    """The first ``limit`` extended grapheme clusters of ``c``."""
    # A text of at most `limit` code points cannot hold more clusters, so it skips the regex.
    # The possessive quantifier keeps Java's matcher iterative, however large the limit.
    cut = F.regexp_extract(c, rf"^\X{{0,{limit}}}+", 0)
    return F.when(F.length(c) <= limit, c).otherwise(cut)


def truncate_with_note(c: Column, limit: int | None) -> Column:
    """``truncate``, and if bytes were cut a note of how many."""
    if limit is None:
        return c
    cut = F.regexp_extract(c, rf"^\X{{0,{limit}}}+", 0)
    trimmed = F.octet_length(c) - F.octet_length(cut)
    noted = F.concat(cut, F.lit(" ...("), trimmed.cast("string"), F.lit(" bytes trimmed)"))
    return F.when(F.length(c) <= limit, c).when(trimmed > 0, noted).otherwise(c)


def display_width(c: Column) -> Column:
    """Terminal columns taken by ``c``: wide characters count two, marks and controls none."""
    odd = F.length(F.regexp_replace(c, f"[^{WIDE}]", "")) - F.length(
        F.regexp_replace(c, f"[^{ZERO}]", "")
    )
    # octet_length = length means plain ASCII; there only control characters are zero wide.
    plain = (F.octet_length(c) == F.length(c)) & ~c.rlike(r"[\x00-\x1f\x7f]")
    return F.when(plain, F.length(c)).otherwise(F.length(c) + odd)


def pad_display(c: Column, width: Column | int) -> Column:
    """``c`` filled with blanks on the right up to ``width`` terminal columns."""
    width = F.lit(width) if isinstance(width, int) else width
    return F.concat(c, F.repeat(F.lit(" "), (width - display_width(c)).cast("int")))

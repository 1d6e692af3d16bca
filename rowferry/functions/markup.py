"""Escaping for HTML pages and spreadsheet XML."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# HTML escapes, ampersand first.
HTML_ESCAPES = (
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&quot;"),
    ("'", "&#x27;"),
)


def html_escape(c: Column) -> Column:
    for char, escape in HTML_ESCAPES:
        c = F.replace(c, F.lit(char), F.lit(escape))
    return c


def html_escape_literal(text: str) -> str:
    for char, escape in HTML_ESCAPES:
        text = text.replace(char, escape)
    return text


# The characters XML 1.0 cannot hold (surrogates do not occur in strings).
NOT_XML = "".join(chr(i) for i in range(0x20) if chr(i) not in "\t\n\r") + "\ufffe\uffff"
NOT_XML_PATTERN = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{FFFE}\x{FFFF}]"


def xml_escape(c: Column) -> Column:
    """Escape for element content; ``NOT_XML`` characters are left for the caller."""
    for char, escape in HTML_ESCAPES[:3]:
        c = F.replace(c, F.lit(char), F.lit(escape))
    # a raw carriage return would be read back as a line feed
    return F.replace(c, F.lit("\r"), F.lit("&#13;"))


def ods_text(c: Column) -> Column:
    """Text of an open document paragraph; it has no way to write ``NOT_XML`` characters."""
    refuse = F.raise_error(F.lit("a spreadsheet cell holds a control character ODS cannot store"))
    return F.when(c.rlike(NOT_XML_PATTERN), refuse).otherwise(xml_escape(c))


def xlsx_text(c: Column) -> Column:
    """Text of an XLSX cell, with the format's own ``_xHHHH_`` for what XML cannot hold."""
    # text that looks like such an escape gets its underscore escaped
    text = F.regexp_replace(xml_escape(c), r"_(?=x[0-9A-Fa-f]{4}_)", "_x005F_")
    led = F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e\x0f]", "_x000$0_")
    led = F.regexp_replace(led, r"[\x10-\x1f]", "_x001$0_")
    led = F.regexp_replace(led, r"[\x{FFFE}\x{FFFF}]", "_xFFF$0_")
    digits = "".join(f"{ord(char):04X}"[-1] for char in NOT_XML)
    return F.when(c.rlike(NOT_XML_PATTERN), F.translate(led, NOT_XML, digits)).otherwise(text)

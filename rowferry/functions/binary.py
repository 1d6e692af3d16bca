"""Binary data as printable text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Bytes written as a backslash and one more character, (text, escape). The
# backslash comes first, as the later escapes bring new ones.
SHORT_ESCAPES = (
    ("\\", "\\\\"),
    ("\t", "\\t"),
    ("\r", "\\r"),
    ("\n", "\\n"),
    ("'", "\\'"),
    ('"', '\\"'),
)


def escape_binary(c: Column) -> Column:
    """Printable ASCII as it is, short escapes, and ``\\xNN`` for every other byte.

    Bytes are handled as the characters of the same number. Where any is left to escape, the
    text is cut into printable and unprintable runs, and only the latter are written in hex.
    """
    text = F.decode(c, "ISO-8859-1")
    for char, escape in SHORT_ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(escape))

    def finish(text: Column) -> Column:
        runs = F.regexp_extract_all(text, F.lit(r"[\x20-\x7e]+|[^\x20-\x7e]+"), F.lit(0))
        escaped = F.transform(runs, lambda run: F.when(run.rlike(r"^[\x20-\x7e]"), run).otherwise(
            F.regexp_replace(F.lower(F.hex(F.encode(run, "ISO-8859-1"))), "..", r"\\x$0")))
        return F.when(text.rlike(r"[^\x20-\x7e]"), F.array_join(escaped, "")).otherwise(text)

    # as the one value of an array the text is made once, however often it is named
    return F.transform(F.array(text), finish)[0]

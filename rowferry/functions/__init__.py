"""Value rendering as Column expressions: everything here runs inside the JVM."""

from rowferry.functions.binary import escape_binary
from rowferry.functions.cells import ods_cell, xlsx_cell
from rowferry.functions.debug import debug_text
from rowferry.functions.markup import html_escape
from rowferry.functions.jsontext import json_object, json_value
from rowferry.functions.numbers import boolean_text, float_text, integer_text
from rowferry.functions.temporal import (
    date_text,
    datetime_text,
    epoch_seconds,
    epoch_text,
    time_text,
    to_second,
)
from rowferry.functions.text import display_width, pad_display, truncate, truncate_with_note
from rowferry.functions.cellvalue import cell_text

__all__ = [
    "boolean_text", "cell_text", "date_text", "datetime_text", "debug_text", "display_width",
    "epoch_seconds", "epoch_text", "escape_binary", "float_text", "html_escape", "integer_text",
    "json_object", "json_value", "ods_cell", "pad_display", "time_text", "to_second",
    "truncate", "truncate_with_note", "xlsx_cell",
]

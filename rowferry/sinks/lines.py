"""Rows as finished text, one string column per frame: what the text-like sinks write."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowferry.functions import cell_text, debug_text, display_width, html_escape, json_object
from rowferry.functions import float_text
from rowferry.functions.cells import LONGEST_TEXT, Choice, choices_of, choose, stage_ods, stage_xlsx
from rowferry.functions.debug import QUOTED_ESCAPES, unified_type
from rowferry.functions.markup import html_escape_literal, ods_text, xlsx_text
from rowferry.sinks.columns import fields_of, sort_columns
from rowferry.sinks.workbook import STYLE_IDS

# The line above each record, the box characters.
RECORD_RULE = "─" * 10
BOX = {"top": "┌┬┐", "middle": "├┼┤", "bottom": "└┴┘", "line": "─", "side": "│"}

# Start and end of a text cell, and the value types of the other ODS cells.
XLSX_TEXT = ('<c t="inlineStr"><is><t xml:space="preserve">', "</t></is></c>")
ODS_TEXT = ('<table:table-cell office:value-type="string"><text:p>', "</text:p></table:table-cell>")
ODS_TYPES = {
    "number": ("float", "value"), "boolean": ("boolean", "boolean-value"),
    "datetime": ("date", "date-value"),
}


def text_rows(df: DataFrame, truncate: int | None = None) -> DataFrame:
    """Every column as text under its own name, null as empty text."""
    return df.select(
        *[cell_text(c, t, truncate).alias(n) for n, c, t in _named(df)]
    )


def _named(df: DataFrame):
    return [(f.name, F.col("`" + f.name.replace("`", "``") + "`"), f.dataType)
            for f in df.schema.fields]


def json_rows(df: DataFrame, truncate=None, compact=False, indent=4) -> DataFrame:
    safe, fields = fields_of(df)
    return safe.select(json_object(fields, truncate, compact, indent).alias("line"))


def html_rows(df: DataFrame, truncate: int | None = None) -> DataFrame:
    safe, fields = fields_of(df)
    cells = [
        F.concat(F.lit("    <td>"), _html_cell(c, t, truncate), F.lit("</td>\n"))
        for _, c, t in fields
    ]
    return safe.select(F.concat(F.lit("<tr>\n"), *cells, F.lit("</tr>\n")).alias("line"))


def _html_cell(c: Column, dtype: T.DataType, truncate: int | None) -> Column:
    text = cell_text(c, dtype, truncate)
    # numbers, booleans and dates hold nothing to escape
    return html_escape(text) if isinstance(dtype, (T.StringType, T.BinaryType)) else text


def html_frame(names: list[str], title: str) -> tuple[str, str]:
    """Start and end of the page around the table rows."""
    head = "".join(f"    <th>{html_escape_literal(n)}</th>\n" for n in names)
    style = "table{border-collapse:collapse}td,th{border:1px solid #ccc;padding:.3em;text-align:left}"
    start = (
        '<!DOCTYPE html>\n<html lang="en">\n<head>\n<meta charset="utf-8">\n'
        f"<title>{html_escape_literal(title)}</title>\n<style>{style}</style>\n</head>\n"
        f"<body>\n<table>\n<thead><tr>\n{head}</tr></thead><tbody>\n"
    )
    return start, "</tbody>\n</table>\n</body>\n</html>\n"


def vertical_rows(df: DataFrame, truncate=None, sorted_columns: bool = False) -> DataFrame:
    safe, fields = fields_of(sort_columns(df) if sorted_columns else df)
    parts = [F.concat(F.lit(f"{n}: "), cell_text(c, t, truncate)) for n, c, t in fields]
    return safe.select(F.concat_ws("\n", F.lit(RECORD_RULE), *parts).alias("line"))


def debug_rows(df: DataFrame) -> DataFrame:
    safe, fields = fields_of(df)
    # the text of a float is named often, so it gets a projection of its own
    floats = {
        f"{name}_text": float_text(F.col(name), single=kind == "float")
        for name, kind in safe.dtypes if kind in ("double", "float")
    }
    safe = safe.withColumns(floats)
    cells = [
        debug_text(c, t, F.col(f"c{i}_text") if f"c{i}_text" in floats else None)
        for i, (_, c, t) in enumerate(fields)
    ]
    return safe.select(F.concat(F.lit(""), *cells).alias("line"))


def quoted_name(name: str) -> str:
    for char, escape in QUOTED_ESCAPES:
        name = name.replace(char, escape)
    return name


def debug_header(df: DataFrame) -> str:
    described = "".join(
        f'ColumnInfo {{ name: "{quoted_name(f.name)}", data_type: {unified_type(f.dataType)} }}'
        for f in df.schema.fields
    )
    return f"#prepare_for_results\n#columns\n{described}\n"


# --- text table -----------------------------------------------------------------------------


def _cell_lines(text: Column) -> Column:
    """Lines of one cell; a final line break opens no new line."""
    body = F.regexp_replace(text, r"\r?\n\z", "")
    return F.split(body, r"\r?\n")


def _multi_line(text: Column) -> Column:
    return F.contains(text, F.lit("\n"))


class TableLayout(NamedTuple):
    """What the first pass finds: widths, and whether any cell has line breaks."""

    widths: list[int]
    multi_line: bool


def _staged_texts(df: DataFrame, truncate: int | None) -> tuple[DataFrame, list[tuple[Column, bool]]]:
    """A projection of cell texts; each column with whether it can hold more than plain ASCII."""
    safe, fields = fields_of(df)
    safe = safe.select(*[cell_text(c, t, truncate).alias(f"c{i}") for i, (_, c, t) in enumerate(fields)])
    return safe, [(c, isinstance(t, T.StringType)) for _, c, t in fields]


def table_layout(df: DataFrame, truncate: int | None = None) -> TableLayout:
    """Widest display width per column, header included: one aggregate row.

    Only a result whose cells have line breaks needs a second look, line by line.
    """
    safe, texts = _staged_texts(df, truncate)
    if not texts:
        return TableLayout([], False)
    broken = F.lit(False)
    for text, free in texts:
        broken = broken | _multi_line(text) if free else broken
    widest = [F.max(display_width(t) if free else F.length(t)) for t, free in texts]
    *found, multi_line = safe.agg(*widest, F.bool_or(broken)).first()
    if multi_line:
        lines = [
            F.array_max(F.transform(_cell_lines(t), display_width)) if free else F.length(t)
            for t, free in texts
        ]
        found = safe.agg(*[F.max(width) for width in lines]).first()
    names = df.sparkSession.range(1).select(
        *[F.array_max(F.transform(_cell_lines(F.lit(n)), display_width)) for n in df.columns]
    )
    return TableLayout([max(a or 0, b or 0) for a, b in zip(found, names.first())], bool(multi_line))


def table_rows(df: DataFrame, layout: TableLayout, truncate: int | None = None) -> DataFrame:
    """One string per row: its cells padded between box sides, one text line per cell line."""
    safe, texts = _staged_texts(df, truncate)
    side = F.lit(BOX["side"])

    def text_line(cells: list[Column]) -> Column:
        parts = [side]
        for cell, (_, free), width in zip(cells, texts, layout.widths):
            # the rows may come from a source that has changed since the layout was found
            size = display_width(cell) if free else F.length(cell)
            wide = F.raise_error(F.lit(f"a cell is wider than its column of {width}: the result has changed "
                                       "since its layout was found"))
            blanks = F.when(size > width, wide).otherwise(F.repeat(F.lit(" "), (F.lit(width) - size).cast("int")))
            parts += [cell, blanks, side]
        return F.concat(*parts)

    line = text_line([t for t, _ in texts])
    if layout.multi_line:
        broken = F.lit(False)
        for text, free in texts:
            broken = broken | _multi_line(text) if free else broken
        parts = [_cell_lines(t) for t, _ in texts]
        height = F.array_max(F.array(*[F.size(p) for p in parts]))
        lines = F.transform(
            F.sequence(F.lit(0), height - 1),
            lambda i: text_line([F.coalesce(F.get(p, i), F.lit("")) for p in parts]),
        )
        line = F.when(broken, F.array_join(lines, "\n")).otherwise(line)
    return safe.select(line.alias("line"))


def table_rule(kind: str, widths: list[int]) -> str:
    left, cross, right = BOX[kind]
    return left + cross.join(BOX["line"] * w for w in widths) + right


def table_header(df: DataFrame, layout: TableLayout) -> str:
    names = df.sparkSession.range(1).select(*[F.lit(n) for n in df.columns]).toDF(*df.columns)
    multi_line = any("\n" in n for n in df.columns)
    return table_rows(names, TableLayout(layout.widths, multi_line)).first()[0]


# --- spreadsheet rows -----------------------------------------------------------------------


def _sheet_rows(df: DataFrame, stage, write, empty: str, row: tuple[str, str]) -> DataFrame:
    # Values are staged in a projection of their own: a cell's XML names its value often.
    safe, fields = fields_of(df)
    staged = [stage(c, t) for _, c, t in fields]
    safe = safe.select(*[s.value.alias(f"c{i}") for i, s in enumerate(staged)])
    cells = [
        choose(c, choices_of(c, s.dtype, s.kind), write, F.lit(empty))
        for (_, c, _), s in zip(fields, staged)
    ]
    return safe.select(F.concat(F.lit(row[0]), *cells, F.lit(row[1])).alias("line"))


def xlsx_rows(df: DataFrame, truncate: int | None = None) -> DataFrame:
    stage = lambda c, t: stage_xlsx(c, t, truncate)
    return _sheet_rows(df, stage, _xlsx_xml, "".join(XLSX_TEXT), ("<row>", "</row>"))


def _xlsx_xml(choice: Choice) -> Column:
    if choice.kind != "text":
        style = STYLE_IDS.get(choice.kind)
        start = '<c t="b"><v>' if choice.kind == "boolean" else f'<c s="{style}"><v>' if style else "<c><v>"
        value = choice.number.cast("int").cast("string") if choice.kind == "boolean" else choice.text
        return F.concat(F.lit(start), value, F.lit("</v></c>"))
    if choice.digits:
        return F.concat(F.lit(XLSX_TEXT[0]), choice.text, F.lit(XLSX_TEXT[1]))
    body = xlsx_text(choice.text)
    too_long = F.raise_error(F.lit(f"a spreadsheet cell holds more than {LONGEST_TEXT} characters"))
    body = F.when(F.length(choice.text) > LONGEST_TEXT, too_long).otherwise(body)
    return F.concat(F.lit(XLSX_TEXT[0]), body, F.lit(XLSX_TEXT[1]))


def ods_rows(df: DataFrame, truncate: int | None = None) -> DataFrame:
    stage = lambda c, t: stage_ods(c, t, truncate)
    row = ("<table:table-row>", "</table:table-row>")
    return _sheet_rows(df, stage, _ods_xml, "".join(ODS_TEXT), row)


def _ods_xml(choice: Choice) -> Column:
    if choice.kind != "text":
        value_type, attribute = ODS_TYPES[choice.kind]
        start = f'<table:table-cell office:value-type="{value_type}" office:{attribute}="'
        return F.concat(F.lit(start), choice.text, F.lit('"/>'))
    if choice.digits:
        return F.concat(F.lit(ODS_TEXT[0]), choice.text, F.lit(ODS_TEXT[1]))
    # a paragraph collapses blanks and line breaks, so they are written as elements
    body = F.regexp_replace(ods_text(choice.text), r"^ |(?<= ) | $", "<text:s/>")
    body = F.replace(body, F.lit("\t"), F.lit("<text:tab/>"))
    body = F.replace(body, F.lit("\n"), F.lit("</text:p><text:p>"))
    return F.concat(F.lit(ODS_TEXT[0]), body, F.lit(ODS_TEXT[1]))

"""Rendering functions over whole tables."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F, types as T

from rowferry import functions as R
from rowferry.plans.tables import load
from rowferry.sinks.columns import fields_of, sort_columns
from rowferry.sinks.lines import debug_rows, json_rows, vertical_rows

DOUBLE, STRING, NTZ = T.DoubleType(), T.StringType(), T.TimestampNTZType()


def fn_truncate(spark, sf):
    docs = load(spark, sf, "documents")
    return docs.select("doc_id", R.truncate(F.col("text"), 20).alias("head"))


def fn_truncate_note(spark, sf):
    docs = load(spark, sf, "documents")
    return docs.select("doc_id", R.truncate_with_note(F.col("text"), 50).alias("noted"))


def fn_truncate_note_pages(spark, sf):
    pages = load(spark, sf, "pages")
    return pages.select("page_id", R.truncate_with_note(F.col("html"), 200).alias("noted"))


def fn_escape_binary(spark, sf):
    turns = load(spark, sf, "conversations").select("conv_id", "turn", "text")
    items = load(spark, sf, "benchmark").select(
        F.col("item_id").alias("conv_id"), F.lit(-1).cast("bigint").alias("turn"), "text"
    )
    raw = F.encode("text", "UTF-8")
    return turns.unionByName(items).select("conv_id", "turn", R.escape_binary(raw).alias("escaped"))


def fn_escape_binary_documents(spark, sf):
    raw = F.encode("text", "UTF-8")
    return load(spark, sf, "documents").select("doc_id", R.escape_binary(raw).alias("escaped"))


def fn_number_text(spark, sf):
    items = load(spark, sf, "lineitem")
    price = F.col("l_extendedprice")
    return items.select(
        R.integer_text(F.col("l_orderkey")).alias("order_text"),
        R.integer_text(F.col("l_linenumber")).alias("line_text"),
        R.float_text(F.col("l_quantity")).alias("quantity_text"),
        R.float_text(price).alias("price_text"),
        R.float_text(price * (1 - F.col("l_discount"))).alias("net_text"),
        R.float_text(price * 1000000.0).alias("micros_text"),
        R.float_text(F.col("l_discount").cast("float").cast("double")).alias("widened_text"),
        R.float_text(F.col("l_discount").cast("float"), single=True).alias("single_text"),
    )


def fn_null_bool_text(spark, sf):
    docs, labels = load(spark, sf, "documents").select("doc_id"), load(spark, sf, "labels")
    toxic = R.boolean_text(F.col("toxic") == 1)
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        F.coalesce(R.integer_text(F.col("quality")), F.lit("")).alias("quality_text"),
        F.coalesce(toxic, F.lit("")).alias("toxic_text"),
    )


def fn_epoch_text(spark, sf):
    zoned = F.timestamp_seconds(R.epoch_seconds(F.col("ts")))
    return load(spark, sf, "events").select("event_id", R.epoch_text(zoned).alias("epoch"))


def fn_datetime_text(spark, sf):
    ts = F.col("ts")
    return load(spark, sf, "events").select(
        "event_id",
        R.date_text(F.to_date(ts)).alias("date_text"),
        R.datetime_text(ts).alias("datetime_text"),
        R.datetime_text(R.to_second(ts)).alias("second_text"),
    )


@contextmanager
def times_of_day(spark):
    """The type for times of day, switched on while a plan that has it is analysed."""
    name = "spark.sql.timeType.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fn_time_text(spark, sf):
    with times_of_day(spark):
        clock = F.make_time(F.hour("ts"), F.minute("ts"), F.extract(F.lit("SECOND"), "ts"))
        return load(spark, sf, "events").select(
            "event_id",
            R.time_text(clock).alias("time_text"),
            F.time_trunc(F.lit("SECOND"), clock).cast("string").alias("truncated"),
        )


def fn_html_escape(spark, sf):
    return load(spark, sf, "pages").select(
        "page_id", R.html_escape(F.col("url")).alias("url"),
        R.html_escape(F.col("html")).alias("html"),
    )


def fn_json_compact(spark, sf):
    return json_rows(load(spark, sf, "events"), compact=True)


def fn_json_pretty(spark, sf):
    return json_rows(load(spark, sf, "customer"), indent=4)


def fn_json_documents(spark, sf):
    return json_rows(load(spark, sf, "documents"), compact=True)


def fn_debug_text(spark, sf):
    return debug_rows(load(spark, sf, "orders"))


def _cells(render, df, key):
    safe, fields = fields_of(df)
    return (
        safe.select(F.col("c0").alias(key), *[
            render(c, t).alias(n) for n, c, t in fields[1:]
        ])
        .select(key, *[
            F.col(f"{n}.{part}").alias(f"{n}_{part}")
            for n, _, _ in fields[1:] for part in ("kind", "num", "text")
        ])
    )


def fn_cells_xlsx(spark, sf):
    orders = load(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate",
        F.to_date("o_orderdate").alias("o_day"),
    )
    return _cells(R.xlsx_cell, orders, "o_orderkey")


def fn_cells_ods(spark, sf):
    events = load(spark, sf, "events").select(
        "event_id", "value", "props", "ts", F.to_date("ts").alias("day"),
        (F.col("value") > 0).alias("positive"),
    )
    return _cells(R.ods_cell, events, "event_id")


def fn_sorted_columns(spark, sf):
    suppliers = load(spark, sf, "supplier")
    ordered = sort_columns(suppliers)
    assert ordered.columns == sorted(suppliers.columns)
    return vertical_rows(suppliers, sorted_columns=True)


QUERIES = {
    f.__name__: f
    for f in (
        fn_truncate, fn_truncate_note, fn_truncate_note_pages, fn_escape_binary,
        fn_escape_binary_documents, fn_number_text, fn_null_bool_text, fn_epoch_text,
        fn_datetime_text, fn_time_text, fn_html_escape, fn_json_compact, fn_json_pretty,
        fn_json_documents, fn_debug_text, fn_cells_xlsx, fn_cells_ods, fn_sorted_columns,
    )
}


def number_sql(value: str) -> str:
    """A double in plain notation without a trailing ``.0``."""
    return rf"regexp_replace(cast({value} as varchar), '\.0$', '')"


def noted_sql(value: str, limit: int) -> str:
    head = f"left_grapheme({value}, {limit})"
    return (
        f"case when strlen({head}) < strlen({value}) then {head} || ' ...(' || "
        f"(strlen({value}) - strlen({head})) || ' bytes trimmed)' else {value} end"
    )


def html_sql(value: str) -> str:
    for char, escape in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"),
                         ("''", "&#x27;")):
        value = f"replace({value}, '{char}', '{escape}')"
    return value


ESCAPED_SQL = r"""
array_to_string(list_transform(regexp_extract_all(hex(encode(text)), '..'),
  lambda h: case h when '09' then '\t' when '0A' then '\n' when '0D' then '\r'
                   when '22' then '\"' when '27' then '\''' when '5C' then '\\'
            else case when h >= '20' and h < '7F' then chr(cast('0x' || h as integer))
                      else '\x' || lower(h) end end), '')
"""

CUSTOMER_JSON = (
    ("c_custkey", "c_custkey"), ("c_name", "to_json(c_name)"), ("c_nationkey", "c_nationkey"),
    ("c_acctbal", number_sql("c_acctbal")), ("c_mktsegment", "to_json(c_mktsegment)"),
)
EVENT_JSON = (
    ("event_id", "event_id"), ("ts", "'\"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '\"'"),
    ("user_id", "user_id"), ("event_type", "to_json(event_type)"), ("value", number_sql("value")),
    ("props", "to_json(props)"),
)
DOCUMENT_JSON = (
    ("doc_id", "doc_id"), ("text", "to_json(text)"),
    ("lang", "to_json(lang)"), ("source", "to_json(source)"), ("n_chars", "n_chars"),
)


def json_sql(fields, compact: bool = True) -> str:
    lead, colon = ("", ":") if compact else ("    ", ": ")
    between = " || ',' || " if compact else " || ',' || chr(10) || "
    body = between.join(f"'{lead}\"{name}\"{colon}' || {value}" for name, value in fields)
    if compact:
        return "'{' || " + body + " || '}'"
    return "'{' || chr(10) || " + body + " || chr(10) || '}'"


SERIAL = "epoch(date_trunc('second', o_orderdate))::bigint / 86400.0::double + 25569"

ORACLES = {
    "fn_truncate": "select doc_id, left_grapheme(text, 20) as head from documents",
    "fn_truncate_note": f"select doc_id, {noted_sql('text', 50)} as noted from documents",
    "fn_truncate_note_pages": f"select page_id, {noted_sql('html', 200)} as noted from pages",
    "fn_escape_binary": f"""
        select conv_id, turn, {ESCAPED_SQL} as escaped from (
          select conv_id, turn, text from conversations
          union all select item_id, -1, text from benchmark)""",
    "fn_escape_binary_documents": f"select doc_id, {ESCAPED_SQL} as escaped from documents",
    "fn_number_text": f"""
        select cast(l_orderkey as varchar) as order_text,
               cast(l_linenumber as varchar) as line_text,
               {number_sql('l_quantity')} as quantity_text,
               {number_sql('l_extendedprice')} as price_text,
               {number_sql('l_extendedprice * (1 - l_discount)')} as net_text,
               {number_sql('l_extendedprice * 1000000.0::double')} as micros_text,
               {number_sql('l_discount::float::double')} as widened_text,
               {number_sql('l_discount::float')} as single_text
        from lineitem""",
    "fn_null_bool_text": """
        select doc_id, coalesce(cast(quality as varchar), '') as quality_text,
               coalesce(cast(toxic = 1 as varchar), '') as toxic_text
        from documents left join labels using (doc_id)""",
    "fn_epoch_text": """
        select event_id, cast(epoch(date_trunc('second', ts))::bigint as varchar) as epoch
        from events""",
    "fn_datetime_text": """
        select event_id, strftime(ts, '%Y-%m-%d') as date_text,
               strftime(ts, '%Y-%m-%d %H:%M:%S') as datetime_text,
               strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as second_text
        from events""",
    "fn_time_text": """
        select event_id, strftime(ts, '%H:%M:%S') as time_text,
               strftime(ts, '%H:%M:%S') as truncated from events""",
    "fn_html_escape": f"""
        select page_id, {html_sql('url')} as url, {html_sql('html')} as html from pages""",
    "fn_json_compact": f"select {json_sql(EVENT_JSON)} as line from events",
    "fn_json_pretty": f"select {json_sql(CUSTOMER_JSON, compact=False)} as line from customer",
    "fn_json_documents": f"select {json_sql(DOCUMENT_JSON)} as line from documents",
    "fn_debug_text": """
        select 'I64(' || o_orderkey || ')I64(' || o_custkey || ')String("' || o_orderstatus
               || '")F64(' || cast(o_totalprice as varchar) || ')DateTime('
               || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || ')String("' || o_orderpriority
               || '")' as line from orders""",
    "fn_cells_xlsx": f"""
        select o_orderkey, 'number' as o_totalprice_kind, o_totalprice as o_totalprice_num,
               null::varchar as o_totalprice_text, 'text' as o_orderstatus_kind,
               null::double as o_orderstatus_num, o_orderstatus as o_orderstatus_text,
               'datetime' as o_orderdate_kind, {SERIAL} as o_orderdate_num,
               null::varchar as o_orderdate_text, 'date' as o_day_kind,
               date_diff('day', date '1899-12-30', o_orderdate::date)::double as o_day_num,
               null::varchar as o_day_text
        from orders""",
    "fn_cells_ods": """
        select event_id, 'number' as value_kind, value as value_num, null::varchar as value_text,
               'text' as props_kind, null::double as props_num, props as props_text,
               'datetime' as ts_kind, null::double as ts_num,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') as ts_text, 'datetime' as day_kind,
               null::double as day_num, strftime(ts, '%Y-%m-%dT00:00:00') as day_text,
               'boolean' as positive_kind, case when value > 0 then 1.0 else 0.0 end::double
               as positive_num, null::varchar as positive_text
        from events""",
    "fn_sorted_columns": f"""
        select '──────────' || chr(10) || 's_acctbal: ' || {number_sql('s_acctbal')} || chr(10)
               || 's_name: ' || s_name || chr(10) || 's_nationkey: ' || s_nationkey || chr(10)
               || 's_suppkey: ' || s_suppkey as line from supplier""",
}

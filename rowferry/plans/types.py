"""Type normalisation over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowferry.operators.normalise import (
    describe,
    normalise,
    table_columns,
    text_if_utf8,
    to_parquet_columns,
    to_signed,
    utf8_text,
)
from rowferry.plans.tables import load


def typ_mysql(spark, sf):
    """Integers to 64 bit, single floats widened, datetimes without fraction."""
    events = load(spark, sf, "events").select(
        F.col("event_id").cast("decimal(20,0)").alias("event_id"),
        F.col("user_id").cast("int").alias("user_id"),
        F.col("value").cast("float").alias("value"), "ts", "event_type",
    )
    rows = normalise(events, "mysql")
    assert [t for _, t in rows.dtypes] == [
        "decimal(20,0)", "bigint", "double", "timestamp_ntz", "string"]
    return rows.withColumn("event_id", F.col("event_id").cast("bigint"))


def typ_postgres(spark, sf):
    """Widths are kept."""
    items = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.col("l_tax").cast("float").alias("l_tax"), "l_returnflag", "l_shipdate",
    )
    rows = normalise(items, "postgres")
    assert [t for _, t in rows.dtypes] == [
        "bigint", "int", "double", "float", "string", "timestamp_ntz"]
    # shown as double, so that both engines compare the same digits
    return rows.withColumn("l_tax", F.col("l_tax").cast("double"))


def typ_utf8(spark, sf):
    """Per cell: text where the bytes are valid, null where not."""
    raw = F.encode("text", "UTF-8")
    broken = F.when(F.col("lang") == "de", F.concat(F.unhex(F.lit("FF")), raw)).otherwise(raw)
    return load(spark, sf, "documents").select("doc_id", utf8_text(broken).alias("text"))


def typ_utf8_column(spark, sf):
    """Per column: one invalid value keeps the whole column binary."""
    raw = F.encode("text", "UTF-8")
    last = F.concat(raw, F.when(F.col("role") == "user", F.unhex(F.lit("C3"))).otherwise(F.lit(b"")))
    turns = load(spark, sf, "conversations").select(
        "conv_id", "turn", raw.alias("good"), last.alias("bad"))
    rows = text_if_utf8(turns, ["good", "bad"])
    assert dict(rows.dtypes)["bad"] == "binary" and dict(rows.dtypes)["good"] == "string"
    return rows.select("conv_id", "turn", "good", F.hex("bad").alias("bad"))


def typ_unsigned_bool(spark, sf):
    labels = load(spark, sf, "labels")
    unsigned = (F.col("doc_id").cast("decimal(20,0)") * 90000000000).cast("decimal(20,0)")
    flags = labels.select(
        "doc_id", to_signed(unsigned).alias("signed"), (F.col("toxic") == 1).alias("toxic"))
    return table_columns(flags)


def typ_table_columns(spark, sf):
    """Columns as the SQLite sink takes them."""
    events = load(spark, sf, "events").select(
        "event_id", F.col("user_id").cast("int").alias("user_id"), "ts",
        F.col("value").cast("decimal(18,4)").alias("value"), "props",
    )
    return table_columns(events, temporal_text=True)


def typ_parquet_columns(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text", F.lit(None).alias("note"))
    return to_parquet_columns(docs)


def src_describe(spark, sf):
    """Columns of a result with the row count of the pre-pass."""
    items = load(spark, sf, "lineitem")
    n = items.agg(F.count(F.lit(1)).alias("n_rows"))
    return describe(items).withColumn("n_rows", n.scalar())


QUERIES = {
    f.__name__: f
    for f in (
        typ_mysql, typ_postgres, typ_utf8, typ_utf8_column, typ_unsigned_bool,
        typ_table_columns, typ_parquet_columns, src_describe,
    )
}

ORACLES = {
    "typ_mysql": """
        select event_id, user_id, value::float::double as value,
               date_trunc('second', ts) as ts, event_type from events""",
    "typ_postgres": """
        select l_orderkey, l_linenumber, l_quantity, l_tax::float::double as l_tax, l_returnflag,
               date_trunc('second', l_shipdate) as l_shipdate from lineitem""",
    "typ_utf8": """
        select doc_id, case when lang = 'de' then null else text end as text from documents""",
    "typ_utf8_column": """
        select conv_id, turn, text as good,
               hex(encode(text)) || case when role = 'user' then 'C3' else '' end as bad
        from conversations""",
    "typ_unsigned_bool": """
        select doc_id, doc_id * 90000000000 as signed,
               case when toxic = 1 then 1 else 0 end as toxic from labels""",
    "typ_table_columns": f"""
        select event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts,
               cast(cast(value as decimal(18,4)) as varchar) as value,
               props from events""",
    "typ_parquet_columns": f"""
        select doc_id, text, null::varchar as note from documents""",
    "src_describe": """
        with types(ordinal, name, unified_type, sql_type) as (values
          (1, 'l_orderkey', 'I64', 'integer'), (2, 'l_partkey', 'I64', 'integer'),
          (3, 'l_suppkey', 'I64', 'integer'), (4, 'l_linenumber', 'I32', 'integer'),
          (5, 'l_quantity', 'F64', 'float'), (6, 'l_extendedprice', 'F64', 'float'),
          (7, 'l_discount', 'F64', 'float'), (8, 'l_tax', 'F64', 'float'),
          (9, 'l_returnflag', 'String', 'text'), (10, 'l_linestatus', 'String', 'text'),
          (11, 'l_shipdate', 'DateTime', 'datetime'))
        select ordinal, name, unified_type, sql_type, true as nullable,
               (select count(*) from lineitem) as n_rows from types""",
}

"""Rendering functions against hand-written edge rows and plain Python."""

import datetime
import random
import struct
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from rowferry import functions as R
from rowferry.functions.debug import debug_text


def column(spark, values, kind, expression):
    schema = f"i int, v {kind}"
    df = spark.createDataFrame(list(enumerate(values)), schema)
    rows = df.select("i", expression(F.col("v")).alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: r.i)]


FAMILY = "\U0001F468\u200D\U0001F469\u200D\U0001F467"
FLAGS = "\U0001F1EB\U0001F1F7\U0001F1E9\U0001F1EA"


def test_truncate(spark):
    texts = ["", None, "abc", "abcd", "e\u0301e\u0301e\u0301e\u0301", FAMILY * 4, FLAGS, "a\r\nbc", "a\nbc"]
    cut = column(spark, texts, "string", lambda c: R.truncate(c, 3))
    assert cut == ["", None, "abc", "abc", "e\u0301e\u0301e\u0301", FAMILY * 3, FLAGS, "a\r\nb", "a\nb"]
    assert column(spark, ["abc", ""], "string", lambda c: R.truncate(c, 0)) == ["", ""]


def test_truncate_is_iterative(spark):
    """Clusters of changing length must not deepen the matcher's stack."""
    text = "ae\u0301" * 200_000
    (cut,) = column(spark, [text], "string", lambda c: R.truncate(c, 300_000))
    assert cut == "ae\u0301" * 150_000


def test_truncate_with_note(spark):
    texts = ["", None, "ab", "abc", "äöüß", FAMILY + "xy"]
    noted = column(spark, texts, "string", lambda c: R.truncate_with_note(c, 2))
    assert noted == ["", None, "ab", "ab ...(1 bytes trimmed)", "äö ...(4 bytes trimmed)",
                     FAMILY + "x ...(1 bytes trimmed)"]
    assert column(spark, texts, "string", lambda c: R.truncate_with_note(c, None)) == texts


def escaped(data: bytes) -> str:
    short = {9: "\\t", 10: "\\n", 13: "\\r", 34: '\\"', 39: "\\'", 92: "\\\\"}
    return "".join(short.get(b) or (chr(b) if 32 <= b < 127 else f"\\x{b:02x}") for b in data)


def test_escape_binary(spark):
    values = [b"a\x00b\t", b"", None, bytes(range(256)), b"\xff\x00", "é%20+ %".encode(),
              b"100% plain + more", b"\\x41%41\x01"]
    found = column(spark, values, "binary", R.escape_binary)
    assert found[0] == "a\\x00b\\t"
    assert found == [None if v is None else escaped(v) for v in values]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=60))
def test_escape_binary_any(spark, values):
    assert column(spark, values, "binary", R.escape_binary) == [escaped(v) for v in values]


def plain(value: float) -> str:
    if value != value:
        return "NaN"
    if abs(value) == float("inf"):
        return "inf" if value > 0 else "-inf"
    text = format(Decimal(repr(value)), "f")
    return text.rstrip("0").rstrip(".") if "." in text else text


def test_float_text(spark):
    rng = random.Random(5)
    values = [1.0, -0.0, 0.0, 0.1, 1e16, 1.5e-7, 123456.789, 1e300, -1e300, float("nan"),
              float("inf"), float("-inf"), 1e7, 9999999.0, 0.001, 0.00099, 2.0**53, 2.0**63, 1e22,
              1e23, 1.2345678e-5, -3.5e-9, 12345678.125, 1e38, -1e37]
    for _ in range(20000):
        values.append(rng.uniform(-1, 1) * 10 ** rng.randint(-7, 37))
        values.append(round(rng.uniform(0, 1e9), rng.randint(0, 6)))
        values.append(float(rng.randint(0, 2**63)))
    found = column(spark, values, "double", R.float_text)
    assert [(v, f, plain(v)) for v, f in zip(values, found) if f != plain(v)] == []


def test_float_text_random_bits(spark):
    rng = random.Random(6)
    values = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(20000)]
    # the ends of the range: subnormals, powers of two and of ten, whole numbers beyond 64 bits
    values += [sign * 2.0**k for k in [*range(-1074, -20), *range(60, 1024)] for sign in (1, -1)]
    values += [5e-324 * k for k in range(1, 500)] + [float(f"{m}e{e}") for m in (1, 9, 35) for e in [*range(-320, -9), *range(19, 300)]]
    values += [rng.uniform(9.2e18, 1e27) for _ in range(5000)]
    found = column(spark, values, "double", R.float_text)
    assert [(v, f) for v, f in zip(values, found) if f != plain(v)] == []


def test_single_float_text(spark):
    import numpy as np

    rng = random.Random(7)
    values = [0.1, 1.0, 16777216.0, 3.4e38, 1e-10] + [
        rng.uniform(-1, 1) * 10 ** rng.randint(-6, 30) for _ in range(5000)]
    singles = [np.float32(v) for v in values]
    found = column(spark, [float(s) for s in singles], "float", lambda c: R.float_text(c, True))
    expected = [np.format_float_positional(s, unique=True, trim="-") for s in singles]
    wrong = [(e, f) for e, f in zip(expected, found) if e != f]
    assert all(np.float32(e) == np.float32(f) for e, f in wrong) and len(wrong) < 20, wrong[:5]


def test_temporal_ignores_session_zone(spark):
    """A clock time that does not exist in the session's zone is still itself."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:11.987654' as c")
        row = df.select(
            R.datetime_text(F.col("c")).alias("text"), R.epoch_seconds(F.col("c")).alias("epoch"),
            R.to_second(F.col("c")).cast("string").alias("second"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    utc = datetime.datetime(2024, 3, 10, 2, 30, 11, tzinfo=datetime.timezone.utc)
    assert row == ("2024-03-10 02:30:11", int(utc.timestamp()), "2024-03-10 02:30:11")


def test_before_epoch(spark):
    df = spark.sql("select timestamp_ntz'1969-12-31 23:59:58.5' as c")
    assert df.select(R.epoch_seconds(F.col("c"))).first()[0] == -2


ALL_TYPES = """
select cast(18446744073709551615 as decimal(20,0)) as u64, 5L as i64, 6 as i32, 7S as i16,
       8Y as i8, 1.0D as f64, cast(0.1 as float) as f32, 'it''s "x"\n' as s, X'00ff41' as b,
       true as flag, date'2020-02-29' as d, timestamp_ntz'2020-02-29 10:11:12.5' as dt,
       time'10:11:12' as tm, timestamp_seconds(1000) as ts, cast(1.50 as decimal(18,4)) as dec,
       null as nothing
"""


def test_cell_text_all_types(spark):
    df = spark.sql(ALL_TYPES)
    row = df.select(*[R.cell_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema]).first()
    assert list(row) == ["18446744073709551615", "5", "6", "7", "8", "1", "0.1", 'it\'s "x"\n',
                         "\\x00\\xffA", "true", "2020-02-29", "2020-02-29 10:11:12", "10:11:12",
                         "1000", "1.5000", ""]
    nulls = df.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
    row = nulls.select(*[R.cell_text(F.col(f.name), f.dataType) for f in nulls.schema]).first()
    assert set(row) == {""}


def test_debug_text_all_types(spark):
    df = spark.sql(ALL_TYPES).drop("dec")
    row = df.select(*[debug_text(F.col(f.name), f.dataType) for f in df.schema]).first()
    assert list(row) == [
        "U64(18446744073709551615)", "I64(5)", "I32(6)", "I16(7)", "I8(8)", "F64(1.0)", "F32(0.1)",
        'String("it\'s \\"x\\"\\n")', "Bytes([0, 255, 65])", "Bool(true)", "Date(2020-02-29)",
        "DateTime(2020-02-29T10:11:12.5)", "Time(10:11:12)", "Timestamp(1000)", "None"]


def test_debug_text_odd_values(spark):
    texts = ["a\x00\x1b\u200b", "\u0301a\u0301", "é", "a\\b"]
    found = column(spark, texts, "string", lambda c: debug_text(c, T.StringType()))
    assert found == ['String("a\\0\\u{1b}\\u{200b}")', 'String("\\u{301}a\u0301")', 'String("é")',
                     'String("a\\\\b")']
    floats = [1.0, 0.1, 1e16, 1.5e-7, 1.5e300, 1e15, 12345.678, -2e-6, -0.0]
    found = column(spark, floats, "double", lambda c: debug_text(c, T.DoubleType()))
    assert found == [f"F64({x})" for x in (
        "1.0", "0.1", "1e16", "1.5e-7", "1.5e300", "1000000000000000.0", "12345.678", "-2e-6", "-0.0")]


def test_html_escape(spark):
    found = column(spark, ["<b>&\"'", "", None], "string", R.html_escape)
    assert found == ["&lt;b&gt;&amp;&quot;&#x27;", "", None]


def test_json_values(spark):
    import json

    df = spark.sql(ALL_TYPES + " union all " + ALL_TYPES.replace("1.0D", "double('NaN')"))
    df = df.drop("nothing")
    fields = [(f.name, F.col(f.name), f.dataType) for f in df.schema]
    for compact in (True, False):
        first, second = [json.loads(r[0]) for r in df.select(R.json_object(fields, None, compact)).collect()]
        assert first["u64"] == 18446744073709551615 and first["f64"] == 1 and first["s"] == 'it\'s "x"\n'
        assert first["b"] == "\\x00\\xffA" and first["flag"] is True and first["ts"] == 1000
        assert second["f64"] is None and first["d"] == "2020-02-29" and first["dec"] == 1.5
    with pytest.raises(ValueError, match="distinct column names"):
        R.json_object([fields[0], fields[0]])


def test_cells(spark):
    df = spark.sql("select 9007199254740993L as big, 5L as small, double('Infinity') as inf, "
                   "date'1970-01-02' as d, time'12:00:00' as tm, timestamp_seconds(86400) as ts, "
                   "true as flag, cast(null as int) as n")
    x = df.select(*[R.xlsx_cell(F.col(f.name), f.dataType).alias(f.name) for f in df.schema]).first()
    assert [tuple(c) for c in x] == [
        ("text", None, "9007199254740993"), ("number", 5.0, None), ("text", None, "inf"),
        ("date", 25570.0, None), ("time", 0.5, None), ("datetime", 25570.0, None),
        ("boolean", 1.0, None), ("text", None, "")]
    o = df.select(*[R.ods_cell(F.col(f.name), f.dataType).alias(f.name) for f in df.schema]).first()
    assert [tuple(c) for c in o][3:6] == [
        ("datetime", None, "1970-01-02T00:00:00"), ("text", None, "12:00:00"),
        ("datetime", None, "1970-01-02T00:00:00")]


def test_display_width(spark):
    texts = ["", "abc", "日本", "e\u0301", "a\u200b", "한글x", "é"]
    assert column(spark, texts, "string", R.display_width) == [0, 3, 4, 1, 1, 5, 1]
    assert column(spark, ["日"], "string", lambda c: R.pad_display(c, 4)) == ["日  "]


def test_unsupported_type(spark):
    with pytest.raises(TypeError, match="unsupported column type"):
        R.cell_text(F.col("x"), T.ArrayType(T.IntegerType()))

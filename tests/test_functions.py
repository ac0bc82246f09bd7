"""Column expressions against their plain Python meaning."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeflow import presets
from gaugeflow.functions import arrays, bytes as packed, clock, labels, numbers, text

# --- fixed values: sample text of the patterns ---
INPUT = """Name: Alice
Email: alice@gmail.com
Phone: 9876543210

Name: Bob
Email: bob@yahoo.com
Phone: 9123456780

Name: Charlie
Email: charlie@hotmail.com
Phone: 9988776655
"""


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def many(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_regex(spark):
    body = F.lit(INPUT)
    assert one(spark, text.find_all(body, presets.EMAIL_PATTERN)) == ["alice@gmail.com", "bob@yahoo.com", "charlie@hotmail.com"]
    assert one(spark, text.find_all(body, presets.PHONE_PATTERN)) == ["9876543210", "9123456780", "9988776655"]
    assert one(spark, text.find_all(body, presets.NAME_PATTERN, 1)) == ["Alice", "Bob", "Charlie"]
    assert one(spark, text.find_all(F.lit("Name: Zoë!"), presets.NAME_PATTERN, 1)) == ["Zoë"]
    assert one(spark, text.find_all(F.lit("123456789012345678901234"), presets.PHONE_PATTERN)) == ["1234567890", "1234567890"]
    assert one(spark, text.replace_all(body, "gmail.com", "university.edu")) == INPUT.replace("gmail.com", "university.edu")
    assert one(spark, text.replace_all(F.lit("gmailXcom"), "gmail.com", "u")) == "u"
    assert one(spark, text.tokens(F.lit("Ab, cd--AB 12 "))) == ["ab", "cd", "ab"]
    assert one(spark, text.tokens(F.lit("Été d'hier, Größe"))) == ["été", "d", "hier", "größe"]


def test_locale_double(spark):
    got = many(spark, ["2,6", "13", " 0,5 ", "", "n/a", None, "NaN", "1,2,3"], "string", numbers.locale_double)
    assert got == [2.6, 13.0, 0.5, None, None, None, None, None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6) | st.floats(-9e15, 9e15), min_size=200, max_size=200), st.integers(0, 4))
def test_rounding_matches_python(spark, values, digits):
    values += [2.675, 0.125, 0.375, 30.95, -0.5, 1.5, 2.5, 1e300, 0.0, -2.675, 1e-9, 123456789.125]
    values += [15000000000000.123, 31234567890123.456, 15000000000000.134765625, 2251799813685248.5, 4503599627370495.5, 99999999999999.99]
    assert many(spark, values, "double", lambda c: numbers.round_half_even(c, digits)) == [round(v, digits) for v in values]
    shown = [v for v in values if abs(v) < 2**63]
    got = many(spark, shown, "double", lambda c: numbers.fixed_text(c, digits, "even"))
    assert [g.lstrip("-") for g in got] == [f"{v:.{digits}f}".lstrip("-") for v in shown]


def test_browser_numbers(spark):
    assert many(spark, [0.125, 30.95, 2.5, None, -1.005], "double", lambda c: numbers.fixed_text(c, 2)) == ["0.13", "30.95", "2.50", None, "-1.00"]
    assert many(spark, [2.5, -2.5, 0.49], "double", numbers.round_half_up_integer) == [3, -2, 0]
    assert many(spark, [9.994, 9.996, 10.0, 10.5, None], "double", numbers.display_value) == ["9.99", "10.00", "10", "11", "N/A"]
    assert one(spark, numbers.percent_text(F.lit(0.9031))) == "90.3%"
    assert many(spark, ["abc", "abcdef"], "string", lambda c: numbers.padded(c, 5)) == ["abc  ", "abcdef"]


def test_clamp_keeps_null(spark):
    assert many(spark, [-1.0, 0.5, 7.0, None], "double", lambda c: numbers.clamp(c, 0, 1)) == [0.0, 0.5, 1.0, None]


def test_bucket_edges(spark):
    left = many(spark, [19.9, 20.0, 40.0, None], "double", lambda c: labels.bucket_label(c, [20, 40], ["a", "b", "c"]))
    right = many(spark, [20.0, 20.1, 40.1], "double", lambda c: labels.bucket_label(c, [20, 40], ["a", "b", "c"], "right"))
    assert left == ["a", "b", "c", None] and right == ["a", "b", "c"]
    with pytest.raises(ValueError):
        labels.bucket_label(F.lit(1), [1], ["a"])


def test_lookup(spark):
    assert many(spark, [0, 3, 9, None], "int", lambda c: labels.lookup(c, presets.CLUSTER_NAMES, "?")) == ["Clean", "Severe", "?", "?"]


def test_bytes(spark):
    values = [0, 1, 255, 256, 4294967295]
    raw = many(spark, values, "long", packed.uint32_to_bytes)
    assert [bytes(r) for r in raw] == [v.to_bytes(4, "little") for v in values]
    assert many(spark, raw, "binary", packed.bytes_to_uint32) == values
    for bad in (-1, 4294967296):
        with pytest.raises(Exception, match="32-bit"):
            many(spark, [bad], "long", packed.uint32_to_bytes)
    with pytest.raises(Exception, match="4-byte"):
        many(spark, [b"abc"], "binary", packed.bytes_to_uint32)


def test_arrays(spark):
    base = arrays.array_of([1, 2, 3, 4, 5])
    assert one(spark, arrays.add_scalar(base, 5)) == [6, 7, 8, 9, 10]
    assert one(spark, arrays.multiply_scalar(base, 2)) == [2, 4, 6, 8, 10]
    assert one(spark, arrays.reshape(arrays.number_range(0, 6), 2, 3)) == [[0, 1, 2], [3, 4, 5]]
    assert one(spark, arrays.number_range(0, 0)) == []
    assert one(spark, arrays.matrix_of([[1, 2, 3], [4, 5, 6]])) == [[1, 2, 3], [4, 5, 6]]
    tens = arrays.array_of([10, 20, 30, 40])
    assert (one(spark, arrays.array_sum(tens)), one(spark, arrays.array_mean(tens))) == (100.0, 25.0)
    assert (one(spark, F.array_max(tens)), one(spark, F.array_min(tens))) == (40, 10)
    with pytest.raises(Exception, match="reshape"):
        one(spark, arrays.reshape(base, 2, 3))


def test_clock(spark):
    assert many(spark, ["18.00.00", "07.30.00", "x", None], "string", clock.hour_from_prefix) == [18, 7, None, None]
    assert many(spark, ["18.00.00", "7.30", "nan", None], "string", lambda c: clock.hour_from_parts(c, default=0)) == [18, 7, 0, 0]
    assert many(spark, ["2024-01-05T18:30", "bad"], "string", clock.hour_from_iso) == [18, None]
    hours = list(range(24))
    flags = {name: [h for h, f in zip(hours, many(spark, hours, "int", lambda c, r=r: clock.rush_flag(c, r))) if f] for name, r in
             {"a": presets.RUSH_PIPELINE, "b": presets.RUSH_SERVICE}.items()}
    assert flags == {"a": [7, 8, 9, 17, 18, 19], "b": [8, 9, 10, 17, 18, 19]}
    assert many(spark, [None], "int", lambda c: clock.rush_flag(c, presets.RUSH_PANEL)) == [0]
    stamp = one(spark, clock.parse_timestamp(F.lit("10/03/2004"), F.lit("18.00.00")).cast("string"))
    assert stamp == "2004-03-10 18:00:00" and one(spark, clock.parse_timestamp(F.lit("x"), F.lit("y"))) is None

import base64

import pytest
from pyspark.sql import functions as F

from entitylake.functions.tokens import decode_token, encode_token, literal_for
from entitylake.plans.read import high_water_mark, since_window


def b64(text):
    return base64.urlsafe_b64encode(text.encode()).decode()


def test_tokens_are_url_safe_base64_of_a_literal():
    for literal, value in (("1", "1"), ("-9223372036854775808", "-9223372036854775808"), ("'2031-12-31T23:59:59.000001Z'", "2031-12-31T23:59:59.000001Z"), ("'~?>ü'", "~?>ü")):
        assert encode_token(literal) == b64(literal) and decode_token(b64(literal)) == value
    assert decode_token("") is None
    assert literal_for(12) == "12" and literal_for("abc") == "'abc'"


def test_bad_token_is_an_error():
    with pytest.raises(ValueError):
        decode_token("%%%")
    with pytest.raises(ValueError):
        decode_token(encode_token("abc"))  # neither integer nor quoted


def test_int_since_column_tokens(spark):
    df = spark.createDataFrame([(880000000000000001, "a"), (None, "n")], "since bigint, v string")
    first = since_window(df, "since")
    assert first.token == b64("880000000000000001")
    assert [r.v for r in first.rows.collect()] == ["a"]  # NULL since never matches the cap
    df2 = df.union(spark.createDataFrame([(880000000000000002, "b")], df.schema))
    nxt = since_window(df2, "since", first.token)
    assert nxt.token == b64("880000000000000002")
    assert [r.v for r in nxt.rows.collect()] == ["b"]
    same = since_window(df2, "since", nxt.token)  # nothing new: same token, no rows
    assert same.token == nxt.token and same.rows.count() == 0


def test_string_since_column_tokens(spark):
    df = spark.createDataFrame([("2019-03-05T07:08:09-05:00",)], "since string")
    w = since_window(df, "since")
    assert w.token == b64("'2019-03-05T07:08:09-05:00'")
    df2 = df.union(spark.createDataFrame([("2019-03-05T07:08:10-05:00",)], df.schema))
    w2 = since_window(df2, "since", w.token)
    assert w2.token == b64("'2019-03-05T07:08:10-05:00'") and w2.rows.count() == 1


def test_timestamp_tokens_keep_microseconds(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 10:00:00.123456' as ts union all select timestamp_ntz'2024-01-01 10:00:00.123457'")
    w = since_window(df.where(F.col("ts") < F.lit("2024-01-01 10:00:00.123457").cast("timestamp_ntz")), "ts")
    assert decode_token(w.token) == "2024-01-01T10:00:00.123456"
    w2 = since_window(df, "ts", w.token)  # the last fraction is not held back
    assert w2.rows.count() == 1


def test_empty_table_without_token(spark):
    df = spark.createDataFrame([], "since bigint")
    w = since_window(df, "since")
    assert w.token == "" and w.rows.count() == 0
    hw = high_water_mark(df, "since").first()
    assert hw.token is None

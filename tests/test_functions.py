"""Scalar functions: SCA1-18, PRJ2, PRJ3, PRJ7, FLT1, FLT2, CLS1."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from eventmill.functions import cursors, responses, text, timestamps, variants


def one(spark, column):
    return spark.sql("SELECT 1").select(column.alias("out")).first()["out"]


def variant(spark, json_text, column):
    df = spark.sql("SELECT 1").select(F.parse_json(F.lit(json_text)).alias("v"))
    return df.select(column.alias("out")).first()["out"]


TIMES = [
    ("1706745600000", 1706745600000),
    ("1706745600", 1706745600000),
    ('"2024-02-01T00:00:00.000Z"', 1706745600000),
    ('"2024-02-01T12:00:00"', 1706788800000),
    ("null", None),
    ('"not-a-date"', None),
    ("1000000000001", 1000000000001),
    ("999999999999", 999999999999000),
    ("1000000000000", 1000000000000000),
    ("-5", -5000),
    ("0", 0),
    ("1706745600.7", 1706745600700),
    ("true", None),
    ('{"a":1}', None),
    ("[1]", None),
    ('"1706745600000"', None),
    ('"12:30"', None),
    ('""', None),
    ('"2024"', 1704067200000),
    ('"2024-02"', 1706745600000),
    ('"2024-02-01"', 1706745600000),
    ('"2024-02-01T12:00"', 1706788800000),
    ('"2024-02-01T12:00Z"', 1706788800000),
    ('"2024-02-01T12:00+02:00"', 1706781600000),
    ('"2024-02-01 12:00:00"', 1706788800000),
    ('"2024-02-01T12:00:00+0530"', 1706769000000),
    ('"2024-02-01T12:00:00-01:00"', 1706792400000),
    ('"2024-02-01T00:00:00.123987Z"', 1706745600123),
    ('"2024-13-01T00:00:00Z"', None),
    ('"2024/02/01"', 1706745600000),
    ('"02/01/2024"', 1706745600000),
    ('"Feb 1 2024"', 1706745600000),
    ('"Feb 1, 2024"', 1706745600000),
    ('"1 Feb 2024"', 1706745600000),
    ('"Thu, 01 Feb 2024 00:00:00 GMT"', 1706745600000),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    df = spark.createDataFrame([(j,) for j, _ in TIMES], "s string").select(
        "s", F.parse_json("s").alias("v")
    )
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        out = df.select("s", F.unix_millis(timestamps.parse_timestamp(F.col("v"))).alias("ms")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r["s"]: r["ms"] for r in out} == dict(TIMES)


def test_timestamp_of_a_missing_key(spark):
    v = variants.field(F.col("v"), "timestamp")
    assert variant(spark, "{}", timestamps.parse_timestamp(v)) is None


@pytest.mark.parametrize(
    "number, out", [("1e300", True), ("8640000000000001", True), ("8640000000000000", False),
                    ("-9e12", True), ('"x"', False), ("null", False)]
)
def test_out_of_range(spark, number, out):
    # -9e12 is seconds, so -9e15 ms.
    assert variant(spark, number, timestamps.out_of_range(timestamps.number_ms(F.col("v")))) is out


@pytest.mark.parametrize(
    "number, ms", [("253402300800", 253402300800000), ("8640000000000000", 8640000000000000)]
)
def test_years_beyond_9999(spark, number, ms):
    assert variant(spark, number, F.unix_millis(timestamps.parse_timestamp(F.col("v")))) == ms


def test_iso_text_and_utc_date(spark):
    ts = F.timestamp_millis(F.lit(1706745599999))
    assert one(spark, timestamps.iso_text(ts)) == "2024-01-31T23:59:59.999Z"
    assert str(one(spark, timestamps.utc_date(ts))) == "2024-01-31"
    assert str(one(spark, timestamps.utc_date(F.timestamp_millis(F.lit(-1))))) == "1969-12-31"


@pytest.mark.parametrize(
    "value, kept",
    [("0", False), ("0.0", False), ("false", False), ('""', False), ("null", False), ("{}", True),
     ("[]", True), ('"x"', True), ('"0"', True), ('"false"', True), ("1", True), ("-1.5", True),
     ("true", True), ('{"a":0}', True), ("1e300", True)],
)
def test_truthiness(spark, value, kept):
    assert variant(spark, value, variants.is_truthy(F.col("v"))) is kept
    out = variant(spark, value, variants.truthy_or_null(F.col("v")).isNotNull())
    assert out is kept


def test_missing_is_not_truthy(spark):
    assert variant(spark, "{}", variants.is_truthy(variants.field(F.col("v"), "p"))) is False


@pytest.mark.parametrize("value, text_", [('""', ""), ("null", None), ("7", "7"), ("true", "true")])
def test_text(spark, value, text_):
    assert variant(spark, value, variants.as_text(F.col("v"))) == text_


BODY = '{"note":"this position is too old, begin again","code":"CURSOR_EXPIRED"}'
RESPONSES = [
    ("events", 400, BODY, "cursor_expired"),
    ("events", 400, '{"code":"CURSOR_EXPIRED"}', "cursor_expired"),
    ("feed", 400, '{"code":"CURSOR_EXPIRED","message":"Cursor expired"}', "cursor_expired"),
    ("feed", 400, "cursor expired", "retryable"),
    ("events", 400, "bad limit", "retryable"),
    ("events", 400, None, "retryable"),
    ("feed", 401, "", "retryable"),
    ("events", 401, "", "fatal"),
    ("feed", 403, "token expired", "token_expired"),
    ("feed", 403, "INVALID_STREAM_TOKEN", "token_expired"),
    ("feed", 403, "no", "retryable"),
    ("events", 403, "token expired", "fatal"),
    ("feed", 429, "", "rate_limited"),
    ("events", 429, "", "rate_limited"),
    ("feed", 500, "", "retryable"),
    ("events", 503, "", "retryable"),
    ("feed", 200, "{}", "ok"),
    ("events", 204, "", "ok"),
    ("feed", 200, "CURSOR_EXPIRED", "ok"),
    ("feed", 302, "", "retryable"),
]


def test_outcomes(spark):
    df = spark.createDataFrame(RESPONSES, "source string, status int, body string, expected string")
    got = responses.outcome(F.col("source"), F.col("status"), F.col("body"))
    assert df.select("*", got.alias("got")).where("not (got <=> expected)").collect() == []


@pytest.mark.parametrize(
    "source, status, headers, wait",
    [("feed", 429, {}, 5), ("feed", 429, None, 5), ("feed", 429, {"Retry-After": "9"}, 9),
     ("feed", 429, {"x-ratelimit-reset": "30"}, 5), ("events", 429, {}, 60),
     ("events", 429, {"x-ratelimit-reset": "30"}, 30), ("events", 429, {"retry-after": "x"}, 60),
     ("events", 429, {"RETRY-AFTER": "0", "x-ratelimit-reset": "30"}, 0),
     ("feed", 429, {"Retry-After": "3", "retry-after": "4"}, 3), ("events", 200, {}, None)],
)
def test_waits(spark, source, status, headers, wait):
    pairs = [F.lit(x) for kv in (headers or {}).items() for x in kv]
    h = F.lit(None) if headers is None else F.create_map(*pairs)
    column = responses.wait_seconds(F.lit(source), F.lit(status), h.cast("map<string,string>"))
    assert one(spark, column) == wait


@pytest.mark.parametrize(
    "value, out", [("10", 10), ("10;w=60", 10), (" 7", 7), ("-3", -3), ("abc", None), ("", None), (None, None)]
)
def test_leading_int(spark, value, out):
    assert one(spark, text.leading_int(F.lit(value).cast("string"))) == out


@pytest.mark.parametrize(
    "value, out",
    [("a\tb", "a\\tb"), ("a\nb\r", "a\\nb\\r"), ("\\", "\\\\"), ("\\t", "\\\\t"), (None, "\\N"), ("", "")],
)
def test_copy_escape(spark, value, out):
    assert one(spark, text.copy_escape(F.lit(value).cast("string"))) == out


def test_mask(spark):
    assert one(spark, text.mask_secret(F.lit("ds_1234567890"))) == "ds_1...7890"
    assert one(spark, text.mask_secret(F.lit("abc"))) == "abc...abc"


def test_path_bucket(spark):
    uid = "0123abcd-0000-0000-0000-000000000000"
    assert one(spark, text.path_bucket(F.lit(f"/a/{uid}/b/{uid}"))) == "/a/:id/b/:id"
    assert one(spark, text.path_bucket(F.lit("/a/0123"))) == "/a/0123"


def test_numbers(spark):
    assert [one(spark, text.round_half_up(F.lit(x))) for x in (2.5, -2.5, 1.4, 0.5)] == [3, -2, 1, 1]
    assert one(spark, text.fixed1(F.lit(33.333))) == "33.3"
    assert one(spark, text.grouped(F.lit(3000000))) == "3,000,000"


def test_backoff(spark):
    def waits(cap):
        return [one(spark, text.backoff_ms(F.lit(a), cap)) for a in (1, 2, 3, 4, 5, 20, 1000)]

    assert waits(10_000) == [1000, 2000, 4000, 8000, 10000, 10000, 10000]
    assert waits(None)[:3] == [1000, 2000, 4000]
    assert one(spark, text.run_retry_ms(F.lit(3))) == 15000


def encode(value):
    return base64.b64encode(json.dumps(value).encode()).decode()


def test_cursor(spark):
    good = encode({"id": "evt-1", "ts": 5, "v": 1, "exp": 1000})
    out = one(spark, cursors.decode_cursor(F.lit(good)))
    assert (out["id"], out["ts"], out["v"], out["exp"]) == ("evt-1", 5, 1, 1000)
    assert one(spark, cursors.cursor_expired(F.lit(good), F.lit(1001))) is True
    assert one(spark, cursors.cursor_expired(F.lit(good), F.lit(1000))) is False


@pytest.mark.parametrize("bad", ["not base64!", encode("text"), base64.b64encode(b"{x").decode(), "", "/w=="])
def test_cursor_that_is_none(spark, bad):
    out = one(spark, cursors.decode_cursor(F.lit(bad)))
    assert (out["id"], out["exp"]) == (None, None)
    assert one(spark, cursors.cursor_expired(F.lit(bad), F.lit(1))) is None


def test_more_date_texts(spark):
    texts = ["Feb 1, 2024 12:00:00", "Feb 1 2024 12:00:00", "2024/02/01 12:00", "2024/2/1 12:00:00",
             "Thu Feb 01 2024 12:00:00 GMT+0000"]
    assert [one(spark, F.unix_millis(timestamps.parse_text(F.lit(t)))) for t in texts] == [1706788800000] * len(texts)
    assert one(spark, F.unix_millis(timestamps.parse_text(F.lit("2024-2-1")))) == 1706745600000
    assert one(spark, timestamps.parse_text(F.lit("2024-13-1"))) is None

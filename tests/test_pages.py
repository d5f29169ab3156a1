"""Page scans, envelopes, flattening, typed rows: SRC1-6, PRJ1-5, SNK5, F3 and F6 fixtures."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from eventmill.operators.normalize import loadable, normalize, rejected
from eventmill.plans.load import typed_events
from eventmill.sources import arrays, envelope, page_log, sessions
from tests.conftest import body, event, page
from tests.conftest import page_log as log

STAMP = datetime(2024, 3, 1, tzinfo=timezone.utc)


def decode_one(spark, text, source="feed", limit=None):
    rows = envelope.decode(log(spark, [page(0, text, source=source, limit=limit)]))
    return rows.drop("data").first()


def test_full_envelope(spark):
    row = decode_one(spark, body([event(1), event(2)], has_more=True, next_cursor="c"))
    assert (row["page_limit"], row["has_more"], row["next_cursor"], row["cursor_expires_in"]) == (100, True, "c", 120)
    assert (row["meta_total"], row["meta_returned"], row["request_id"], row["n_events"]) == (3000000, 2, "req-1", 2)
    assert row["bad_body"] is None


@pytest.mark.parametrize("source, limit, expected", [("feed", None, 5000), ("events", None, 1000), ("feed", 50, 50)])
def test_defaults(spark, source, limit, expected):
    row = decode_one(spark, "{}", source, limit)
    assert (row["page_limit"], row["has_more"], row["next_cursor"], row["cursor_expires_in"]) == (expected, False, None, None)
    assert (row["meta_total"], row["meta_returned"], row["request_id"], row["n_events"]) == (0, 0, "", 0)
    assert row["bad_body"] is None


def test_flat_shape_and_nested_before_flat(spark):
    flat = decode_one(spark, '{"data":[{"id":"a"}],"hasMore":true,"nextCursor":"n"}')
    assert (flat["has_more"], flat["next_cursor"], flat["meta_returned"]) == (True, "n", 1)
    both = decode_one(spark, '{"pagination":{"hasMore":false,"nextCursor":"p"},"hasMore":true,"nextCursor":"n"}')
    assert (both["has_more"], both["next_cursor"]) == (False, "p")
    null = decode_one(spark, '{"data":null,"pagination":null,"meta":null}')
    assert (null["has_more"], null["n_events"], null["bad_body"]) == (False, 0, None)


@pytest.mark.parametrize(
    "text", ["not json", '{"data":[{"id":"a"}],"pagin', '{"data":{"id":"a"}}', '{"data":"abc"}', "[1]", "", None]
)
def test_bodies_that_are_no_page(spark, text):
    decoded = envelope.decode(log(spark, [page(0, text)]))
    assert decoded.select("bad_body").first()[0] == (text or "")
    assert envelope.headers(decoded).count() == 0
    assert [r["reason"] for r in envelope.bad_bodies(decoded).collect()] == ["bad_json"]
    assert envelope.flatten(decoded).count() == 0


def test_odd_pagination_does_not_cost_the_events(spark):
    text = '{"data":[{"id":"a"}],"pagination":{"limit":"x","hasMore":"yes"},"meta":7}'
    row = decode_one(spark, text)
    assert (row["n_events"], row["page_limit"], row["has_more"], row["bad_body"]) == (1, 5000, True, None)


def test_repeated_key_keeps_the_last_value(spark):
    text = '{"data":[{"id":"a","id":"b"},{"id":"c"}]}'
    rows = typed_events(log(spark, [page(0, text)]), STAMP).orderBy("pos").collect()
    assert [r["id"] for r in rows] == ["b", "c"]


def test_failed_requests_have_no_page(spark):
    rows = [page(0, body([event(1)])), page(1, body([event(2)]), status=500), page(2, "CURSOR_EXPIRED", status=400)]
    decoded = envelope.decode(log(spark, rows))
    assert [r["seq"] for r in decoded.collect()] == [0]


def test_flatten_keeps_page_order_and_empty_pages_give_no_row(spark):
    rows = [page(1, body([event(i) for i in (3, 1, 2)])), page(2, body([]))]
    flat = envelope.flatten(envelope.decode(log(spark, rows)))
    got = flat.select("seq", "pos", F.try_variant_get("e", "$.id", "string").alias("id")).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(1, 0, "evt-3"), (1, 1, "evt-1"), (1, 2, "evt-2")]


def test_page_body_is_parsed_once(spark):
    typed = typed_events(log(spark, [page(0, body([event(1)]))]), STAMP)
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_unnest_pads_short_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"], [1, 2])], "k int, x array<string>, y array<int>")
    assert [tuple(r) for r in arrays.unnest(df, ["x", "y"], ["k"]).collect()] == [
        (1, "a", 1), (1, "b", 2), (1, "c", None),
    ]


def test_batch_and_stream_scans_agree(spark, tmp_path):
    path = str(tmp_path / "log")
    for seq in range(3):
        log(spark, [page(seq, body([event(seq)]), source="feed" if seq < 2 else "events")]).coalesce(
            1
        ).write.mode("append").json(path)
    assert page_log.read_pages(spark, path).count() == 3
    assert page_log.read_pages(spark, path, "events").select("seq").first()[0] == 2
    query = (
        page_log.stream_pages(spark, path, max_files=1)
        .writeStream.format("memory").queryName("pages").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r["seq"] for r in spark.table("pages").collect()) == [0, 1, 2]
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    sized = (
        page_log.stream_pages(spark, path, max_bytes=1_000_000)
        .writeStream.format("memory").queryName("sized").trigger(availableNow=True).start()
    )
    sized.awaitTermination()
    assert spark.table("sized").count() == 3


def test_headers_survive_landing(spark, tmp_path):
    path = str(tmp_path / "log")
    log(spark, [page(0, "{}", headers={"X-RateLimit-Limit": "10"})]).write.json(path)
    row = envelope.with_rate_limit(page_log.read_pages(spark, path)).first()
    assert (row["rate_limit"], row["rate_reset"]) == (10, None)


def test_sessions(spark):
    text = json.dumps({"data": [{"id": "s1", "userId": "u", "eventCount": 3, "duration": 1.5, "extra": 1}, {"id": "s2"}]})
    rows = sessions.read_sessions(log(spark, [page(0, text), page(1, text, status=500)])).orderBy("pos").collect()
    assert [(r["id"], r["userId"], r["eventCount"], r["duration"]) for r in rows] == [("s1", "u", 3, 1.5), ("s2", None, None, None)]


def typed_one(spark, **members):
    return typed_events(log(spark, [page(0, json.dumps({"data": [members]}))]), STAMP).withColumns(
        {"properties": F.to_json("properties"), "raw": F.to_json("raw"), "ms": F.unix_millis("timestamp")}
    ).first()


def test_projection(spark):
    row = typed_one(
        spark, id="e", sessionId="", type="t", userId=8, timestamp=1706745600, name="n",
        session={"a": 1}, properties={"k": 1}, extra=[1],
    )
    assert (row["id"], row["session_id"], row["type"], row["user_id"]) == ("e", "", "t", "8")
    assert (row["ms"], row["ts_defaulted"], str(row["event_date"])) == (1706745600000, False, "2024-02-01")
    assert row["properties"] == '{"k":1}'
    assert json.loads(row["raw"])["name"] == "n" and json.loads(row["raw"])["extra"] == [1]
    assert row["ingested_at"].timestamp() == STAMP.timestamp() and row["reason"] is None


def test_missing_members(spark):
    row = typed_one(spark, id="e", sessionId=None)
    assert (row["session_id"], row["type"], row["user_id"], row["properties"]) == (None, None, None, None)
    assert (row["ms"], row["ts_defaulted"]) == (1709251200000, True)


@pytest.mark.parametrize(
    "properties, kept",
    [(0, None), (False, None), ("", None), (None, None), ({}, "{}"), ([], "[]"), ("x", '"x"')],
)
def test_properties_gate(spark, properties, kept):
    assert typed_one(spark, id="e", properties=properties)["properties"] == kept


@pytest.mark.parametrize(
    "members, reason",
    [({}, "no_id"), ({"id": None}, "no_id"), ({"id": 7}, None), ({"id": True}, None), ({"id": ""}, None),
     ({"id": {"a": 1}}, "bad_type"), ({"id": [1]}, "bad_type"), ({"id": "e", "type": {}}, "bad_type"),
     ({"id": "e", "userId": []}, "bad_type"), ({"id": "{not nested"}, None), ({"id": "[x]"}, None),
     ({"id": "e", "timestamp": 1e300}, "ts_range"), ({"id": "e", "timestamp": "1e300"}, None)],
)
def test_reasons(spark, members, reason):
    assert typed_one(spark, **members)["reason"] == reason


def test_elements_that_are_no_objects(spark):
    rows = typed_events(log(spark, [page(0, '{"data":[null,"x",1,[2],{"id":"a"}]}')]), STAMP)
    assert [r["reason"] for r in rows.orderBy("pos").collect()] == ["no_id"] * 4 + [None]


def test_split_is_whole(spark):
    text = json.dumps({"data": [event(1), {"x": 1}, event(2, timestamp=1e300), event(3)]})
    flat = envelope.flatten(envelope.decode(log(spark, [page(0, text)])))
    rows = normalize(flat, F.lit(STAMP))
    assert [r["id"] for r in loadable(rows).orderBy("pos").collect()] == ["evt-1", "evt-3"]
    bad = rejected(rows).orderBy("pos").collect()
    assert [(r["pos"], r["reason"]) for r in bad] == [(1, "no_id"), (2, "ts_range")]
    assert json.loads(bad[0]["raw"]) == {"x": 1}


def test_rejected_sessions(spark):
    good = json.dumps({"data": [{"id": "s1", "eventCount": "x"}, {"userId": "u"}, 7]})
    pages = log(spark, [page(0, good), page(1, good[:-3]), page(2, "nonsense"), page(3, good, status=500)])
    rows = sessions.read_sessions(pages).collect()
    assert [(r["seq"], r["id"], r["eventCount"]) for r in rows] == [(0, "s1", None)]
    out = sessions.rejected_sessions(pages).orderBy("seq", "pos").collect()
    assert [(r["seq"], r["pos"], r["reason"]) for r in out] == [
        (0, 1, "no_id"), (0, 2, "bad_type"), (1, None, "bad_json"), (2, None, "bad_json"),
    ]
    assert out[2]["raw"] == good[:-3]

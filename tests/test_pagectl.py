"""Running aggregates and page control: WIN2-6, JOIN3, FLT3-5, AGG4."""

import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from eventmill.operators import chains, pagectl, reports
from eventmill.operators.running import Running, chunked, running
from eventmill.sources import envelope
from tests.conftest import body, event, page
from tests.conftest import page_log as log


@pytest.mark.parametrize("chunk", [1, 3, 7, 1000])
def test_running_against_brute_force(spark, chunk):
    rng = random.Random(chunk)
    data = []
    for key, size in (("hot", 60), ("small", 5), (None, 7)):
        for seq in rng.sample(range(-50, 200), size):
            data.append((key, seq, rng.choice([None, -2, 0, 3, 5])))
    df = spark.createDataFrame(data, "k string, seq long, v long").repartition(5)
    spec = {
        "total": Running("sum", F.col("v")),
        "top": Running("max", F.col("v")),
        "low_before": Running("min", F.col("v"), before=True),
        "last": Running("max", F.when(F.col("v").isNotNull(), F.struct("seq", "v"))),
        "prev": Running("max", F.struct("seq", "v"), before=True),
    }
    out = {(r["k"], r["seq"]): r for r in running(df, ["k"], "seq", spec, chunk=chunk).collect()}
    assert len(out) == len(data)
    for key in ("hot", "small", None):
        group = sorted((s, v) for k, s, v in data if k == key)
        for i, (seq, _) in enumerate(group):
            row = out[(key, seq)]
            upto = [v for _, v in group[: i + 1] if v is not None]
            before = [v for _, v in group[:i] if v is not None]
            assert row["total"] == sum(upto)
            assert row["top"] == (max(upto) if upto else None)
            assert row["low_before"] == (min(before) if before else None)
            known = [(s, v) for s, v in group[: i + 1] if v is not None]
            assert (tuple(row["last"]) if row["last"] else None) == (known[-1] if known else None)
            assert (tuple(row["prev"]) if row["prev"] else None) == (group[i - 1] if i else None)


def test_a_hot_group_is_spread_over_chunks(spark):
    df = spark.range(10_000).select(F.lit("one").alias("k"), F.col("id").alias("seq"))
    out = running(df, ["k"], "seq", {"n": Running("sum", F.lit(1))}, chunk=100)
    assert out.where("n <> seq + 1").count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "_chunk" in plan


def pages(spark, sizes, run="r1", source="feed", has_more=None, cursors=None, first_cursor=None):
    rows, cursor = [], first_cursor
    for seq, size in enumerate(sizes):
        more = True if has_more is None else has_more[seq]
        nxt = f"c-{seq}" if cursors is None else cursors[seq]
        rows.append(page(seq, body([event(f"{seq}-{i}") for i in range(size)], more, nxt), run, source, cursor=cursor))
        cursor = nxt
    return envelope.headers(envelope.decode(log(spark, rows)))


def seqs(df):
    return sorted(r["seq"] for r in df.collect())


def test_stops_after_ten_empty_pages(spark):
    assert seqs(pagectl.empty_page_stop(pages(spark, [0] * 14))) == list(range(10))


def test_a_full_page_resets_the_streak(spark):
    kept = pagectl.empty_page_stop(pages(spark, [0] * 5 + [3] + [0] * 10 + [2, 0]))
    assert seqs(kept) == list(range(16))
    assert {r["seq"]: r["empty_streak"] for r in kept.collect()} == {
        **{i: i + 1 for i in range(5)}, 5: 0, **{i: i - 5 for i in range(6, 16)}
    }


def test_nine_empty_pages_do_not_stop(spark):
    assert len(seqs(pagectl.empty_page_stop(pages(spark, [1] + [0] * 9 + [1] + [0] * 9)))) == 20


def test_failed_requests_do_not_count(spark):
    rows = [page(seq, body([], next_cursor="c")) for seq in range(0, 18, 2)]
    rows += [page(seq, "oops", status=500) for seq in range(1, 18, 2)]
    rows += [page(18, body([event(1)]))]
    headers = envelope.headers(envelope.decode(log(spark, rows)))
    assert seqs(pagectl.empty_page_stop(headers)) == list(range(0, 19, 2))


def test_runs_and_sources_are_separate(spark):
    both = pages(spark, [0] * 9, "a").unionByName(pages(spark, [0] * 9, "b")).unionByName(
        pages(spark, [0] * 11, "a", "events")
    )
    kept = pagectl.empty_page_stop(both).groupBy("run_id", "source").count().collect()
    assert {(r["run_id"], r["source"]): r["count"] for r in kept} == {
        ("a", "feed"): 9, ("b", "feed"): 9, ("a", "events"): 10
    }


@pytest.mark.parametrize("more, cursor, terminal", [(True, "c", False), (False, "c", True), (True, None, True), (True, "", True)])
def test_terminal(spark, more, cursor, terminal):
    row = pages(spark, [1], has_more=[more], cursors=[cursor]).select(pagectl.is_terminal()).first()
    assert row[0] is terminal


def test_rows_after_the_terminal_page_are_cut(spark):
    headers = pages(spark, [1, 1, 1, 1], has_more=[True, False, True, False])
    assert seqs(pagectl.terminal_cut(headers)) == [0, 1]


def test_stop_points(spark):
    empty = pages(spark, [1] + [0] * 12, "empty")
    end = pages(spark, [1, 1, 0], "end", has_more=[True, True, False])
    open_ = pages(spark, [1, 1], "open")
    tie = pages(spark, [0] * 10, "tie", has_more=[True] * 9 + [False])
    first = pages(spark, [1] + [0] * 12, "first", has_more=[True] * 5 + [False] * 8)
    headers = empty.unionByName(end).unionByName(open_).unionByName(tie).unionByName(first)
    got = {r["run_id"]: (r["stop_seq"], r["stop_reason"]) for r in pagectl.stop_points(headers).collect()}
    assert got == {
        "empty": (10, "empty_pages"), "end": (2, "end_of_data"), "open": (None, None),
        "tie": (9, "empty_pages"), "first": (5, "end_of_data"),
    }
    kept = pagectl.keep_until(headers, pagectl.stop_points(headers)).groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in kept} == {"empty": 11, "end": 3, "open": 2, "tie": 10, "first": 6}


def test_checkpoint_points(spark):
    feed = pages(spark, [1] * 25, "r", "feed")
    events = pages(spark, [1] * 12, "r", "events")
    got = pagectl.checkpoint_points(feed.unionByName(events)).orderBy("source", "seq").collect()
    assert [(r["source"], r["page_no"], r["resume_cursor"]) for r in got] == [
        ("events", 5, "c-3"), ("events", 10, "c-8"), ("feed", 10, "c-9"), ("feed", 20, "c-19"),
    ]


def test_page_chain(spark):
    asked = [None, "c-0", None, "zzz", "c-3"]
    rows = [page(i, body([], next_cursor=f"c-{i}"), cursor=c) for i, c in enumerate(asked)]
    rows.insert(2, page(10, "CURSOR_EXPIRED", status=400, cursor="c-1"))
    out = pagectl.page_chain(envelope.headers(envelope.decode(log(spark, rows)))).orderBy("seq").collect()
    assert [r["link"] for r in out] == ["start", "linked", "reset", "broken", "linked"]
    assert out[3]["expected_cursor"] == "c-2"


def test_target_cut(spark):
    counts = spark.createDataFrame([("r", "feed", i, n) for i, n in enumerate([4, 0, 3, 5, 2])], "run_id string, source string, seq long, new_rows long")
    out = pagectl.target_cut(counts, 7).orderBy("seq").collect()
    assert [(r["seq"], r["total"], r["is_target_page"]) for r in out] == [(0, 4, False), (1, 4, False), (2, 7, True)]
    assert pagectl.target_cut(counts, 100).count() == 5


def test_target_is_one_total_for_all_runs(spark):
    rows = [("r2", "feed", 0, 5), ("r1", "events", 0, 5), ("r1", "feed", 1, 5), ("r1", "feed", 0, 5)]
    counts = spark.createDataFrame(rows, "run_id string, source string, seq long, new_rows long")
    out = pagectl.target_cut(counts, 18, saved=4).orderBy("total").collect()
    assert [(r["run_id"], r["source"], r["seq"], r["total"]) for r in out] == [
        ("r1", "feed", 0, 9), ("r1", "feed", 1, 14), ("r1", "events", 0, 19)
    ]


def test_target_is_seen_late(spark):
    at = lambda s: datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=s)
    rows = [(at(1), 4), (at(9), 3), (at(10), 1), (at(19), 5), (at(45), 2), (at(46), 9), (at(60), 1)]
    counts = spark.createDataFrame([*rows, (None, 2)], "requested_at timestamp, new_rows long")
    out = pagectl.late_target(counts, 16, saved=1).orderBy("total").collect()
    # Reached in the second span with pages, which the load only learns at its end: no span after it.
    assert [(r["pages"], r["known_total"], r["total"], r["is_target_span"], r["overshoot"]) for r in out] == [
        (1, 1, 3, False, 0), (2, 3, 10, False, 0), (2, 10, 16, True, 0),
    ]
    assert pagectl.late_target(counts, 17, saved=1).orderBy("total").collect()[-1]["overshoot"] == 10
    assert pagectl.late_target(counts, 1000).count() == 5
    assert pagectl.late_target(counts.limit(0), 5).count() == 0


def test_pacing(spark):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    limit = {"x-ratelimit-limit": "10", "x-ratelimit-reset": "60"}
    calls = [(0, 0, 200, None), (1, 1, 200, limit), (2, 2, 429, None), (3, 3, 200, {"x-ratelimit-limit": "0", "x-ratelimit-reset": "9"}), (4, 20, 200, limit)]
    rows = [page(s, "{}", source="events", status=c, headers=h, at=start + timedelta(seconds=t)) for s, t, c, h in calls]
    rows.append(page(9, "{}", source="feed", headers=limit, at=start))
    requests = envelope.with_rate_limit(envelope.classify(log(spark, rows)))
    out = pagectl.pacing_audit(requests).orderBy("seq").collect()
    # The first paced request (seq 2) has no paced one before it.
    assert [(r["seq"], r["gap_ms"], r["min_interval_ms"], r["wait_ms"]) for r in out] == [
        (2, None, 6000.0, 0.0), (3, 1000, 6000.0, 5000.0), (4, 17000, 6000.0, 0.0),
    ]


def test_page_counters(spark):
    row = reports.page_counters(pages(spark, [2, 0, 3, 0])).first()
    assert (row["pages"], row["empty_pages"], row["events"]) == (4, 2, 5)


def test_attempts_count_failures_in_a_row(spark):
    rows = [("r", "feed", s, o) for s, o in [(1, "retryable"), (5, "retryable"), (9, "ok"), (9000, "retryable")]]
    rows += [("r", "events", s, "retryable") for s in (0, 4096, 8192)]
    out = pagectl.attempts(spark.createDataFrame(rows, "run_id string, source string, seq bigint, outcome string"))
    got = {(r["source"], r["seq"]): r["attempt"] for r in out.collect()}
    assert [got["feed", s] for s in (1, 5, 9, 9000)] == [1, 2, 0, 1]
    assert [got["events", s] for s in (0, 4096, 8192)] == [1, 2, 3]


def headers_of(spark, rows):
    """Rows of (run, source, seq, n_events, has_more, next_cursor, request_cursor)."""
    schema = "run_id string, source string, seq long, n_events long, has_more boolean, next_cursor string, request_cursor string"
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_stops_of_sparse_runs_against_brute_force(spark, chunk):
    rng = random.Random(chunk)
    rows, want = [], {}
    for r in range(12):
        seqs = sorted(rng.sample(range(10**12), 60))  # numbers far apart
        empty_from = rng.randint(0, 70)
        streak = stop = reason = None
        streak = 0
        for i, seq in enumerate(seqs):
            n = 0 if i >= empty_from or rng.random() < 0.6 else 5
            more = rng.random() > 0.01
            rows.append((f"r{r}", "feed", seq, n, more, "c", None))
            streak = streak + 1 if n == 0 else 0
            if stop is None and streak >= 10:
                stop, reason = seq, "empty_pages"
            elif stop is None and not more:
                stop, reason = seq, "end_of_data"
        want[f"r{r}"] = (stop, reason)
    found = pagectl.stop_points(headers_of(spark, rows).repartition(5), chunk=chunk).collect()
    assert {r["run_id"]: (r["stop_seq"], r["stop_reason"]) for r in found} == want


def exchanges(df):
    """Shuffles that were run: one that is used twice is run once."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange ", final))


def test_page_control_moves_pages_twice(spark):
    pages = headers_of(spark, [("r", "feed", i, 1, True, "c", None) for i in range(5)])
    assert exchanges(pagectl.stop_points(pages)) == 3  # sorted, by chunk; then summaries by run
    assert exchanges(pagectl.number_pages(pages)) <= 5  # and the summaries join their chunks


def test_chunks_hold_rows_not_ranges_of_numbers(spark):
    rows = [("r", "feed", i * 10**9, 1, True, "c", None) for i in range(4000)]
    cut = chunked(headers_of(spark, rows), ["run_id", "source"], "seq", 100)
    sizes = [r["count"] for r in cut.groupBy("_chunk").count().collect()]
    assert max(sizes) <= 100 and len(sizes) <= 4000 / 100 + 4


def test_cursor_chains(spark):
    def row(seq, asked, handed, run="r"):
        return (run, "feed", seq, 1, True, handed, asked)

    rows = [
        row(9, None, "a"), row(3, "a", "b"), row(7, "b", "c"), row(1, "c", None),  # a chain out of order
        row(8, "b", "c2"), row(2, "zzz", "d"), row(4, "d", ""),                   # a fork; an orphan
        row(20, "g", "e"), row(21, "e", "f"), row(22, "f", "g"), row(23, "g", None),  # a loop, and a way off it
        row(30, "s", "s"), row(40, "a", "x", run="q"),                            # a page after itself; another run
    ]
    found = {
        (r["run_id"], r["seq"]): (r["parent_seq"], r["head_seq"], r["step"], r["siblings"], r["link"])
        for r in chains.cursor_chains(headers_of(spark, rows).repartition(3)).collect()
    }
    assert found == {
        ("r", 9): (None, 9, 0, None, "start"), ("r", 3): (9, 9, 1, 1, "linked"), ("r", 7): (3, 9, 2, 2, "linked"),
        ("r", 8): (3, 9, 2, 2, "linked"), ("r", 1): (7, 9, 3, 1, "linked"), ("r", 2): (None, 2, 0, 1, "orphan"),
        ("r", 4): (2, 2, 1, 1, "linked"), ("r", 20): (22, None, None, 2, "loop"), ("r", 21): (20, None, None, 1, "loop"),
        ("r", 22): (21, None, None, 1, "loop"), ("r", 23): (22, None, None, 2, "loop"),
        ("r", 30): (30, None, None, 1, "loop"), ("q", 40): (None, 40, 0, 1, "orphan"),
    }


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rng, n = random.Random(2), 700
    seqs = rng.sample(range(10**6), n)
    rows = [("r", "feed", s, 1, True, f"c{i}", f"c{i - 1}" if i else None) for i, s in enumerate(seqs)]
    rounds = []
    written = chains._written
    monkeypatch.setattr(chains, "_written", lambda df, name: rounds.append(name) or written(df, name))
    found = chains.cursor_chains(headers_of(spark, rows)).collect()
    assert {r["seq"]: r["step"] for r in found} == {s: i for i, s in enumerate(seqs)}
    assert rounds.count("chain-state") <= 11

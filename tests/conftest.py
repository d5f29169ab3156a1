import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventmill import schemas  # noqa: E402
from eventmill.session import configure  # noqa: E402
from eventmill.sinks.tables import create_tables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(root / "checkpoints"))
    yield configure(session)
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    name = "t_" + "".join(c if c.isalnum() else "_" for c in tmp_path.name)
    return create_tables(spark, name, str(tmp_path), buckets=4)


def page(seq, body, run="r1", source="feed", status=200, cursor=None, limit=None, headers=None,
         path="/api/v1/events", at=None):
    from datetime import datetime, timedelta, timezone

    at = at or datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=seq or 0)
    return (run, source, seq, path, cursor, limit, at, status, headers, body)


def page_log(spark, rows):
    return spark.createDataFrame(rows, schemas.PAGE_LOG)


def body(events, has_more=True, next_cursor="cursor-next", total=3000000):
    import json

    return json.dumps(
        {
            "data": events,
            "pagination": {
                "limit": 100, "hasMore": has_more, "nextCursor": next_cursor, "cursorExpiresIn": 120,
            },
            "meta": {"total": total, "returned": len(events), "requestId": "req-1"},
        }
    )


def event(i, **more):
    return {"id": f"evt-{i}", "sessionId": "sess-1", "type": "click", "timestamp": 1706745600000, **more}

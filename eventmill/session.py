"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated key in an event keeps its last value instead of failing the whole page.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # With 96-bit times, files have no minimum and maximum, and time ranges skip nothing.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods beyond this size; splitting them keeps parsing fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine relies on to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def splits_of(spark: SparkSession, size: str) -> Iterator[None]:
    """Files are read in splits of up to ``size`` by what runs inside."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local master, where driver and executors are one process, falls back
    to the machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="eventmill-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings only: they can be applied to a session somebody else made.
RUNTIME_CONF = {
    # A repeated JSON key keeps its last value instead of failing the line.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    # Instants are stored as milliseconds in UTC, with statistics readers can skip by.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MILLIS",
    # A task that writes a few partitions keeps a writer open for each, where it would sort all its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to an existing session and hand it back."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scan_task_size(spark: SparkSession, megabytes: int | None) -> None:
    """Bytes of input per scan task, which also sets the size of the files a narrow job writes."""
    if megabytes is not None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", f"{megabytes}m")


def local_session(cores: int | str = "*", app: str = "feedmill") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FEEDMILL_DRIVER_MEMORY", "16g"))
    )
    return prepare(builder.getOrCreate())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the session's shared checkpoint folder.

    ``spark.checkpoint.dir`` is the cluster's shared folder. Where it is unset,
    a local master falls back to the machine's temporary folder; any other
    master is refused, because its executors could not see such a folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="feedmill-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"

"""Session settings, and the shared folder in which jobs put what they write between steps."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "lodewright") -> SparkSession:
    """A session for tests and the benchmark. Cluster jobs bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", _scratch())
        .getOrCreate()
    )


def _scratch() -> str:
    """A folder for a session whose executors are this machine: the given one, or a new one."""
    given = os.environ.get("LODEWRIGHT_CHECKPOINT_DIR")
    return given or Path(tempfile.mkdtemp(prefix="lodewright-")).as_uri()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the session's ``spark.checkpoint.dir``.

    The setting must name a folder that all executors share. Only a session of this machine alone may
    go without it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _scratch()
    return f"{base.rstrip('/')}/lodewright/{label}-{uuid.uuid4().hex}"

"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


#: Rows of one Arrow batch.
BATCH_ROWS = 1000


def worker_path() -> str:
    """``PYTHONPATH`` of the Python workers: the folder that holds this package, then what is set already.

    Workers of a session started anywhere find the package there; a cluster has it at the same
    place or installed (``pyproject.toml``).
    """
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    return os.pathsep.join(dict.fromkeys([home, *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))


def build_session(master: str | None = None, app: str = "jobmill", **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; extra ``conf`` entries win."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # Texts and pages are long: small Arrow batches bound the memory of a worker.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.executorEnv.PYTHONPATH": worker_path(),
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, texts go to Python workers in batches of ``BATCH_ROWS``: both sides hold less at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the cluster's shared folder.

    The folder is ``spark.checkpoint.dir``, which every executor can reach. Only a
    local-mode session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="jobmill-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

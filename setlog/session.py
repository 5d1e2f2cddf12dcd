"""Where a session keeps the tables it derives."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, per application.

    Only a local session without that setting gets a temporary folder.
    """
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/setlog/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="setlog-")
    return _local_roots[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes within free their shuffle files when they end, not when the driver happens to collect its garbage: what
    a job of several writes holds on disk is its tables and the shuffles of one write."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)

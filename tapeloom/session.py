"""Session settings and shared working folders."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_local_base: str | None = None


def prepare(spark: SparkSession) -> SparkSession:
    """All bucketing, formatting and partition paths are in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder for `label` under the shared folder named by the cluster.

    A machine-local folder is used only where `spark.checkpoint.dir` is unset and
    the session itself is local (tests).
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="tapeloom-")
        base = _local_base
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set session options for the duration of an action, then put them back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def at_most(df: DataFrame, rows: int) -> bool:
    """Size check before a broadcast: true if `df` has no more than `rows` rows."""
    return df.limit(rows + 1).count() <= rows

"""Session settings and the shared folder for stored tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "abonados", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on.

    Times are kept in UTC. Adaptive execution sizes shuffle partitions and
    splits skewed joins. Further settings: ``build_session(**{"spark.x.y": "z"})``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only where the session names none (tests on one machine) a new temporary
    folder is set.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        named = tempfile.mkdtemp(prefix="abonados-")
        spark.conf.set(CHECKPOINT_DIR, named)
    return named.rstrip("/")

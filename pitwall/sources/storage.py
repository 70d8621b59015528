"""Where jobs keep intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Intermediate tables are written once and read a few times, so size counts.
COMPRESSION = "zstd"


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only where the setting is absent in a session on one machine, as in tests, a local folder
    takes its place; a cluster without the setting is refused.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="pitwall-")
        spark.conf.set(CHECKPOINT_SETTING, root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run under the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the tables written inside go with the write that needed them.

    Otherwise they stay until the driver happens to collect its garbage, which on a long chain of
    writes adds up to many times the input.
    """
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)

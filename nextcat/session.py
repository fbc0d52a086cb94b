"""Session construction and the shared scratch location.

Jobs that write intermediate tables (round-trip queries, lineage cuts before
iterative training) put them under ``spark.checkpoint.dir`` — on a cluster that
is the shared folder the deployment names.  Only a session on one machine
(unit tests, a bare local run) that names none gets a folder of its own."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "nextcat", extra: dict | None = None) -> SparkSession:
    """Session with adaptive execution on, UTC time zone, no UI."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if _one_machine(spark):
        ensure_checkpoint_dir(spark)
    return spark


def _one_machine(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory.  A local one is made only where all
    executors share this machine; elsewhere a missing setting is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _one_machine(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="nextcat-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


# Settings of jobs whose result is written.  A SQL execution removes its shuffle
# files when it ends; a stage with a generated method beyond 8,000 bytes, which HotSpot
# only interprets, runs its operators one by one.
STORING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def storing(spark: SparkSession) -> Iterator[None]:
    """For jobs whose result is written: each removes its shuffle files when it
    ends, instead of leaving them until the driver collects its garbage, so disk
    holds the shuffles of one job at a time (a frame that is run again makes them
    anew), and wide aggregates run compiled.  The session's own settings come back."""
    was = {k: spark.conf.get(k, None) for k in STORING}
    for k, v in STORING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint directory and read from there:
    later jobs neither recompute it nor depend on live executors."""
    ensure_checkpoint_dir(df.sparkSession)
    with storing(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a frame of its own: the setting holds for frames made under it

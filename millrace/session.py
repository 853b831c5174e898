"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Runtime settings every job here relies on. Partition counts are left to the
#: cluster: adaptive execution coalesces or splits shuffles by their real size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def local_session(app: str = "millrace", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_base: dict[str, str] = {}


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder, reachable by every executor, under ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a folder of its own.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if app not in _local_base:
            _local_base[app] = tempfile.mkdtemp(prefix="millrace-")
        base = _local_base[app]
    return f"{base.rstrip('/')}/millrace/{app}/{label}-{uuid.uuid4().hex[:12]}"

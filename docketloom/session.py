"""Session helper shared by the entry point, the bench and the tests."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str | None = None, shuffle_partitions: int = 8, app: str = "docketloom") -> SparkSession:
    """A local session with the settings the engine expects; an active session is reused as it is."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("DOCKETLOOM_DRIVER_MEMORY", "6g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )

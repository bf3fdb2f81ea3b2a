"""Session settings for tests and benchmarks; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str, cores: int = 8, memory: str = "8g") -> SparkSession:
    session = (SparkSession.builder.master(f"local[{cores}]").appName(name)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(cores))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return session

"""Session construction for tests, the benchmark and small local runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings the operators count on: AQE re-plans joins from real shuffle
# sizes and splits a hot join key over several tasks.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: int | str = "*", app: str = "sparktide", **extra: str) -> SparkSession:
    """A local session; on a cluster use the session the cluster hands out."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        **ADAPTIVE,
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_adaptive(spark: SparkSession) -> SparkSession:
    """Turn the adaptive settings on in a session someone else built."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark

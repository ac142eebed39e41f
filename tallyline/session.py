"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # An overflow of an exact number must fail, never turn into NULL.
    "spark.sql.ansi.enabled": "true",
    # Decoding makes long generated methods.  The JIT skips methods over 8,000
    # bytes of bytecode, so past that size many small methods run faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark

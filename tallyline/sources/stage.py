"""Stage tables: written results that cut a long plan into recoverable parts.

A stage is a Parquet table in the shared folder that the session names in
``spark.checkpoint.dir``, so a lost executor costs a re-read, later steps prune
columns, and no step is planned or computed twice.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tallyline-")


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Where the setting is absent, a private folder serves a session whose
    executors are threads of the driver, as in tests; anything else is an error.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^]]*\])?", master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    return _local_folder()


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/tallyline/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back with its own schema."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

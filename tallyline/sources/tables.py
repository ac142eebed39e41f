"""Readers of the driver's Parquet tables, with explicit schemas (no inference job)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


SPREAD_CONF = "tallyline.test.spread"


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Deal rows to as many tasks as the session asks for; off unless it is set.

    Tests and the bench set it: their single files have one row group, which no
    scan can split.
    """
    tasks = rows.sparkSession.conf.get(SPREAD_CONF, None)
    return rows.repartition(int(tasks), key) if tasks else rows

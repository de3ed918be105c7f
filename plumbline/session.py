"""Spark sessions with what the engine's semantics rest on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Zone-less times are compared as UTC; division and casts fail loudly unless a try_ form is used.
SEMANTICS = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}
#: Plans adapt to what runs; partitions are merged or split by size, not by a fixed number.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session; on a cluster leave master and partitions to its own configuration."""
    b = SparkSession.builder.appName("plumbline")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", shuffle_partitions)
    for key, value in {**SEMANTICS, **ADAPTIVE, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(key, value)
    return b.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Set the semantics on a session that someone else built."""
    for key, value in SEMANTICS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark

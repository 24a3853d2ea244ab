"""Readers for the captured-web tables (parquet)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; column pruning and filters reach the parquet scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan over as many partitions as the session asks for.

    Only where the caller set ``spark.docweave.scanPartitions`` (a small table
    of one row group on one machine); otherwise the scan keeps its splits.
    """
    asked = df.sparkSession.conf.get("spark.docweave.scanPartitions", None)
    return df.repartition(int(asked)) if asked else df


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages ``(page_id, url, html)``."""
    return spread(table(spark, sf_dir, "pages"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")

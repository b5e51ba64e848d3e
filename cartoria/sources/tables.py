"""Parquet tables of one directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The table ``name`` of ``directory``, a Parquet file or a folder of them."""
    return spark.read.parquet(f"{directory}/{name}.parquet")

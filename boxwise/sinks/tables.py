"""Managed tables: database creation and table writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def ensure_schema(spark: SparkSession, name: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS``; a catalog level is chosen by
    configuration (``spark.sql.catalog.*``), not by DDL, in open-source Spark."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def save_table(df: DataFrame, name: str, *, mode: str = "errorifexists", path: str | None = None,
               partition_by=None) -> None:
    """Write a table (default: fail if it exists, like a plain ``saveAsTable``).
    With ``path`` the table's files live there (external table)."""
    w = df.write.mode(mode)
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def table_scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)

"""Catalog tables: create, alter, clone, describe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weir.functions.types import spark_type


def create_table(spark: SparkSession, name: str, columns: dict[str, str], partition_by: list[str] | None = None) -> None:
    """A Parquet table of generic types, if it is not there."""
    spec = ", ".join(f"`{n}` {spark_type(t).simpleString()}" for n, t in columns.items())
    by = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({spec}) USING parquet{by}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def add_columns(spark: SparkSession, name: str, columns: dict[str, str]) -> None:
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{n}` {spark_type(t).simpleString()}' for n, t in columns.items())})")


def like_table(spark: SparkSession, source: str, name: str) -> None:
    """Schema only."""
    spark.sql(f"CREATE TABLE {name} LIKE {source} USING parquet")


def clone_table(spark: SparkSession, source: str, name: str) -> None:
    """Schema and rows."""
    spark.sql(f"CREATE TABLE {name} USING parquet AS SELECT * FROM {source}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def list_tables(spark: SparkSession, database: str = "default") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def list_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name)]

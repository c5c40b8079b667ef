"""Optional exchange with an outside database over JDBC; the caller brings the driver jar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import TABLES, conform


def export_table(df: DataFrame, table: str, url: str, properties: dict[str, str], partitions: int = 8) -> None:
    """Overwrite ``<table>_stage`` in the database; ``partitions`` bounds the open connections."""
    conform(df, TABLES[table].schema).coalesce(partitions).write.jdbc(
        url, f"{table}_stage", mode="overwrite", properties=properties
    )


def read_table(
    spark: SparkSession,
    table: str,
    url: str,
    properties: dict[str, str],
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A stored table with its declared types, read in parallel when ``split`` = (column, low, high, parts)."""
    if split is None:
        raw = spark.read.jdbc(url, table, properties=properties)
    else:
        column, low, high, parts = split
        raw = spark.read.jdbc(
            url, table, column=column, lowerBound=low, upperBound=high, numPartitions=parts, properties=properties
        )
    return conform(raw, TABLES[table].schema)

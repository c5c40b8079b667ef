"""Written intermediate tables: cut lineage and pin a result so that nothing downstream recomputes it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one of our own only for local runs without a setting."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="tidemark-scratch-")
    spark.sparkContext.setCheckpointDir(made)
    return made


class Rounds:
    """A growing table: each round is written as Parquet under the shared folder, and read back as one scan.

    Unlike an in-memory checkpoint this outlives lost executors, and the reader knows the size of what was
    written, so Spark can decide by itself whether a table is small enough to broadcast.
    """

    def __init__(self, spark: SparkSession, label: str):
        self._spark = spark
        self._base = f"{scratch_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
        self._paths: list[str] = []
        self._schema = None
        self.seen: dict = {}

    def add(self, df: DataFrame, **figures: Column) -> int:
        """Write one more round; the number of its rows, and any aggregate ``figures``, come from the same job."""
        path = f"{self._base}/{len(self._paths)}"
        seen = Observation()
        wanted = [F.count(F.lit(1)).alias("rows"), *[column.alias(name) for name, column in figures.items()]]
        df.observe(seen, *wanted).write.parquet(path)
        self._paths.append(path)
        self._schema = self._schema or df.schema
        self.seen = seen.get
        return self.seen["rows"]

    def _read(self, paths: list[str]) -> DataFrame:
        return self._spark.read.schema(self._schema).parquet(*paths)

    def last(self) -> DataFrame:
        return self._read(self._paths[-1:])

    def all(self) -> DataFrame:
        return self._read(self._paths)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """``df`` as a written table."""
    return counted(df, label)[0]


def counted(df: DataFrame, label: str = "step") -> tuple[DataFrame, int]:
    """``df`` as a written table, and its number of rows."""
    table, seen = measured(df, label)
    return table, seen["rows"]


def measured(df: DataFrame, label: str = "step", **figures: Column) -> tuple[DataFrame, dict]:
    """``df`` as a written table, its number of rows, and aggregates taken while it was written."""
    written = Rounds(df.sparkSession, label)
    written.add(df, **figures)
    return written.last(), written.seen

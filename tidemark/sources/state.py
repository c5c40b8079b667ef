"""State tables as versioned, bucketed Parquet folders with a manifest that says which versions belong together.

A reader pins the versions of one manifest, so a plan that is evaluated again after a later commit still sees the
rows it was built on. A commit writes new folders and then one manifest file: readers see all of it or nothing.
One writer at a time is assumed.

Tables are bucketed by key. The merge of the next snapshot then joins bucket to bucket: only the incoming rows
are shuffled, never the stored ones, and the result is already laid out for the next bucketed write.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.schemas import TABLES, TableSpec, align_schema, empty

MANIFEST = "version BIGINT, table STRING, path STRING, columns STRING, buckets INT"


class StateStore:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        tables: dict[str, TableSpec] = TABLES,
        buckets: int | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = tables
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._entries = self._latest()

    # -- reading -------------------------------------------------------------------------------------------

    def _latest(self) -> dict[str, dict]:
        """The newest manifest; it has one short line per table."""
        try:
            lines = self.spark.read.schema(MANIFEST).json(f"{self.root}/_manifests")
            newest = lines.agg(F.max("version").alias("version"))
            return {row["table"]: row.asDict() for row in lines.join(newest, "version").collect()}
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}

    @property
    def version(self) -> int:
        return max((entry["version"] for entry in self._entries.values()), default=0)

    def refresh(self) -> None:
        self._entries = self._latest()

    def has(self, table: str) -> bool:
        return table in self._entries

    def aligned(self, table: str) -> bool:
        """True where a full outer merge on the key comes out laid out in this table's own buckets."""
        return self.has(table) and self._entries[table]["buckets"] == self.buckets

    def read(self, table: str) -> DataFrame:
        """The table as of the pinned manifest; empty but typed before the first commit."""
        spec = self.tables[table]
        if not self.has(table):
            return empty(self.spark, spec.schema)
        entry = self._entries[table]
        if entry["buckets"]:
            name = self._declare(spec, entry)
            stored = self.spark.table(name)
        else:
            stored = self.spark.read.schema(entry["columns"]).parquet(entry["path"])
        return align_schema(stored, spec.schema)

    def _declare(self, spec: TableSpec, entry: dict) -> str:
        """Name the folder in the session's catalog, so that Spark knows its buckets."""
        name = f"tidemark_{entry['path'].rsplit('/', 1)[-1].replace('-', '_')}"
        if not self.spark.catalog.tableExists(name):
            keys = ", ".join(spec.keys)
            self.spark.sql(
                f"CREATE TABLE {name} ({entry['columns']}) USING parquet "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {entry['buckets']} BUCKETS "
                f"LOCATION '{entry['path']}'"
            )
        return name

    # -- writing -------------------------------------------------------------------------------------------

    def _write(self, table: str, df: DataFrame, laid_out: bool) -> dict:
        spec = self.tables[table]
        tag = f"{table}_{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{tag}"
        buckets = self.buckets if spec.bucketed else 0
        if buckets:
            placed = df if laid_out else df.repartition(buckets, *spec.keys)
            (
                placed.write.format("parquet")
                .bucketBy(buckets, *spec.keys)
                .sortBy(*spec.keys)
                .option("path", path)
                .saveAsTable(f"tidemark_{tag}")
            )
        else:
            df.write.parquet(path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        return {"table": table, "path": path, "columns": columns, "buckets": buckets}

    def commit(self, frames: dict[str, DataFrame], laid_out: set[str] = frozenset()) -> int:
        """Write the given tables and publish them together with the unchanged versions of all others.

        ``laid_out`` names frames whose partitions already are this table's buckets (see ``aligned``); the rest
        are repartitioned by key first.
        """
        written = {
            name: self._write(name, df.select(*self.tables[name].columns), name in laid_out)
            for name, df in frames.items()
        }
        version = self.version + 1
        entries = {name: {**entry, "version": version} for name, entry in {**self._entries, **written}.items()}
        lines = [tuple(e[c] for c in ("version", "table", "path", "columns", "buckets")) for e in entries.values()]
        self.spark.createDataFrame(lines, MANIFEST).coalesce(1).write.mode("append").json(f"{self.root}/_manifests")
        self._entries = entries
        return version

    def superseded(self, keep: int = 2) -> DataFrame:
        """Folders no manifest of the last ``keep`` versions refers to; the operator may delete them."""
        lines = self.spark.read.schema(MANIFEST).json(f"{self.root}/_manifests")
        kept = lines.filter(F.col("version") > self.version - keep).select("path")
        return lines.select("path").distinct().join(kept, "path", "left_anti")

    # -- run records ---------------------------------------------------------------------------------------

    def record(self, kind: str, day: str, entity: str, df: DataFrame) -> None:
        """Keep a run's quarantine or metrics; a rerun of the same day replaces its own rows only."""
        df.write.mode("overwrite").parquet(f"{self.root}/_{kind}/day={day}/entity={entity}")

    def records(self, kind: str) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(f"{self.root}/_{kind}")

    def records_or_none(self, kind: str) -> DataFrame | None:
        """The records of all runs, or None where no run has left any."""
        try:
            return self.records(kind)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

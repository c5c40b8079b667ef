"""Only what is new: a high-water mark and a file ledger for batches, and a stream over the same folder."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.reconcile import dedup_latest
from tidemark.plans import transactions
from tidemark.schemas import CORRUPT, RAW
from tidemark.sources.snapshots import page_records, page_schema
from tidemark.sources.state import StateStore


def above_mark(df: DataFrame, column: str, mark: Column | datetime | None) -> DataFrame:
    """Rows newer than the stored mark; all rows when there is none. The comparison reaches the scan."""
    if mark is None:
        return df
    return df.filter(F.col(column) > (mark if isinstance(mark, Column) else F.lit(mark)))


def next_mark(df: DataFrame, column: str) -> DataFrame:
    """One row with the mark to store after ``df`` was processed."""
    return df.agg(F.max(column).alias("mark"))


def incremental_batch(
    df: DataFrame, column: str, mark: Column | datetime | None, keys: list[str]
) -> DataFrame:
    """The unprocessed rows, one per key, the latest of each."""
    return dedup_latest(above_mark(df, column, mark), keys, [column])


def unprocessed(df: DataFrame, ledger: DataFrame, path_col: str = "source_path") -> DataFrame:
    """Rows of files the ledger does not list yet. The ledger is one row per file, small next to the rows."""
    return df.join(ledger.select(path_col).distinct(), path_col, "left_anti")


def ledger_entries(df: DataFrame, run: str, path_col: str = "source_path") -> DataFrame:
    """Ledger lines for the files just processed."""
    return df.select(path_col).distinct().withColumn("run", F.lit(run))


def transaction_pages(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """Stream of raw transactions from JSON pages that keep arriving in ``folder``."""
    raw = (
        spark.readStream.schema(page_schema(RAW["transactions"]))
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.json")
        .option("maxFilesPerTrigger", max_files)
        .json(folder)
    )
    return page_records(raw, RAW["transactions"])


def drop_late_repeats(flat: DataFrame, delay: str = "2 days") -> DataFrame:
    """First copy of each transaction; its id is remembered only as long as repeats may still arrive."""
    timed = flat.withColumn("_event_time", F.col("updated_time").try_cast("timestamp"))
    return (
        timed.withWatermark("_event_time", delay)
        .dropDuplicatesWithinWatermark(["transaction_id", "updated_time"])
        .drop("_event_time")
    )


def stream_transactions(
    spark: SparkSession,
    folder: str,
    cards: DataFrame,
    budgets: DataFrame,
    rates: DataFrame,
    store: StateStore,
    checkpoint: str,
    sync_time: datetime,
    max_files: int = 1000,
) -> None:
    """Process everything that arrived since the last call, then stop.

    The checkpoint is the ledger of processed files. Every micro-batch runs the same delta and merge as a day's
    sync, and a batch that is repeated after a failure finds nothing new, so it is applied once in effect.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        transactions.apply(
            transactions.extract_transactions(batch), cards, budgets, rates, f"stream-{batch_id}", store, sync_time
        )

    query = (
        transaction_pages(spark, folder, max_files)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

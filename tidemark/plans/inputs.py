"""Raw inputs of a day's run: parsed once, with what could not be used set apart."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import quality as Q
from tidemark.schemas import CORRUPT, MISTYPED, RAW, unreadable
from tidemark.scratch import materialize, measured
from tidemark.sources.snapshots import listing, read_entity
from tidemark.sources.state import StateStore


LEDGER = "files"
_IDENTITY = ["source_path", "length", "modified"]


def unread(spark, root: str, day: str, entity: str, store: StateStore) -> tuple[DataFrame, list[str]]:
    """The files of a folder as a table, and the paths of those that no run has recorded as they are now.

    Only names, sizes and times are compared, before anything is read; a file that was written again counts as a new one.
    """
    files = materialize(listing(spark, root, day, entity).coalesce(1), "listing")
    known = store.records_or_none(LEDGER)
    fresh = files if known is None else files.join(known.select(*_IDENTITY).distinct(), _IDENTITY, "left_anti")
    return files, [row.source_path for row in fresh.select("source_path").collect()]


class Inputs:
    """The folders of a run: which files are new, and the ledger lines to keep once the run is committed."""

    def __init__(self, spark, root: str, day: str, store: StateStore, entities: Sequence[str]):
        self._store, self._day = store, day
        found = {entity: unread(spark, root, day, entity, store) for entity in entities}
        self._files = {entity: files for entity, (files, _) in found.items()}
        self.fresh = {entity: paths for entity, (_, paths) in found.items()}

    @property
    def any_new(self) -> bool:
        return any(self.fresh.values())

    def done(self) -> None:
        """After the commit: a run that fails before it reads its files again."""
        for entity, files in self._files.items():
            self._store.record(LEDGER, self._day, entity, files)


def load(spark, root: str, day: str, entity: str) -> DataFrame:
    """The day's raw records of one entity, written once so that their files are parsed a single time."""
    return materialize(read_entity(spark, root, day, entity, RAW[entity]), entity)


def tag_side(raw: DataFrame) -> DataFrame:
    """Records of a supporting entity (details, roles, cards, budgets), tagged when unreadable or without id."""
    return Q.tag_faults(
        raw, [Q.Rule("corrupt_record", unreadable()), Q.missing("id", F.col("id").cast("string"))]
    )


def unusable(raw: DataFrame, entity: str) -> DataFrame:
    """Quarantine lines of a supporting entity: its bad records, and its files with a mistyped field."""
    return Q.quarantine_record(Q.bad_rows(tag_side(raw)), entity).unionByName(mistyped_files(raw, entity))


def mistyped_files(records: DataFrame, entity: str) -> DataFrame:
    """One quarantine line per file in which a field had to be read as null because of its type."""
    files = records.filter(F.col(CORRUPT) == MISTYPED).select("source_path").distinct()
    return Q.quarantine_record(files.withColumn(Q.REASONS, F.array(F.lit("mistyped_field"))), entity)


@dataclass(frozen=True)
class Stage:
    """Tagged rows, written once, with the counts taken in the same job."""

    name: str
    tagged: DataFrame
    rows_in: int
    rows_failed: int

    @property
    def rows_ok(self) -> int:
        return self.rows_in - self.rows_failed

    @property
    def good(self) -> DataFrame:
        return Q.good_rows(self.tagged)

    @property
    def bad(self) -> DataFrame:
        return Q.bad_rows(self.tagged)


def stage(tagged: DataFrame, name: str) -> Stage:
    written, seen = measured(tagged, name, failed=F.count_if(F.size(Q.REASONS) > 0))
    return Stage(name, written, seen["rows"], seen["failed"])


@dataclass(frozen=True)
class Balance:
    """What became of the rows that entered a stage: all of them were kept, failed, or skipped for a reason."""

    stage: str
    rows_in: int
    rows_ok: int
    rows_failed: int = 0
    rows_skipped: int = 0
    skipped_as: str = ""

    @classmethod
    def of(cls, stage: Stage) -> Balance:
        return cls(stage.name, stage.rows_in, stage.rows_ok, stage.rows_failed)

    @classmethod
    def repeats(cls, before: Stage, distinct: int) -> Balance:
        """One row of each key goes on."""
        return cls("unique", before.rows_ok, distinct, rows_skipped=before.rows_ok - distinct, skipped_as="repeats of an id")


def balance(spark, *stages: Balance) -> DataFrame:
    """One row per stage, in order; ``rows_in = rows_ok + rows_failed + rows_skipped``, and the next stage's ``rows_in`` is ``rows_ok``."""
    lines = [(k, s.stage, s.rows_in, s.rows_ok, s.rows_failed, s.rows_skipped, s.skipped_as) for k, s in enumerate(stages)]
    shape = "step int, stage string, rows_in bigint, rows_ok bigint, rows_failed bigint, rows_skipped bigint, skipped_as string"
    return spark.createDataFrame(lines, shape).coalesce(1)


def metrics(spark, *stages: Stage) -> DataFrame:
    """Rows seen, kept and failed per stage."""
    lines = [(s.name, s.rows_in, s.rows_ok, s.rows_failed) for s in stages]
    return spark.createDataFrame(lines, "stage string, rows_in bigint, rows_ok bigint, rows_failed bigint").coalesce(1)

"""Row rules, quarantine, integrity reports and run metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import required_text

REASONS = "reasons"


@dataclass(frozen=True)
class Rule:
    """A fault: ``reason`` is recorded for each row where ``fault`` is true or cannot be decided."""

    reason: str
    fault: Column

    def tag(self) -> Column:
        return F.when(F.coalesce(self.fault, F.lit(True)), F.lit(self.reason))


def missing(name: str, column: Column | None = None) -> Rule:
    return Rule(f"missing_{name}", ~required_text(F.col(name) if column is None else column))


def self_loop(key: str, parent: str) -> Rule:
    """A row that is its own parent; having no parent is fine."""
    return Rule("self_parent", F.coalesce(F.col(key) == F.col(parent), F.lit(False)))


def not_listed(name: str, allowed: Sequence[str]) -> Rule:
    return Rule(f"unknown_{name}", ~is_listed(name, allowed))


def is_listed(name: str, allowed: Sequence[str]) -> Column:
    """Membership in a fixed list of texts, which Spark tests as one hash set; null for a missing value."""
    quoted = ", ".join("'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'" for text in allowed)
    return F.expr(f"`{name}` IN ({quoted})")


def digits_only(name: Column) -> Column:
    """True for a text of digits only; false for a missing one, which is no numeric name."""
    return F.coalesce(name.rlike(r"^\d+$"), F.lit(False))


def tag_faults(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rows, each with the array of the reasons it fails; empty for a good row."""
    return df.withColumn(REASONS, F.array_compact(F.array(*[rule.tag() for rule in rules])))


def good_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.size(REASONS) == 0).drop(REASONS)


def bad_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.size(REASONS) > 0)


def validate(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their reasons; together they are the input, nothing is dropped."""
    tagged = tag_faults(df, rules)
    return good_rows(tagged), bad_rows(tagged)


def quarantine_record(bad: DataFrame, entity: str) -> DataFrame:
    """Bad rows of any entity in one shape: where from, why, and the row itself as JSON."""
    payload = [c for c in bad.columns if c != REASONS]
    return bad.select(
        F.lit(entity).alias("source_entity"), F.col(REASONS), F.to_json(F.struct(*payload)).alias("record")
    )


def orphans(links: DataFrame, referenced: DataFrame, on: dict[str, str]) -> DataFrame:
    """Links that point at nothing: rows of ``links`` whose key is not in ``referenced`` (null keys included)."""
    keys = referenced.select(*[F.col(target).alias(source) for source, target in on.items()]).distinct()
    return links.join(keys, list(on), "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once and how often; empty for a sound table."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def stage_metrics(tagged: DataFrame, stage: str) -> DataFrame:
    """Rows seen, kept and failed in one pass over tagged rows."""
    failed = F.count_if(F.size(REASONS) > 0)
    return tagged.agg(
        F.count("*").alias("rows_in"), failed.alias("rows_failed")
    ).select(
        F.lit(stage).alias("stage"), "rows_in", (F.col("rows_in") - F.col("rows_failed")).alias("rows_ok"),
        "rows_failed",
    )


def reason_counts(tagged: DataFrame) -> DataFrame:
    return tagged.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


def status_summary(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("rows"))


@dataclass(frozen=True)
class Reference:
    """A column of one table whose values should be keys of another."""

    child: str
    column: str
    parent: str
    key: str

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column} -> {self.parent}.{self.key}"


def check_references(frames: Mapping[str, DataFrame], references: Sequence[Reference]) -> DataFrame:
    """Per reference: rows, rows without a value, rows that point at nothing, and how many keys those have.

    All references are tested in one aggregation over tagged keys. It combines before the shuffle, so a key that very many rows point
    at is a few rows there; nothing is joined.
    """
    tagged = []
    for reference in references:
        tag = F.lit(reference.name).alias("reference")
        pointing = frames[reference.child].select(tag, F.col(reference.column).cast("string").alias("_key"), F.lit(1).alias("_rows"), F.lit(0).alias("_known"))
        known = frames[reference.parent].select(tag, F.col(reference.key).cast("string").alias("_key"), F.lit(0).alias("_rows"), F.lit(1).alias("_known"))
        tagged += [pointing, known.filter(F.col("_key").isNotNull())]
    keyed = reduce(DataFrame.unionByName, tagged).groupBy("reference", "_key").agg(F.sum("_rows").alias("n"), F.max("_known").alias("known"))
    lost = F.col("_key").isNotNull() & (F.col("known") == 0) & (F.col("n") > 0)
    return keyed.groupBy("reference").agg(
        F.sum("n").alias("row_count"), F.sum(F.when(F.col("_key").isNull(), F.col("n")).otherwise(0)).alias("null_rows"),
        F.sum(F.when(lost, F.col("n")).otherwise(0)).alias("orphan_rows"), F.count_if(lost).alias("orphan_keys"),
    )

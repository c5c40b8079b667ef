"""Keyed reconciliation of a new snapshot with stored rows: survivors, full outer merge, delta, child sync."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

ACTIVE, INACTIVE = "active", "inactive"
_IN_NEW, _IN_OLD = "_in_new", "_in_old"


def dedup_latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the largest ``newest`` columns, ties settled by the other columns.

    Spark turns ``row_number() = 1`` into a limit per key that already runs before the shuffle, so a key that
    holds a third of all rows leaves each map task as a single row.
    """
    rest = [c for c in df.columns if c not in {*keys, *newest}]
    order = [F.col(f"`{c}`").desc_nulls_last() for c in newest] + [F.col(f"`{c}`").asc_nulls_first() for c in rest]
    window = Window.partitionBy(*keys).orderBy(*order or [F.col(f"`{k}`") for k in keys])
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def _paired(new: DataFrame, old: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Both sides side by side as ``new.*`` and ``old.*`` with a presence mark each."""
    left = new.withColumn(_IN_NEW, F.lit(True)).alias("new")
    right = old.withColumn(_IN_OLD, F.lit(True)).alias("old")
    matched = [F.col(f"new.{k}") == F.col(f"old.{k}") for k in keys]
    return left.join(right, matched, how)


def reconcile_snapshot(
    new: DataFrame,
    old: DataFrame,
    keys: Sequence[str],
    coalesce_cols: Sequence[str] = (),
    source_wins_cols: Sequence[str] = (),
    keep_cols: Sequence[str] = (),
    status: Column | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Every key of the snapshot and of the stored rows, once, with its status.

    A key the snapshot has is ``status`` (an expression over ``new.*``; active by default), a key it lacks is
    inactive. ``coalesce_cols`` take the new value and fall back to the stored one, ``source_wins_cols`` take
    the new value even where it is null, ``keep_cols`` keep the stored value of a key that was stored.
    Keys must be unique on both sides.
    """
    in_new, in_old = F.col(_IN_NEW).isNotNull(), F.col(_IN_OLD).isNotNull()
    columns = [F.coalesce(F.col(f"new.{k}"), F.col(f"old.{k}")).alias(k) for k in keys]
    columns += [F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c) for c in coalesce_cols]
    columns += [F.when(in_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in source_wins_cols]
    columns += [F.when(in_old, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c) for c in keep_cols]
    present = F.lit(ACTIVE) if status is None else status
    columns.append(F.when(in_new, present).otherwise(F.lit(INACTIVE)).alias("status"))
    columns += [expression.alias(name) for name, expression in (extra or {}).items()]
    return _paired(new, old, keys, "full_outer").select(*columns)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The target after an upsert: matched rows take ``update_cols``, unmatched source rows are inserted.

    An inserted row gets ``defaults`` where the source has no value. ``source`` must be unique by key.
    """
    defaults = defaults or {}
    in_new, in_old = F.col(_IN_NEW).isNotNull(), F.col(_IN_OLD).isNotNull()
    names = source.columns

    def column(name: str) -> Column:
        stored = F.col(f"old.{name}")
        if name in keys:
            return F.coalesce(F.col(f"new.{name}"), stored)
        kind = target.schema[name].dataType
        incoming = F.col(f"new.{name}").cast(kind) if name in names else F.lit(None).cast(kind)
        inserted = F.coalesce(incoming, defaults[name].cast(kind)) if name in defaults else incoming
        if name in update_cols:
            return F.when(in_new & in_old, incoming).when(in_new, inserted).otherwise(stored)
        return F.when(in_old, stored).otherwise(inserted)

    return _paired(source, target, keys, "full_outer").select(*[column(c).alias(c) for c in target.columns])


def replace_children(
    links: DataFrame, batch: DataFrame, parent_key: str, parents: DataFrame | None = None
) -> DataFrame:
    """Stored links after a sync: those of the synced parents are replaced by the batch's.

    ``parents`` lists all synced parents, so that one that lost its last child is cleared as well; without it
    only parents that appear in ``batch`` are touched. The anti join keeps the stored links on its splittable
    side, so a parent that holds a large share of them is spread over many tasks.
    """
    synced = (batch if parents is None else parents).select(parent_key).distinct()
    return links.join(synced, parent_key, "left_anti").unionByName(batch.select(*links.columns))


def delta_detect(
    incoming: DataFrame, stored: DataFrame, keys: Sequence[str], compare_cols: Sequence[str]
) -> DataFrame:
    """Incoming rows that are new or differ from the stored row in one of ``compare_cols`` (null-safe)."""
    known = stored.select(*keys, *compare_cols)
    changed = F.col(_IN_OLD).isNull()
    for name in compare_cols:
        kind = stored.schema[name].dataType
        changed = changed | ~F.col(f"new.{name}").cast(kind).eqNullSafe(F.col(f"old.{name}"))
    return _paired(incoming, known, keys, "left").filter(changed).select(
        *[F.col(f"new.{c}") for c in incoming.columns]
    )


#: What an incoming row is to the stored one, see ``classify_delta``.
OUTCOME, NEW, CHANGED, NEWER, SAME, LATE = "outcome", "new", "changed", "newer", "same", "late"


def classify_delta(
    incoming: DataFrame, stored: DataFrame, keys: Sequence[str], compare_cols: Sequence[str], moment: str | None = None
) -> DataFrame:
    """Every incoming row with its ``outcome``, from one join with the stored keys.

    ``late``: the stored row is from a later ``moment``, so this one must not overwrite it, whatever order files arrive in.
    ``changed``: differs in one of ``compare_cols`` (null-safe). ``newer``: equal there, but from a later moment, which has to be
    remembered, else a row from between would pass for the latest. ``same``: nothing to do. Rows without a moment are never late.
    """
    known = stored.select(*keys, *compare_cols, *([moment] if moment else []))
    differs = F.lit(False)
    for name in compare_cols:
        kind = stored.schema[name].dataType
        differs = differs | ~F.col(f"new.{name}").cast(kind).eqNullSafe(F.col(f"old.{name}"))
    outcome = F.when(F.col(_IN_OLD).isNull(), F.lit(NEW))
    if moment:
        outcome = outcome.when(F.col(f"new.{moment}") < F.col(f"old.{moment}"), F.lit(LATE))
    outcome = outcome.when(differs, F.lit(CHANGED))
    if moment:
        later = F.col(f"new.{moment}").isNotNull() & (F.col(f"old.{moment}").isNull() | (F.col(f"new.{moment}") > F.col(f"old.{moment}")))
        outcome = outcome.when(later, F.lit(NEWER))
    return _paired(incoming, known, keys, "left").select(
        *[F.col(f"new.{c}") for c in incoming.columns], outcome.otherwise(F.lit(SAME)).alias(OUTCOME)
    )


def left_enrich(index: DataFrame, details: DataFrame, key: str, newest: Sequence[str] = ()) -> DataFrame:
    """Index rows with the details record of the same key as struct ``det``, null where there is none."""
    unique = dedup_latest(details, [key], newest)
    packed = unique.select(F.col(key), F.struct(*[c for c in unique.columns if c != key]).alias("det"))
    return index.join(packed, key, "left")

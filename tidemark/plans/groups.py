"""Groups of a day: validate, members and their status, activity up the hierarchy, reconcile."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import member_ids_by_row, optional_col, safe_id, safe_timestamp
from tidemark.operators import links as L
from tidemark.operators import quality as Q
from tidemark.operators.activity import direct_counts, status_of, update_activity
from tidemark.operators.hierarchy import group_activity
from tidemark.operators.reconcile import dedup_latest, reconcile_snapshot, replace_children
from tidemark.plans.inputs import Balance, Inputs, balance, metrics, mistyped_files, stage
from tidemark.schemas import CORRUPT, COUNTS, RAW, unreadable
from tidemark.scratch import counted, materialize
from tidemark.sources.snapshots import read_entity, union_fill
from tidemark.sources.state import StateStore


@dataclass(frozen=True)
class GroupSync:
    groups: DataFrame
    members: DataFrame
    group_members: DataFrame
    counts: DataFrame | None = None
    distinct_groups: int = 0


def clean_groups(raw: DataFrame) -> DataFrame:
    """Typed groups with their member ids, tagged with their faults."""
    found, broken = member_ids_by_row(raw)
    typed = raw.select(
        optional_col(raw, "id").alias("raw_id"),
        safe_id(F.col("id").cast("string")).alias("group_id"),
        optional_col(raw, "name").alias("group_name"),
        optional_col(raw, "description"),
        safe_id(optional_col(raw, "parent_group_id")).alias("parent_group_id"),
        safe_timestamp(optional_col(raw, "created_at")).alias("created_at"),
        safe_timestamp(optional_col(raw, "updated_at")).alias("updated_at"),
        found.alias("user_ids"),
        broken.alias("_broken"),
        optional_col(raw, CORRUPT).alias(CORRUPT),
        optional_col(raw, "source_path").alias("source_path"),
    )
    return Q.tag_faults(
        typed,
        [
            Q.Rule("corrupt_record", unreadable()),
            Q.Rule("bad_key", F.col("group_id").isNull()),
            Q.missing("group_name"),
            Q.self_loop("group_id", "parent_group_id"),
            # A record whose members can't be read would clear the stored ones; it waits in quarantine instead.
            Q.Rule("bad_members", F.col("_broken")),
        ],
    ).drop("_broken")


def build_groups(
    good: DataFrame,
    users: DataFrame,
    stored_groups: DataFrame,
    stored_members: DataFrame,
    include_stored: bool = False,
    clear_empty_parents: bool = True,
    method: str = "doubling",
    stored_counts: DataFrame | None = None,
) -> GroupSync:
    """The day's groups with their status, and all memberships, from valid groups and what is stored.

    With ``include_stored`` activity also travels through stored groups that the day's dump lacks. With ``stored_counts``, the
    activity counts of the last day, only what stands above a change is counted anew; else activity is spread over the whole forest.
    """
    # Both feed several outputs and the activity loop; written once, they are shuffled once.
    unique, distinct_groups = counted(
        dedup_latest(good.drop("raw_id", CORRUPT, "source_path"), ["group_id"], ["updated_at"]), "groups"
    )
    members = materialize(L.member_status(L.explode_members(unique), users), "members")
    forest = unique.select("group_id", "parent_group_id")
    if include_stored:
        gone = stored_groups.join(unique.select("group_id"), "group_id", "left_anti")
        forest = forest.unionByName(gone.select("group_id", "parent_group_id"))
    counts = None
    if stored_counts is None:
        status = group_activity(forest, L.direct_activity(members), method)
    else:
        counts = materialize(update_activity(stored_counts, materialize(forest, "forest"), direct_counts(members))[0], "counts")
        status = status_of(counts)
    status = status.withColumnRenamed("status", "derived")
    # Written, the snapshot has no layout of its own, so the merge adopts the buckets of what is stored.
    fresh = materialize(unique.drop("user_ids").join(status, "group_id", "left"), "groups")
    groups = reconcile_snapshot(
        fresh,
        stored_groups,
        ["group_id"],
        coalesce_cols=["group_name", "description", "updated_at"],
        source_wins_cols=["parent_group_id"],
        keep_cols=["created_at"],
        status=F.col("new.derived"),
    )
    return GroupSync(
        groups,
        members,
        replace_children(stored_members, members, "group_id", unique if clear_empty_parents else None),
        counts,
        distinct_groups,
    )


def run(spark, root: str, day: str, store: StateStore, only_new: bool = False, **options) -> int:
    """Sync one day's groups; needs the day's users to be committed, for the members' status.

    A store made with ``COUNTED_TABLES`` keeps activity counts, and then only what stands above a change is counted anew.
    With ``only_new`` nothing is read where the ledger has all files as they are; the index of users counts as one of the inputs,
    because activity follows it.
    """
    inputs = Inputs(spark, root, day, store, ("admin_groups",))
    if only_new and not inputs.any_new and not options.pop("users_changed", False):
        return store.version
    options.pop("users_changed", None)
    version = _run(spark, root, day, store, **options)
    inputs.done()
    return version


def _run(spark, root: str, day: str, store: StateStore, **options) -> int:
    raw = read_entity(spark, root, day, "admin_groups", RAW["admin_groups"])
    checked = stage(clean_groups(raw), "groups")
    faults = union_fill([Q.quarantine_record(checked.bad, "groups"), mistyped_files(checked.tagged, "groups")])
    store.record("quarantine", day, "groups", faults)
    store.record("metrics", day, "groups", metrics(spark, checked))
    if not checked.rows_in:
        store.record("balance", day, "groups", balance(spark, Balance.of(checked)))
        return store.version
    if COUNTS in store.tables:
        options["stored_counts"] = store.read(COUNTS)
    sync = build_groups(
        checked.good, store.read("users"), store.read("groups"), store.read("group_members"), **options
    )
    store.record("balance", day, "groups", balance(spark, Balance.of(checked), Balance.repeats(checked, sync.distinct_groups)))
    frames = {"groups": sync.groups, "group_members": sync.group_members}
    if sync.counts is not None:
        frames[COUNTS] = sync.counts
    return store.commit(frames, laid_out={"groups"} if store.aligned("groups") else set())

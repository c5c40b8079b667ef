"""Users of a day: resolve, validate, reconcile, and their roles and role links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import (
    composite_name,
    first_non_null,
    has_field,
    optional_col,
    safe_id,
    safe_timestamp,
)
from tidemark.operators import links as L
from tidemark.operators import quality as Q
from tidemark.operators.reconcile import (
    dedup_latest,
    left_enrich,
    merge_upsert,
    reconcile_snapshot,
    replace_children,
)
from tidemark.plans.inputs import Balance, Inputs, balance, load, metrics, mistyped_files, stage, unusable
from tidemark.schemas import CORRUPT, RAW, TABLES, conform, unreadable
from tidemark.scratch import counted, materialize, measured
from tidemark.sources.snapshots import read_entity, union_fill
from tidemark.sources.state import StateStore

# What a user without a name or an address is called.
UNKNOWN_NAME = "Unknown Name"
PLACEHOLDER_EMAIL = "no-email@placeholder.com"


@dataclass(frozen=True)
class UserSync:
    users: DataFrame
    roles: DataFrame
    user_roles: DataFrame
    distinct_users: int = 0


@dataclass(frozen=True)
class IndexFacts:
    """Whether any record of an index has a name or an address of its own (not in its contact)."""

    named: bool
    addressed: bool


def _own_name(index: DataFrame) -> Column:
    """A record's own name: ``name``, else what there is of first and last name."""
    parts = [optional_col(index, "first_name"), optional_col(index, "last_name")]
    composed = F.when(F.coalesce(*parts).isNotNull(), composite_name(*parts))
    return F.coalesce(optional_col(index, "name"), composed)


def _own_email(index: DataFrame) -> Column:
    return optional_col(index, "email")


def with_facts(index: DataFrame) -> tuple[DataFrame, IndexFacts]:
    """The index, written once, and what it has as a whole, taken in the same job."""
    written, seen = measured(
        index, "agents", named=F.bool_or(_own_name(index).isNotNull()), addressed=F.bool_or(_own_email(index).isNotNull())
    )
    return written, IndexFacts(bool(seen["named"]), bool(seen["addressed"]))


def _placeholder(index: DataFrame, fields: tuple[str, ...], own: Column, text: str) -> tuple[Column, Column | None]:
    """What stands in where a record has nothing, and the fact about the whole index that it waits for, if any.

    Where the frame has no such field, it is the placeholder. Where it has one, records without a value are faults, unless
    no record has a value there and the index keeps its values in contacts.
    """
    if not any(has_field(index, name) for name in fields):
        return F.lit(text), None
    if not has_field(index, "contact"):
        return F.lit(None).cast("string"), None
    return F.lit(text), F.bool_or(own.isNotNull()) | ~F.bool_or(F.col("contact").isNotNull())


def resolve_users(index: DataFrame, details: DataFrame, facts: IndexFacts | None = None) -> DataFrame:
    """One row per index record, each value from the first place that has it for this record.

    A name: the details record, the record's ``name``, its first and last name, its contact. An address likewise. Only
    whether a record without any gets a placeholder depends on the index as a whole: where some record has a name of its own,
    one without is a fault. ``facts`` are those of the whole index; without them they are taken here, as one row.
    """
    det = conform(details, RAW["agent_details"]).filter(F.col("id").isNotNull())
    own_name, own_email = _own_name(index), _own_email(index)
    if facts is not None:
        name_else = F.lit(None if facts.named else UNKNOWN_NAME).cast("string")
        email_else = F.lit(None if facts.addressed else PLACEHOLDER_EMAIL).cast("string")
    else:
        name_else, named = _placeholder(index, ("name", "first_name", "last_name"), own_name, UNKNOWN_NAME)
        email_else, addressed = _placeholder(index, ("email",), own_email, PLACEHOLDER_EMAIL)
        waiting = {f"_{k}": fact for k, fact in (("named", named), ("addressed", addressed)) if fact is not None}
        if waiting:
            # One row whatever the index.
            whole = index.agg(*[F.coalesce(fact, F.lit(False)).alias(name) for name, fact in waiting.items()])
            index = index.join(F.broadcast(whole))
            name_else = F.when(~F.col("_named"), name_else) if "_named" in waiting else name_else
            email_else = F.when(~F.col("_addressed"), email_else) if "_addressed" in waiting else email_else
    joined = left_enrich(
        index.withColumn("id", F.col("id").cast("string")),
        det.withColumn("moment", safe_timestamp(F.col("updated_at"))), "id", ["moment", "updated_at"],
    )
    return joined.select(
        F.col("id").alias("raw_id"),
        first_non_null(F.col("det.contact.name"), own_name, optional_col(index, "contact.name"), name_else).alias("user_name"),
        first_non_null(F.col("det.contact.email"), own_email, optional_col(index, "contact.email"), email_else).alias("user_email"),
        F.coalesce("det.created_at", optional_col(index, "created_at")).alias("created_at"),
        F.coalesce("det.updated_at", optional_col(index, "updated_at")).alias("updated_at"),
        F.col("det.group_ids").alias("raw_group_ids"),
        F.col("det.role_ids").alias("role_ids"),
        optional_col(index, CORRUPT).alias(CORRUPT),
        optional_col(index, "source_path").alias("source_path"),
    )


def clean_users(resolved: DataFrame) -> DataFrame:
    """Typed users tagged with their faults."""
    typed = resolved.select(
        "*", safe_id(F.col("raw_id")).alias("user_id")
    ).withColumns({c: safe_timestamp(F.col(c)) for c in ("created_at", "updated_at")})
    return Q.tag_faults(
        typed,
        [
            Q.Rule("corrupt_record", unreadable()),
            Q.Rule("bad_key", F.col("user_id").isNull()),
            Q.missing("user_name"),
            Q.missing("user_email"),
        ],
    )


def role_dimension(roles: DataFrame) -> DataFrame:
    return roles.select(
        F.col("id").cast("string").alias("role_id"),
        optional_col(roles, "name").alias("role_name"),
        optional_col(roles, "description").alias("role_desc"),
    ).filter(F.col("role_id").isNotNull())


def build_users(
    good: DataFrame,
    roles: DataFrame,
    stored_users: DataFrame,
    stored_links: DataFrame,
    keep_unnamed_roles: bool = True,
    clear_empty_parents: bool = True,
) -> UserSync:
    """The day's users, the roles in use and all links, from valid users and what is stored."""
    # Written, the snapshot has no layout of its own, so the merge adopts the buckets of what is stored.
    columns = ["user_id", "user_name", "user_email", "created_at", "updated_at"]
    unique, distinct_users = counted(dedup_latest(good.select(*columns), ["user_id"], ["updated_at"]), "users")
    users = reconcile_snapshot(
        unique,
        stored_users,
        ["user_id"],
        coalesce_cols=["user_name", "user_email", "updated_at"],
        keep_cols=["created_at"],
    )
    # Links come straight from the role arrays: users never have to be folded back from their exploded form.
    exploded = good.select("user_id", F.explode(F.array_distinct("role_ids")).alias("role_id"))
    named = L.named_links(exploded, role_dimension(roles))
    batch_links = L.distinct_links(named, keep_unnamed_roles)
    return UserSync(
        users,
        L.distinct_roles(named.filter(F.col("role_name").isNotNull()), keep_unnamed_roles),
        replace_children(stored_links, batch_links, "user_id", good if clear_empty_parents else None),
        distinct_users,
    )


def run(spark, root: str, day: str, store: StateStore, only_new: bool = False, **options) -> int:
    """Sync one day's users into the store; returns the version that holds them.

    With ``only_new`` nothing is read where the ledger has all files as they are: an index is a whole, so one new file calls for all.
    """
    inputs = Inputs(spark, root, day, store, ("agents", "agent_details", "roles"))
    if only_new and not inputs.any_new:
        return store.version
    version = _run(spark, root, day, store, **options)
    inputs.done()
    return version


def _run(spark, root: str, day: str, store: StateStore, **options) -> int:
    index, facts = with_facts(read_entity(spark, root, day, "agents", RAW["agents"]))
    details, roles = load(spark, root, day, "agent_details"), load(spark, root, day, "roles")
    # Written once: one join and one parse serve users, links, quarantine and metrics.
    checked = stage(clean_users(resolve_users(index, details, facts)), "users")
    faults = union_fill([
        Q.quarantine_record(checked.bad, "agents"),
        mistyped_files(checked.tagged, "agents"),
        unusable(details, "agent_details"),
        unusable(roles, "roles"),
    ])
    store.record("quarantine", day, "users", faults)
    store.record("metrics", day, "users", metrics(spark, checked))
    if not checked.rows_in:
        store.record("balance", day, "users", balance(spark, Balance.of(checked)))
        # No index at all is a failed delivery, not an empty company: nobody is marked inactive for it.
        return store.version
    sync = build_users(checked.good, roles, store.read("users"), store.read("user_roles"), **options)
    store.record("balance", day, "users", balance(spark, Balance.of(checked), Balance.repeats(checked, sync.distinct_users)))
    spec = TABLES["roles"]
    return store.commit(
        {
            "users": sync.users,
            "roles": merge_upsert(
                store.read("roles"), materialize(sync.roles, "roles"), spec.keys, spec.update_cols
            ),
            "user_roles": sync.user_roles,
        },
        laid_out={t for t in ("users", "roles") if store.aligned(t)},
    )

"""What a run leaves behind: references that lead nowhere, groups in circles, how many rows have which status."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.hierarchy import find_cycles, forest_edges
from tidemark.operators.quality import Reference, check_references, status_summary
from tidemark.sources.state import StateStore

#: Columns of the state that should be keys of another table of it.
REFERENCES = (
    Reference("user_roles", "user_id", "users", "user_id"),
    Reference("user_roles", "role_id", "roles", "role_id"),
    Reference("groups", "parent_group_id", "groups", "group_id"),
    Reference("group_members", "group_id", "groups", "group_id"),
    Reference("group_members", "user_id", "users", "user_id"),
    Reference("transactions", "card_id", "cards", "card_id"),
    Reference("transactions", "budget_id", "budgets", "budget_id"),
    Reference("transaction_cards", "transaction_id", "transactions", "transaction_id"),
    Reference("transaction_cards", "card_id", "cards", "card_id"),
    Reference("transaction_budgets", "transaction_id", "transactions", "transaction_id"),
    Reference("transaction_budgets", "budget_id", "budgets", "budget_id"),
)


def statuses(store: StateStore) -> DataFrame:
    """``table, status, rows`` of users, groups and memberships."""
    parts = [("users", "status"), ("groups", "status"), ("group_members", "user_status")]
    frames = [
        status_summary(store.read(table).withColumnRenamed(column, "status")).select(F.lit(table).alias("table"), "status", "rows")
        for table, column in parts
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def circles(store: StateStore) -> DataFrame:
    """``group_id`` of every group that is its own ancestor."""
    edges = forest_edges(store.read("groups"), "group_id", "parent_group_id")
    return find_cycles(edges).withColumnRenamed("node", "group_id")


def report(store: StateStore, day: str) -> None:
    """Record integrity, circles and statuses of the committed state under the day; a rerun replaces its own records."""
    frames = {name: store.read(name) for name in store.tables}
    store.record("integrity", day, "run", check_references(frames, REFERENCES).coalesce(1))
    store.record("cycles", day, "run", circles(store))
    store.record("statuses", day, "run", statuses(store).coalesce(1))

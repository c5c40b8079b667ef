"""Fact, referenced dimensions and junctions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.operators.reconcile import dedup_latest
from tidemark.scratch import materialize


@dataclass(frozen=True)
class Star:
    cards: DataFrame
    budgets: DataFrame
    transaction_cards: DataFrame
    transaction_budgets: DataFrame


def referenced_dimension(dimension: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Dimension rows the fact refers to, one per key."""
    used = fact.select(key).distinct()
    return dedup_latest(dimension.join(used, key, "left_semi"), [key])


def junction(fact: DataFrame, dimension: DataFrame, fact_key: str, key: str) -> DataFrame:
    """(fact key, dimension columns) for every fact row whose dimension row exists."""
    return fact.select(fact_key, key).join(dimension, key, "inner").select(fact_key, *dimension.columns)


def build_star(fact: DataFrame, cards: DataFrame, budgets: DataFrame) -> Star:
    """The four frames around a fact that is already written; each is written once and read by several merges."""
    card_dim = materialize(referenced_dimension(cards, fact, "card_id"), "cards")
    budget_dim = materialize(referenced_dimension(budgets, fact, "budget_id"), "budgets")
    return Star(
        card_dim,
        budget_dim,
        materialize(junction(fact, card_dim, "transaction_id", "card_id"), "transaction-cards"),
        materialize(junction(fact, budget_dim, "transaction_id", "budget_id"), "transaction-budgets"),
    )

"""Transactions of a day: extract, validate, find what is new or changed, convert, star, merge."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import day_of, minor_units, optional_col, safe_timestamp
from tidemark.functions.currencies import CURRENCY_CODES
from tidemark.operators import quality as Q
from tidemark.operators.fx import NO_RATE, convert_currency
from tidemark.operators.reconcile import CHANGED, LATE, NEW, NEWER, OUTCOME, classify_delta, dedup_latest, merge_upsert
from tidemark.operators.star import Star, build_star
from tidemark.plans.inputs import Balance, Inputs, Stage, balance, load, metrics, mistyped_files, stage, unusable
from tidemark.schemas import CORRUPT, RAW, TABLES, empty, unreadable
from tidemark.scratch import materialize, measured
from tidemark.sources.rates import rates_from_documents
from tidemark.sources.snapshots import read_entity, union_fill
from tidemark.sources.state import StateStore


def extract_transactions(raw: DataFrame) -> DataFrame:
    """Flat transactions: amount from minor units, the business day, ids; absent fields are null."""
    when = F.coalesce(optional_col(raw, "transactionDate"), optional_col(raw, "occurredTime"))
    return raw.select(
        optional_col(raw, "id").alias("transaction_id"),
        optional_col(raw, "transactionType").alias("transaction_type"),
        day_of(when).alias("transaction_date"),
        minor_units(
            optional_col(raw, "currencyData.originalCurrencyAmount"), optional_col(raw, "currencyData.exponent")
        ).alias("original_amount"),
        optional_col(raw, "currencyData.originalCurrencyCode").alias("currency_code"),
        optional_col(raw, "merchantName").alias("merchant_name"),
        optional_col(raw, "cardId").alias("card_id"),
        optional_col(raw, "budgetId").alias("budget_id"),
        optional_col(raw, "updatedTime").alias("updated_time"),
        optional_col(raw, CORRUPT).alias(CORRUPT),
        optional_col(raw, "source_path").alias("source_path"),
    )


def extract_cards(raw: DataFrame) -> DataFrame:
    return raw.select(
        optional_col(raw, "id").alias("card_id"),
        optional_col(raw, "name").alias("card_name"),
        optional_col(raw, "lastFour").alias("card_last_four"),
        optional_col(raw, "type").alias("card_type"),
        optional_col(raw, "status").alias("card_status"),
    )


def extract_budgets(raw: DataFrame) -> DataFrame:
    return raw.select(
        optional_col(raw, "id").alias("budget_id"),
        optional_col(raw, "name").alias("budget_name"),
        optional_col(raw, "description").alias("budget_description"),
    )


def clean_transactions(flat: DataFrame) -> DataFrame:
    """Tagged with faults; no amount, a negative one or one too large for money is a bad amount."""
    return Q.tag_faults(
        flat,
        [
            Q.Rule("corrupt_record", unreadable()),
            Q.missing("transaction_id"),
            Q.missing("card_id"),
            Q.missing("budget_id"),
            Q.Rule("bad_amount", F.col("original_amount") < 0),
            Q.not_listed("currency_code", CURRENCY_CODES),
            Q.Rule("bad_date", F.col("transaction_date").isNull()),
        ],
    )


def survivors(flat: DataFrame) -> DataFrame:
    """One row per transaction id, the latest by update time; rows without an id are all kept for quarantine.

    A null id groups nothing: those rows stay out of the per-key ranking, so they never meet in one task.
    """
    known = flat.filter(F.col("transaction_id").isNotNull())
    unknown = flat.filter(F.col("transaction_id").isNull())
    # By the moment, not by the text: offsets differ. The text only settles what is no time or the same time.
    known = known.withColumn("_moment", safe_timestamp(F.col("updated_time")))
    return dedup_latest(known, ["transaction_id"], ["_moment", "updated_time"]).drop("_moment").unionByName(unknown)


def convert(delta: DataFrame, rates: DataFrame, on_missing: str = "null") -> DataFrame:
    """Delta rows in dollars, tagged: a pair without a rate is a fault of its own."""
    converted = convert_currency(delta, rates, on_missing=on_missing)
    return Q.tag_faults(converted, [
        Q.Rule(NO_RATE, F.col("exchange_rate").isNull()),
        Q.Rule("bad_amount", F.col("exchange_rate").isNotNull() & F.col("amount_usd").isNull()),
    ])


def with_moments(stored: DataFrame, newer: DataFrame) -> DataFrame:
    """Stored transactions with the moments of ``newer(transaction_id, updated_at)``; their own buckets are kept.

    Nothing else of these rows changed, but their moment decides what is late from now on.
    """
    moments = newer.select("transaction_id", F.col("updated_at").alias("_moment"))
    joined = stored.join(moments, "transaction_id", "left").withColumn("updated_at", F.coalesce("_moment", "updated_at"))
    return joined.select(*stored.columns)


def merge_all(store: StateStore, fact: DataFrame, star: Star, sync_time: datetime, newer: DataFrame | None = None) -> dict[str, DataFrame]:
    """The five tables after the merge, each on its own key and with its own list of updated columns.

    Sources are written tables: they bring no layout of their own, so each merge adopts the buckets of what is
    stored and shuffles the delta only.
    """
    sources = {
        "cards": star.cards,
        "budgets": star.budgets,
        "transactions": fact,
        "transaction_cards": star.transaction_cards,
        "transaction_budgets": star.transaction_budgets,
    }
    created = {"transactions": {"created_at": F.lit(sync_time).cast("timestamp_ntz")}}
    stored = {name: store.read(name) for name in sources}
    if newer is not None:
        stored["transactions"] = with_moments(stored["transactions"], newer)
    return {
        name: merge_upsert(
            stored[name], source, TABLES[name].keys, TABLES[name].update_cols, created.get(name)
        )
        for name, source in sources.items()
    }


def run(
    spark,
    root: str,
    day: str,
    store: StateStore,
    sync_time: datetime,
    compare_cols: tuple[str, ...] = ("original_amount",),
    on_missing: str = "null",
    only_new: bool = False,
) -> int:
    """Sync one day's transactions; what is neither new nor changed is left alone.

    With ``only_new`` only files that the ledger doesn't have as they are now are read, and none at all if there is no such one.
    """
    inputs = Inputs(spark, root, day, store, ("transactions",))
    if only_new and not inputs.any_new:
        return store.version
    files = inputs.fresh["transactions"] if only_new else None
    flat = extract_transactions(read_entity(spark, root, day, "transactions", RAW["transactions"], files=files))
    cards, budgets = load(spark, root, day, "cards"), load(spark, root, day, "budgets")
    rates = rates_from_documents(read_entity(spark, root, day, "rates", RAW["rates"]))
    store.record(
        "quarantine", day, "dimensions", union_fill([unusable(cards, "cards"), unusable(budgets, "budgets")])
    )
    version = apply(
        flat, extract_cards(cards), extract_budgets(budgets), rates, day, store, sync_time, compare_cols, on_missing
    )
    inputs.done()
    return version


@dataclass(frozen=True)
class Prepared:
    """A dump on its way to the merge: checked rows, converted delta, rows of which only the moment is news, and what became of all."""

    checked: Stage
    converted: Stage
    newer: DataFrame
    newer_rows: int
    steps: tuple[Balance, ...]


def prepare(
    flat: DataFrame, stored: DataFrame, rates: DataFrame, compare_cols: tuple[str, ...] = ("original_amount",), on_missing: str = "null"
) -> Prepared:
    """Survivors, validation, delta and conversion, each written once; late rows and unchanged ones are counted as skipped."""
    # Written before it is split by key, so that the dump is parsed once.
    flat, extracted = measured(flat, "extracted")
    checked = stage(clean_transactions(survivors(flat)), "transactions")
    steps = [
        Balance("extracted", extracted["rows"], checked.rows_in, rows_skipped=extracted["rows"] - checked.rows_in, skipped_as="repeats of an id"),
        Balance.of(checked),
    ]
    timed = checked.good.withColumn("updated_at", safe_timestamp(F.col("updated_time"))).drop("updated_time", CORRUPT, "source_path")
    outcomes = classify_delta(timed, stored, ["transaction_id"], compare_cols, "updated_at")
    counts = {name: F.count_if(F.col(OUTCOME) == name) for name in (NEW, CHANGED, NEWER, LATE)}
    outcomes, seen = measured(outcomes, "outcomes", **counts)
    delta = outcomes.filter(F.col(OUTCOME).isin(NEW, CHANGED)).drop(OUTCOME)
    going = seen[NEW] + seen[CHANGED]
    steps.append(Balance("delta", checked.rows_ok, going, rows_skipped=checked.rows_ok - going, skipped_as=f"unchanged, {seen[LATE]} of them late"))
    # Pinned before anything is committed: fact, dimensions and junctions all see the same delta.
    converted = stage(convert(delta, rates, on_missing), "conversion")
    steps.append(Balance.of(converted))
    newer = outcomes.filter(F.col(OUTCOME) == NEWER).select("transaction_id", "updated_at")
    return Prepared(checked, converted, newer, seen[NEWER], tuple(steps))


def apply(
    flat: DataFrame,
    cards: DataFrame,
    budgets: DataFrame,
    rates: DataFrame,
    label: str,
    store: StateStore,
    sync_time: datetime,
    compare_cols: tuple[str, ...] = ("original_amount",),
    on_missing: str = "null",
) -> int:
    """The same for frames already at hand, as a streaming batch has them; ``label`` names the run's records."""
    spark = flat.sparkSession
    prepared = prepare(flat, store.read("transactions"), rates, compare_cols, on_missing)
    checked, converted = prepared.checked, prepared.converted
    faults = union_fill([
        Q.quarantine_record(checked.bad, "transactions"),
        Q.quarantine_record(converted.bad, "transactions"),
        mistyped_files(checked.tagged, "transactions"),
    ])
    store.record("quarantine", label, "transactions", faults)
    store.record("metrics", label, "transactions", metrics(spark, checked, converted))
    store.record("balance", label, "transactions", balance(spark, *prepared.steps))
    if not converted.rows_ok and not prepared.newer_rows:
        return store.version
    fact = converted.good
    star = build_star(fact, cards, budgets)
    newer = materialize(prepared.newer, "newer") if prepared.newer_rows else None
    frames = merge_all(store, fact, star, sync_time, newer)
    return store.commit(frames, laid_out={name for name in frames if store.aligned(name)})


def no_rates(spark) -> DataFrame:
    """An empty rates table: only dollars can be converted."""
    return rates_from_documents(empty(spark, RAW["rates"]))

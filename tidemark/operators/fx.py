"""Conversion of money to dollars with the rate of the day."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import MONEY, WHOLE, rounded_quotient

NO_RATE = "no_rate"
#: Units of a currency for one dollar, as a document states them.
UNITS = T.DecimalType(28, 18)


def exact_quotient(amount: Column, units: Column) -> Column:
    """``amount / units`` as money, rounded once, half away from zero; null where it doesn't fit or the units aren't positive.

    In whole numbers: cents times ``10 ** 18`` over the units times ``10 ** 18``.
    """
    one = F.lit(Decimal(10**18))
    cents = ((F.abs(amount) * 100).cast(WHOLE) * one).cast(WHOLE)
    money = (rounded_quotient(cents, (units.cast(UNITS) * one).cast(T.DecimalType(29, 0))) * F.lit(Decimal("0.01"))).try_cast(MONEY)
    return F.when(units > 0, F.when(amount < 0, -money).otherwise(money))


def pairs_needed(transactions: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """Distinct (currency, day) pairs for which a rate is wanted."""
    return transactions.select(
        F.col("currency_code").alias("currency"), F.col(date_col).alias("rate_date")
    ).distinct()


def convert_currency(
    transactions: DataFrame, rates: DataFrame, date_col: str = "transaction_date", on_missing: str = "null"
) -> DataFrame:
    """Adds ``exchange_rate`` and ``amount_usd``.

    Dollars need no lookup: their rate is 1. A pair without a rate leaves both columns null, or converts at 1
    with ``on_missing="one"``. The rates side is one row per currency and day; Spark broadcasts it while it is
    below the session's threshold and otherwise joins by key, where adaptive execution splits a busy pair.
    """
    if on_missing not in ("null", "one"):
        raise ValueError(f"on_missing must be 'null' or 'one', not {on_missing!r}")
    exact = [F.col("units").alias("_units")] if "units" in rates.columns else []
    lookup = rates.select(F.col("currency").alias("_currency"), F.col("rate_date").alias("_day"), "rate", *exact)
    matched = transactions.join(
        lookup,
        (F.col("currency_code") == F.col("_currency")) & (F.col(date_col) == F.col("_day")),
        "left",
    )
    rate = F.when(F.col("currency_code") == "USD", F.lit(1.0)).otherwise(F.col("rate"))
    if on_missing == "one":
        rate = F.coalesce(rate, F.lit(1.0))
    amount = F.col("original_amount")
    usd = exact_quotient(amount, F.col("_units")) if exact else (amount * F.col("exchange_rate")).try_cast(MONEY)
    return (
        matched.withColumn("exchange_rate", rate)
        .withColumn("amount_usd", F.when(F.col("exchange_rate") == 1.0, amount).otherwise(usd))
        .drop("_currency", "_day", "rate", "_units")
    )

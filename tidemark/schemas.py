"""Declared shapes of the raw entities and of the state tables.

Raw ids and amounts are read as text on purpose: a dump may hold ``"abc"`` where a number belongs, and only a
text column lets the bad value reach the quarantine together with its reason.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
# Stands in CORRUPT for records of a file in which some field is not of its declared type and was read as null.
MISTYPED = "a field of this file is not of its declared type"


def unreadable() -> Column:
    """True for a record nothing could be parsed of."""
    return F.col(CORRUPT).isNotNull() & (F.col(CORRUPT) != MISTYPED)


TEXT, LONG, DOUBLE, DAY = T.StringType(), T.LongType(), T.DoubleType(), T.DateType()
MOMENT, LOCAL_MOMENT, MONEY = T.TimestampType(), T.TimestampNTZType(), T.DecimalType(18, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CONTACT = _struct(name=TEXT, email=TEXT)
CURRENCY_DATA = _struct(originalCurrencyAmount=TEXT, exponent=TEXT, originalCurrencyCode=TEXT)

RAW = {
    "agents": _struct(
        id=TEXT, contact=CONTACT, name=TEXT, email=TEXT, first_name=TEXT, last_name=TEXT, created_at=TEXT, updated_at=TEXT,
    ),
    "agent_details": _struct(
        id=TEXT, contact=CONTACT, created_at=TEXT, updated_at=TEXT,
        group_ids=T.ArrayType(TEXT), role_ids=T.ArrayType(TEXT),
    ),
    "roles": _struct(id=TEXT, name=TEXT, description=TEXT),
    "admin_groups": _struct(
        id=TEXT, name=TEXT, description=TEXT, parent_group_id=TEXT, agent_ids=T.ArrayType(TEXT),
        # Objects or lists of objects with an id, kept as JSON text: a dump may have either.
        users=TEXT, members=TEXT, created_at=TEXT, updated_at=TEXT,
    ),
    "cards": _struct(id=TEXT, name=TEXT, lastFour=TEXT, type=TEXT, status=TEXT),
    "budgets": _struct(id=TEXT, name=TEXT, description=TEXT),
    "transactions": _struct(
        id=TEXT, transactionType=TEXT, transactionDate=TEXT, occurredTime=TEXT, updatedTime=TEXT,
        merchantName=TEXT, currencyData=CURRENCY_DATA, cardId=TEXT, budgetId=TEXT,
    ),
    # Quotes as text, so that their digits reach the conversion.
    "rates": _struct(date=TEXT, usd=T.MapType(TEXT, TEXT)),
}


@dataclass(frozen=True)
class TableSpec:
    """One state table: its columns, its key, and how a merge treats a row that is already stored."""

    schema: T.StructType
    keys: tuple[str, ...]
    update_cols: tuple[str, ...] = ()
    bucketed: bool = True

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


TABLES = {
    "users": TableSpec(
        _struct(user_id=LONG, user_name=TEXT, user_email=TEXT, status=TEXT, created_at=MOMENT, updated_at=MOMENT),
        ("user_id",),
        ("user_name", "user_email", "status", "updated_at"),
    ),
    "roles": TableSpec(
        _struct(role_id=TEXT, role_name=TEXT, role_desc=TEXT), ("role_id",), ("role_name", "role_desc")
    ),
    # Link tables are replaced parent by parent and never merged on their full key, so they carry no buckets:
    # a bucket per parent would put one hot parent into a single file.
    "user_roles": TableSpec(
        _struct(user_id=LONG, role_id=TEXT, role_name=TEXT), ("user_id", "role_id"), bucketed=False
    ),
    "groups": TableSpec(
        _struct(
            group_id=LONG, group_name=TEXT, description=TEXT, parent_group_id=LONG, status=TEXT,
            created_at=MOMENT, updated_at=MOMENT,
        ),
        ("group_id",),
        ("group_name", "description", "parent_group_id", "status", "updated_at"),
    ),
    "group_members": TableSpec(
        _struct(group_id=LONG, user_id=LONG, user_status=TEXT), ("group_id", "user_id"), bucketed=False
    ),
    "cards": TableSpec(
        _struct(card_id=TEXT, card_name=TEXT, card_last_four=TEXT, card_type=TEXT, card_status=TEXT),
        ("card_id",),
        ("card_name", "card_status"),
    ),
    "budgets": TableSpec(
        _struct(budget_id=TEXT, budget_name=TEXT, budget_description=TEXT),
        ("budget_id",),
        ("budget_name", "budget_description"),
    ),
    "transactions": TableSpec(
        _struct(
            transaction_id=TEXT, transaction_type=TEXT, transaction_date=DAY, original_amount=MONEY,
            currency_code=TEXT, exchange_rate=DOUBLE, amount_usd=MONEY, merchant_name=TEXT, card_id=TEXT,
            budget_id=TEXT, created_at=LOCAL_MOMENT, updated_at=MOMENT,
        ),
        ("transaction_id",),
        ("amount_usd", "original_amount", "currency_code", "exchange_rate", "merchant_name", "card_id", "budget_id",
         "transaction_date", "updated_at"),
    ),
    "transaction_cards": TableSpec(
        _struct(
            transaction_id=TEXT, card_id=TEXT, card_name=TEXT, card_last_four=TEXT, card_type=TEXT,
            card_status=TEXT,
        ),
        ("transaction_id", "card_id"),
        ("card_name",),
    ),
    "transaction_budgets": TableSpec(
        _struct(transaction_id=TEXT, budget_id=TEXT, budget_name=TEXT, budget_description=TEXT),
        ("transaction_id", "budget_id"),
        ("budget_name",),
    ),
}


COUNTS = "group_activity"
#: The tables of a store that also keeps activity counts from day to day.
COUNTED_TABLES = {
    **TABLES,
    COUNTS: TableSpec(_struct(group_id=LONG, parent_group_id=LONG, direct=LONG, below=LONG), ("group_id",)),
}


def empty(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _typed(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    column = F.col(f"`{field.name}`")
    if df.schema[field.name].dataType == field.dataType:
        return column
    return column.try_cast(field.dataType).alias(field.name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: target columns only, in order, re-typed, absent ones as typed nulls."""
    return df.select(*[_typed(df, field) for field in schema])


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of ``schema`` that an older state layout lacks; what is stored stays as it is."""
    missing = [f for f in schema if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])

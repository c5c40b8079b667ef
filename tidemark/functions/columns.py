"""Column builders: optional and nested fields, safe casts, fallbacks, money and date keys."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
ID_ARRAY = T.ArrayType(T.LongType())


def field_type(schema: T.DataType, path: str) -> T.DataType | None:
    """Type found at a dotted ``path``, or None where the path does not exist."""
    current = schema
    for part in path.split("."):
        if isinstance(current, T.ArrayType):
            current = current.elementType
        if not isinstance(current, T.StructType) or part not in current.fieldNames():
            return None
        current = current[part].dataType
    return current


def has_field(df: DataFrame, path: str) -> bool:
    return field_type(df.schema, path) is not None


def optional_col(df: DataFrame, path: str, data_type: str | T.DataType = "string") -> Column:
    """The field at ``path`` as ``data_type``, or a null of that type when the source does not have it."""
    alias = path.split(".")[-1]
    if not has_field(df, path):
        return F.lit(None).cast(data_type).alias(alias)
    return F.col(path).try_cast(data_type).alias(alias)


# A failed numeric cast costs a hundred times a good one, because it goes through an exception. Texts that cannot
# be numbers are therefore turned away by their shape, so that a dump full of bad values is no slower than a good one.
INTEGER_SHAPE = r"^\s*[+-]?[0-9]+\s*$"
DECIMAL_SHAPE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def safe_id(column: Column) -> Column:
    text = column.cast("string")
    return F.when(text.rlike(INTEGER_SHAPE), text.try_cast("bigint"))


def safe_decimal(column: Column, kind: T.DecimalType) -> Column:
    text = column.cast("string")
    return F.when(text.rlike(DECIMAL_SHAPE), text.try_cast(kind))


def safe_timestamp(column: Column) -> Column:
    return column.try_cast("timestamp")


def required_text(column: Column) -> Column:
    """True where a mandatory text is there and not empty."""
    return column.isNotNull() & (column != "")


def first_non_null(*columns: Column, default: str | None = None) -> Column:
    """First value that is there, in order of preference, then the literal default."""
    candidates = list(columns) + ([F.lit(default)] if default is not None else [])
    return F.coalesce(*candidates)


def composite_name(*parts: Column) -> Column:
    return F.concat_ws(" ", *parts)


def empty_if_null(array: Column, element: str = "bigint") -> Column:
    return F.coalesce(array, F.array().cast(f"array<{element}>"))


def id_array(array: Column) -> Column:
    """Element-wise safe cast; an element that is no number becomes null."""
    return F.transform(array, safe_id)


def csv_to_array(text: Column) -> Column:
    return id_array(F.split(text, ","))


def array_field_ids(df: DataFrame, path: str) -> Column:
    """Ids found at ``path``, which may run through an array of structs, a struct of an array or a struct."""
    found = field_type(df.schema, path)
    head = field_type(df.schema, path.split(".")[0])
    if isinstance(head, T.ArrayType) or isinstance(found, T.ArrayType):
        return id_array(F.col(path))
    scalar = safe_id(F.col(path))
    return F.when(scalar.isNotNull(), F.array(scalar))


def member_ids(df: DataFrame, sources: tuple[str, ...] = ("agent_ids", "users.id", "members.id")) -> Column:
    """Member ids from the first source the dump has; a missing list counts as empty."""
    for path in sources:
        if has_field(df, path):
            return empty_if_null(array_field_ids(df, path))
    return F.array().cast(ID_ARRAY)


def listed_ids(text: Column) -> Column:
    """Ids in a JSON text: a list of objects with an id, an object with a list of ids, or an object with one id."""
    objects = F.from_json(text, "array<struct<id: string>>")
    many = F.from_json(text, "struct<id: array<string>>").getField("id")
    one = safe_id(F.from_json(text, "struct<id: string>").getField("id"))
    # An object read as a list would give a list of it, so the shape of the text decides.
    return F.when(F.ltrim(text).startswith("["), id_array(objects.getField("id"))).otherwise(
        F.coalesce(id_array(many), F.when(one.isNotNull(), F.array(one)))
    )


def member_ids_by_row(df: DataFrame) -> tuple[Column, Column]:
    """Member ids of each record from the first source that it has, and whether that source can't be read."""
    found, broken = F.lit(None).cast(ID_ARRAY), F.lit(False)
    for source in ("members", "users"):
        kind = field_type(df.schema, source)
        if isinstance(kind, T.StringType):
            own = listed_ids(F.col(source))
            broken = F.when(F.col(source).isNotNull(), own.isNull()).otherwise(broken)
            found = F.when(F.col(source).isNotNull(), own).otherwise(found)
        elif has_field(df, f"{source}.id"):
            found = F.coalesce(array_field_ids(df, f"{source}.id"), found)
    if has_field(df, "agent_ids"):
        own = array_field_ids(df, "agent_ids")
        found, broken = F.coalesce(own, found), own.isNull() & broken
    return empty_if_null(found), broken


WHOLE = T.DecimalType(38, 0)


def rounded_quotient(part: Column, whole: Column) -> Column:
    """Two whole numbers (decimals without places, not negative) divided and rounded once, half up; null for a zero divisor.

    Half a divisor is added and the remainder cut off first, so the division has no rest. Decimal division alone would round twice: to the
    digits of its own result, then to the wanted ones.
    """
    doubled = (whole * 2).cast(WHOLE)
    raised = (part.cast(WHOLE) * 2).cast(WHOLE) + whole
    return F.when(whole > 0, F.try_divide(raised - raised % doubled, doubled).try_cast(T.DecimalType(20, 0)))


def minor_units(amount: Column, exponent: Column) -> Column:
    """Money from minor units: ``12559`` with exponent 2 is 125.59; no number, too large or an
    exponent that is there but can't be read gives null.

    Decimal arithmetic throughout: the power of ten is turned into an exact decimal before it is applied.
    """
    digits = F.when(exponent.isNotNull(), safe_id(exponent).try_cast("int")).otherwise(0)
    factor = F.pow(F.lit(10.0), -digits).try_cast(T.DecimalType(18, 12))
    value = safe_decimal(amount, T.DecimalType(24, 6))
    # More places than the factor has: whole millionths of cents over a power of ten. Beyond 24 places nothing is left of a cent.
    power = F.pow(F.lit(10.0), F.least(digits, F.lit(24)) + 6).cast(WHOLE)
    small = (rounded_quotient((F.abs(value) * 100_000_000).cast(WHOLE), power) * F.lit(Decimal("0.01"))).try_cast(MONEY)
    small = F.when(value < 0, -small).otherwise(small)
    return F.when(digits > 12, small).otherwise(F.try_multiply(value, factor).try_cast(MONEY))


def day_of(timestamp_text: Column) -> Column:
    """Source-local calendar day of a timestamp text: its first ten characters, no zone shift."""
    return F.substring(timestamp_text, 1, 10).try_cast("date")

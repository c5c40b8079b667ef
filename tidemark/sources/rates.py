"""Exchange rates from daily documents ``{"date": ..., "usd": {"gbp": 0.79, ...}}`` (units per dollar)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.currencies import CURRENCY_CODES
from tidemark.functions.columns import safe_decimal
from tidemark.operators.fx import UNITS
from tidemark.operators.quality import is_listed

# Quotes are kept as the text that the document has.
RATE_MAP = "map<string,string>"


def parse_rate_map(body: Column) -> Column:
    """The ``usd`` map of a document given as JSON text; null where the text is no such document."""
    return F.from_json(body, f"usd {RATE_MAP}").getField("usd")


def rates_from_documents(
    documents: DataFrame, date_col: str = "date", map_col: str = "usd", codes: list[str] = CURRENCY_CODES
) -> DataFrame:
    """(currency, rate_date, rate, units), one row per currency and day: dollars per unit as a double, and the quoted
    units per dollar as an exact decimal.

    Absent, zero, negative and unreadable quotes are skipped, only listed codes are kept, and the dollar itself is 1 on every day a
    document was looked for, also when the document is empty. Its size is bounded by codes times days.
    """
    dated = documents.select(
        F.col(date_col).cast("string").try_cast("date").alias("rate_date"), F.col(map_col).alias("quotes")
    ).filter(F.col("rate_date").isNotNull())
    # The dollar's own entry rides along in the same pass instead of in a second scan; the map is exploded
    # without merging, so a document that quotes "usd" itself is simply overruled below.
    quoted = (
        dated.select(
            "rate_date",
            F.explode(
                F.array_append(
                    F.coalesce(
                        F.transform(
                            F.map_entries("quotes"),
                            lambda e: F.struct(
                                F.upper(e["key"]).alias("currency"), e["value"].cast("string").alias("quoted")
                            ),
                        ),
                        F.array().cast("array<struct<currency:string,quoted:string>>"),
                    ),
                    F.struct(F.lit("USD").alias("currency"), F.lit("1").alias("quoted")),
                )
            ).alias("q"),
        )
        .select("rate_date", "q.currency", safe_decimal(F.col("q.quoted"), UNITS).alias("units"), F.col("q.quoted").alias("quoted"))
        .filter(is_listed("currency", codes) & (F.col("units") > 0))
    )
    dollar = F.col("currency") == "USD"
    rate = F.when(dollar, F.lit(1.0)).otherwise(F.lit(1.0) / F.col("double"))
    # Two documents for one day: the larger quote wins, whatever order the files are read in. The double is that of the text.
    return (
        quoted.groupBy("currency", "rate_date")
        .agg(F.max("units").alias("units"), F.max(F.col("quoted").try_cast("double")).alias("double"))
        .select("currency", "rate_date", rate.alias("rate"), F.when(dollar, F.lit(1).cast(UNITS)).otherwise(F.col("units")).alias("units"))
    )

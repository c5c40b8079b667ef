"""Rates, conversion, and the star around transactions.

Orders stand for transactions; the priority decides the currency. Rate documents carry one quote map per order day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.registry import Tables, query
from tidemark.functions.columns import MONEY
from tidemark.operators import fx, star
from tidemark.sources.rates import parse_rate_map, rates_from_documents

CURRENCY = """case o_orderpriority when '1-URGENT' then 'USD' when '2-HIGH' then 'EUR' when '3-MEDIUM' then 'GBP'
              when '4-NOT SPECIFIED' then 'INR' else 'CHF' end"""
CURRENCY_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'USD' WHEN '2-HIGH' THEN 'EUR' WHEN '3-MEDIUM' THEN 'GBP'
    WHEN '4-NOT SPECIFIED' THEN 'INR' ELSE 'CHF' END"""

# No quote for the franc, a zero for the yen, a null for the Canadian dollar, and a code nobody lists.
RATES_SQL = """days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date FROM orders),
quotes AS (
    SELECT rate_date, 'EUR' AS currency, CAST(0.9137 AS DOUBLE) + day(rate_date) / CAST(1000 AS DOUBLE) AS units FROM days
    UNION ALL
    SELECT rate_date, 'GBP', CAST(0.7913 AS DOUBLE) + day(rate_date) / CAST(1000 AS DOUBLE) FROM days
    UNION ALL
    SELECT rate_date, 'INR', CAST(83.17 AS DOUBLE) + day(rate_date) / CAST(10 AS DOUBLE) FROM days),
rates AS (SELECT currency, rate_date, CAST(1 AS DOUBLE) / units AS rate, CAST(CAST(units AS VARCHAR) AS DECIMAL(28,18)) AS units FROM quotes
          UNION ALL SELECT 'USD', rate_date, CAST(1 AS DOUBLE), CAST(1 AS DECIMAL(28,18)) FROM days)
"""


def exact_sql(amount: str, units: str) -> str:
    """Money over units in whole numbers, rounded half up once; for amounts that aren't negative."""
    one = "CAST(1000000000000000000 AS HUGEINT)"
    scaled = f"(CAST(floor({units}) AS HUGEINT) * {one} + CAST(({units} - floor({units})) * 1000000000000000000 AS HUGEINT))"
    return f"CAST((2 * CAST({amount} * 100 AS HUGEINT) * {one} + {scaled}) // (2 * {scaled}) AS DECIMAL(34,0)) * CAST(0.01 AS DECIMAL(3,2))"


def rates(t: Tables) -> DataFrame:
    """Rates out of JSON documents, one per day on which there was an order."""
    days = t.orders.select(F.to_date("o_orderdate").alias("date")).distinct()
    day = F.dayofmonth("date")
    quotes = F.create_map(
        F.lit("eur"), F.lit(0.9137) + day / F.lit(1000.0),
        F.lit("gbp"), F.lit(0.7913) + day / F.lit(1000.0),
        F.lit("inr"), F.lit(83.17) + day / F.lit(10.0),
        F.lit("jpy"), F.lit(0.0), F.lit("cad"), F.lit(None).cast("double"), F.lit("qqq"), F.lit(3.0),
    )
    documents = days.select("date", F.to_json(F.struct("date", quotes.alias("usd"))).alias("body"))
    return rates_from_documents(documents.select("date", parse_rate_map(F.col("body")).alias("usd")))


def transactions(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.to_date("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").try_cast(MONEY).alias("original_amount"),
        F.expr(CURRENCY).alias("currency_code"),
        F.col("o_custkey").alias("card_id"),
    )


@query(f"WITH {RATES_SQL} SELECT currency, rate_date, rate FROM rates")
def fx_rates_from_map(t: Tables) -> DataFrame:
    return rates(t).select("currency", "rate_date", "rate")


@query(f"WITH {RATES_SQL} SELECT currency, rate_date, CAST(units AS VARCHAR) AS units FROM rates")
def fx_rates_decimal(t: Tables) -> DataFrame:
    """The quotes as exact decimals, digit for digit as the documents have them."""
    return rates(t).select("currency", "rate_date", F.col("units").cast("string").alias("units"))


@query(f"""WITH {RATES_SQL},
txns AS (SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS transaction_date, {CURRENCY_SQL} AS currency_code,
                CAST(o_totalprice AS DECIMAL(18,2)) + CAST(o_orderkey % 70 AS DECIMAL(4,0)) * CAST(100000000000000 AS DECIMAL(18,2)) AS original_amount FROM orders)
SELECT transaction_id, CAST(original_amount AS VARCHAR) AS original_amount,
       CAST(CASE WHEN currency_code = 'USD' THEN original_amount ELSE CAST({exact_sql("original_amount", "units")} AS DECIMAL(18,2)) END AS VARCHAR) AS amount_usd
FROM txns LEFT JOIN rates ON currency = currency_code AND rate_date = transaction_date""")
def fx_convert_large(t: Tables) -> DataFrame:
    """Amounts of up to 7 * 10**15, whose cents no double can tell apart, converted to the last cent."""
    large = F.col("original_amount") + (F.col("transaction_id") % 70).cast("decimal(4,0)") * F.lit(100000000000000).cast(MONEY)
    amounts = transactions(t).drop("card_id").withColumn("original_amount", large.cast(MONEY))
    found = fx.convert_currency(amounts, rates(t))
    return found.select("transaction_id", F.col("original_amount").cast("string").alias("original_amount"), F.col("amount_usd").cast("string").alias("amount_usd"))


@query(f"""SELECT DISTINCT {CURRENCY_SQL} AS currency, CAST(o_orderdate AS DATE) AS rate_date FROM orders""")
def fx_pairs_needed(t: Tables) -> DataFrame:
    return fx.pairs_needed(transactions(t))


def converted_sql(on_missing: str, missing: str) -> str:
    return f"""WITH {RATES_SQL},
txns AS (SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS transaction_date,
                CAST(o_totalprice AS DECIMAL(18,2)) AS original_amount, {CURRENCY_SQL} AS currency_code FROM orders)
SELECT transaction_id, transaction_date, original_amount, currency_code,
       CASE WHEN currency_code = 'USD' THEN 1 ELSE {on_missing} END AS exchange_rate,
       CASE WHEN currency_code = 'USD' THEN original_amount
            WHEN rate IS NULL THEN {missing} ELSE CAST({exact_sql("original_amount", "units")} AS DECIMAL(18,2)) END AS amount_usd
FROM txns LEFT JOIN rates ON currency = currency_code AND rate_date = transaction_date"""


@query(converted_sql("rate", "NULL"))
def fx_convert(t: Tables) -> DataFrame:
    """A pair without a rate has neither rate nor dollars."""
    return fx.convert_currency(transactions(t).drop("card_id"), rates(t))


@query(converted_sql("coalesce(rate, CAST(1 AS DOUBLE))", "original_amount"))
def fx_convert_missing_as_one(t: Tables) -> DataFrame:
    return fx.convert_currency(transactions(t).drop("card_id"), rates(t), on_missing="one")


def cards(t: Tables) -> DataFrame:
    """Customers as cards, with a repeated row for the indebted ones."""
    listed = t.customer.select(
        F.col("c_custkey").alias("card_id"), F.col("c_name").alias("card_name"), F.col("c_mktsegment").alias("card_type")
    )
    again = t.customer.filter("c_acctbal < 0").select(
        F.col("c_custkey").alias("card_id"), F.col("c_name").alias("card_name"), F.col("c_mktsegment").alias("card_type")
    )
    return listed.unionByName(again)


def pending(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("card_id")
    )


@query("""SELECT c_custkey AS card_id, c_name AS card_name, c_mktsegment AS card_type FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def referenced_dimension(t: Tables) -> DataFrame:
    """Cards used by pending orders, each once."""
    return star.referenced_dimension(cards(t), pending(t), "card_id")


@query("""SELECT o_orderkey AS transaction_id, c_custkey AS card_id, c_name AS card_name, c_mktsegment AS card_type
FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment <> 'MACHINERY'""")
def junction_cards(t: Tables) -> DataFrame:
    fact = transactions(t)
    known = star.referenced_dimension(cards(t).filter("card_type <> 'MACHINERY'"), fact, "card_id")
    return star.junction(fact, known, "transaction_id", "card_id")


@query("""SELECT l_orderkey AS transaction_id, s_suppkey AS budget_id, s_name AS budget_name,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE 'in funds' END AS budget_description
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""")
def junction_budgets(t: Tables) -> DataFrame:
    """Suppliers as budgets of order lines; few keys, so each holds many lines."""
    budgets = t.supplier.select(
        F.col("s_suppkey").alias("budget_id"),
        F.col("s_name").alias("budget_name"),
        F.expr("if(s_acctbal < 0, null, 'in funds')").alias("budget_description"),
    )
    fact = t.lineitem.select(F.col("l_orderkey").alias("transaction_id"), F.col("l_suppkey").alias("budget_id"))
    return star.junction(fact, star.referenced_dimension(budgets, fact, "budget_id"), "transaction_id", "budget_id")

"""Whole days composed end to end: users, groups, transactions, on stand-ins made of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.hierarchy import HEAP, HEAP_SQL
from tidemark.catalog.money import CURRENCY, CURRENCY_SQL, RATES_SQL, exact_sql, rates
from tidemark.catalog.registry import Tables, query
from tidemark.operators import quality as Q
from tidemark.operators.reconcile import delta_detect, merge_upsert
from tidemark.operators.star import build_star
from tidemark.plans import groups, transactions, users
from tidemark.plans.inputs import balance
from tidemark.schemas import CORRUPT, MONEY, TABLES
from tidemark.scratch import materialize

# -- users: the index is customers, each order is a details record, priorities are roles --------------------------


def agents(t: Tables) -> DataFrame:
    return t.customer.filter("c_mktsegment <> 'MACHINERY'").select(
        F.expr("if(c_mktsegment = 'BUILDING' and c_acctbal < 0, concat('x', c_custkey), string(c_custkey))").alias("id"),
        F.struct(
            F.expr("if(c_acctbal > 9000, null, c_name)").alias("name"),
            F.expr("if(c_mktsegment = 'AUTOMOBILE' and c_acctbal < 1000, '', concat(lower(c_name), '@example.org'))")
            .alias("email"),
        ).alias("contact"),
        F.lit("2021-01-01T00:00:00Z").alias("created_at"),
        F.expr("if(c_mktsegment = 'FURNITURE', '2022-05-', '2022-01-01T00:00:00Z')").alias("updated_at"),
    )


def agent_details(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("id"),
        F.struct(
            F.expr("if(o_orderstatus = 'P', null, concat('Det ', o_orderkey))").alias("name"),
            F.lit(None).cast("string").alias("email"),
        ).alias("contact"),
        F.concat(F.substring(F.col("o_orderdate").cast("string"), 1, 10), F.lit("T00:00:00Z")).alias("updated_at"),
        F.expr("if(o_orderstatus = 'F', null, array(o_orderpriority, '0-BASIC'))").alias("role_ids"),
    )


def role_file(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderpriority").alias("id"),
        F.expr("if(o_orderpriority = '3-MEDIUM', '3', substring(o_orderpriority, 3))").alias("name"),
        F.expr("concat('priority ', o_orderpriority)").alias("description"),
    ).distinct()


def stored_day_users(t: Tables) -> DataFrame:
    return t.customer.filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.lit("old@example.org").alias("user_email"),
        F.lit("active").alias("status"),
        F.lit("2020-01-01T00:00:00Z").cast("timestamp").alias("created_at"),
        F.lit("2020-06-01T00:00:00Z").cast("timestamp").alias("updated_at"),
    )


def stored_day_links(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("role_id"),
        F.lit("stored").alias("role_name"),
    ).distinct()


@query("""WITH idx AS (SELECT c_custkey AS k, c_mktsegment = 'BUILDING' AND c_acctbal < 0 AS bad,
        CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_name END AS name,
        CASE WHEN c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 1000 THEN '' ELSE lower(c_name) || '@example.org' END
            AS email,
        CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE TIMESTAMP '2022-01-01 00:00:00' END AS updated_at
    FROM customer WHERE c_mktsegment <> 'MACHINERY'),
det AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY updated_at DESC, name ASC NULLS FIRST, role ASC NULLS FIRST)
        AS rn
    FROM (SELECT o_custkey AS k, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'Det ' || o_orderkey END AS name,
                 o_orderdate AS updated_at, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS role
          FROM orders)) WHERE rn = 1),
good AS (SELECT i.k, coalesce(d.name, i.name, 'Unknown Name') AS name, i.email,
                coalesce(d.updated_at, i.updated_at) AS updated_at, d.role
         FROM idx i LEFT JOIN det d ON d.k = i.k WHERE NOT i.bad AND i.email <> ''),
old AS (SELECT c_custkey AS k, c_name AS name FROM customer WHERE c_mktsegment <> 'BUILDING'),
links AS (
    SELECT o_custkey AS k, o_orderpriority AS role FROM orders
    WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT k FROM good)
    GROUP BY ALL
    UNION ALL SELECT k, role FROM good WHERE role <> '3-MEDIUM'
    UNION ALL SELECT k, '0-BASIC' FROM good WHERE role IS NOT NULL),
counts AS (SELECT k, count(*) AS n FROM links GROUP BY k)
SELECT coalesce(g.k, o.k) AS user_id, coalesce(g.name, o.name) AS user_name,
       coalesce(g.email, 'old@example.org') AS user_email,
       CASE WHEN g.k IS NOT NULL THEN 'active' ELSE 'inactive' END AS status,
       CAST(epoch(CASE WHEN o.k IS NOT NULL THEN TIMESTAMP '2020-01-01 00:00:00'
                       ELSE TIMESTAMP '2021-01-01 00:00:00' END) AS BIGINT) AS created_at,
       CAST(epoch(coalesce(g.updated_at, CASE WHEN o.k IS NOT NULL THEN TIMESTAMP '2020-06-01 00:00:00' END))
            AS BIGINT) AS updated_at,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_roles
FROM good g FULL OUTER JOIN old o ON g.k = o.k LEFT JOIN counts c ON c.k = coalesce(g.k, o.k)""")
def user_day_sync(t: Tables) -> DataFrame:
    """Users after the day, with the number of their role links."""
    good = Q.good_rows(users.clean_users(users.resolve_users(agents(t), agent_details(t))))
    sync = users.build_users(
        materialize(good, "users"), role_file(t), stored_day_users(t), stored_day_links(t)
    )
    counts = sync.user_roles.groupBy("user_id").agg(F.count("*").alias("n_roles"))
    return sync.users.join(counts, "user_id", "left").select(
        "user_id",
        "user_name",
        "user_email",
        "status",
        F.unix_seconds("created_at").alias("created_at"),
        F.unix_seconds("updated_at").alias("updated_at"),
        F.coalesce("n_roles", F.lit(0)).alias("n_roles"),
    )


# -- groups: open and pending orders are the day's groups, filled and pending ones are stored ---------------------


def group_dump(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.expr("if(o_totalprice > 490000, '', concat('group ', o_orderkey))").alias("name"),
        F.lit(None).cast("string").alias("description"),
        F.expr(f"string(if(o_totalprice < 5000, o_orderkey, {HEAP}))").alias("parent_group_id"),
        F.expr("transform(array(o_custkey, o_custkey + 1, o_custkey), x -> string(x))").alias("agent_ids"),
        F.lit("2021-01-01T00:00:00Z").alias("created_at"),
        F.lit("2022-01-01T00:00:00Z").alias("updated_at"),
    )


@query(f"""WITH RECURSIVE good AS (
    SELECT o_orderkey AS k, {HEAP_SQL} AS parent, o_custkey AS member FROM orders
    WHERE o_orderstatus <> 'F' AND o_totalprice <= 490000 AND o_totalprice >= 5000),
members AS (SELECT k, member AS user_id FROM good UNION ALL SELECT k, member + 1 FROM good),
named AS (SELECT m.k, m.user_id, coalesce(c_acctbal > 9900, FALSE) AS live
          FROM members m LEFT JOIN customer ON c_custkey = m.user_id),
live AS (SELECT DISTINCT k FROM named WHERE live
         UNION SELECT g.parent FROM live JOIN good g ON g.k = live.k WHERE g.parent IS NOT NULL),
old AS (SELECT o_orderkey AS k, o_orderpriority AS description FROM orders WHERE o_orderstatus <> 'O'),
links AS (SELECT k, live FROM named
          UNION ALL SELECT o_orderkey, TRUE FROM orders
          WHERE o_orderstatus <> 'O' AND o_orderkey NOT IN (SELECT k FROM good)),
counts AS (SELECT k, count(*) AS n, count_if(live) AS n_live FROM links GROUP BY k)
SELECT coalesce(g.k, o.k) AS group_id, CASE WHEN g.k IS NOT NULL THEN 'group ' || g.k ELSE 'stored' END AS group_name,
       o.description, g.parent AS parent_group_id,
       CASE WHEN g.k IN (SELECT k FROM live) THEN 'active' ELSE 'inactive' END AS status,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_members, CAST(coalesce(c.n_live, 0) AS BIGINT) AS n_active
FROM good g FULL OUTER JOIN old o ON g.k = o.k LEFT JOIN counts c ON c.k = coalesce(g.k, o.k)""")
def group_day_sync(t: Tables) -> DataFrame:
    """Groups after the day, with the numbers of their members and active members."""
    stored = t.orders.filter("o_orderstatus <> 'O'")
    stored_groups = stored.select(
        F.col("o_orderkey").alias("group_id"),
        F.lit("stored").alias("group_name"),
        F.col("o_orderpriority").alias("description"),
        F.lit(None).cast("bigint").alias("parent_group_id"),
        F.lit("active").alias("status"),
        F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )
    stored_members = stored.select(
        F.col("o_orderkey").alias("group_id"), F.lit(-1).cast("bigint").alias("user_id"),
        F.lit("active").alias("user_status"),
    )
    people = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.expr("if(c_acctbal > 9900, 'active', 'inactive')").alias("status")
    )
    good = Q.good_rows(groups.clean_groups(group_dump(t)))
    sync = groups.build_groups(good, people, stored_groups, stored_members)
    counts = sync.group_members.groupBy("group_id").agg(
        F.count("*").alias("n_members"), F.count_if(F.col("user_status") == "active").alias("n_active")
    )
    return sync.groups.join(counts, "group_id", "left").select(
        "group_id",
        "group_name",
        "description",
        "parent_group_id",
        "status",
        F.coalesce("n_members", F.lit(0)).alias("n_members"),
        F.coalesce("n_active", F.lit(0)).alias("n_active"),
    )


# -- transactions: every order arrives, open ones a second time with a later amount; filled ones are stored -------


def transaction_dump(t: Tables) -> DataFrame:
    def page(orders: DataFrame, cents: str, updated: str) -> DataFrame:
        record = F.struct(
            F.expr("if(o_totalprice < 5000, '', string(o_orderkey))").alias("id"),
            F.lit("AUTHORIZATION").alias("transactionType"),
            F.concat(F.substring(F.col("o_orderdate").cast("string"), 1, 10), F.lit("T10:00:00Z")).alias("occurredTime"),
            F.lit(updated).alias("updatedTime"),
            F.col("o_orderstatus").alias("merchantName"),
            F.struct(
                F.expr(f"if(o_totalprice > 490000, 'n/a', string({cents}))").alias("originalCurrencyAmount"),
                F.lit("2").alias("exponent"),
                F.expr(CURRENCY).alias("originalCurrencyCode"),
            ).alias("currencyData"),
            F.expr("string(o_custkey)").alias("cardId"),
            F.col("o_orderpriority").alias("budgetId"),
        )
        return orders.select(record.alias("t"))

    cents = "cast(round(o_totalprice * 100) as bigint)"
    first = page(t.orders, cents, "2026-01-01T00:00:00Z")
    again = page(t.orders.filter("o_orderstatus = 'O'"), f"{cents} + 250", "2026-01-02T00:00:00Z")
    return first.unionByName(again).select("t.*")


def stored_transactions(t: Tables) -> DataFrame:
    amount = F.col("o_totalprice").try_cast(MONEY)
    return t.orders.filter("o_orderstatus = 'F' and o_totalprice >= 5000").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.lit("STORED").alias("transaction_type"),
        F.lit("2020-01-01").cast("date").alias("transaction_date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(0).cast(MONEY)).otherwise(amount).alias("original_amount"),
        F.lit("USD").alias("currency_code"),
        F.lit(1.0).alias("exchange_rate"),
        F.lit(0).cast(MONEY).alias("amount_usd"),
        F.lit("stored").alias("merchant_name"),
        F.lit("0").alias("card_id"),
        F.lit("0").alias("budget_id"),
        F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )


def transaction_delta(t: Tables) -> DataFrame:
    tagged = transactions.clean_transactions(
        transactions.survivors(materialize(transactions.extract_transactions(transaction_dump(t)), "extracted"))
    )
    fresh = Q.good_rows(tagged).drop("updated_time", CORRUPT, "source_path")
    delta = delta_detect(fresh, stored_transactions(t), ["transaction_id"], ["original_amount"])
    return materialize(Q.good_rows(transactions.convert(delta, rates(t))), "converted")


DELTA_SQL = f"""{RATES_SQL},
dump AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS merchant,
                CAST((CAST(round(o_totalprice * 100) AS BIGINT)
                      + CASE WHEN o_orderstatus = 'O' THEN 250 ELSE 0 END) * CAST(0.01 AS DECIMAL(3,2))
                     AS DECIMAL(18,2)) AS amount,
                {CURRENCY_SQL} AS code, CAST(o_custkey AS VARCHAR) AS card, o_orderpriority AS budget
         FROM orders WHERE o_totalprice BETWEEN 5000 AND 490000),
old AS (SELECT CAST(o_orderkey AS VARCHAR) AS id,
               CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(0 AS DECIMAL(18,2))
                    ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount
        FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 5000),
fact AS (SELECT d.*, CASE WHEN code = 'USD' THEN 1 ELSE rate END AS rate,
                CASE WHEN code = 'USD' THEN d.amount
                     ELSE CAST({exact_sql("d.amount", "units")} AS DECIMAL(18,2)) END AS usd
         FROM dump d LEFT JOIN old o ON o.id = d.id LEFT JOIN rates ON currency = code AND rate_date = day
         WHERE (o.id IS NULL OR o.amount IS DISTINCT FROM d.amount) AND code <> 'CHF')
"""


@query(f"""WITH {DELTA_SQL}
SELECT coalesce(f.id, o.id) AS transaction_id,
       CASE WHEN o.id IS NOT NULL THEN 'STORED' ELSE 'AUTHORIZATION' END AS transaction_type,
       CASE WHEN f.id IS NOT NULL THEN f.day ELSE DATE '2020-01-01' END AS transaction_date,
       CASE WHEN f.id IS NOT NULL THEN f.amount ELSE o.amount END AS original_amount,
       CASE WHEN f.id IS NOT NULL THEN f.code ELSE 'USD' END AS currency_code,
       CASE WHEN f.id IS NOT NULL THEN f.rate ELSE 1 END AS exchange_rate,
       CASE WHEN f.id IS NOT NULL THEN f.usd ELSE CAST(0 AS DECIMAL(18,2)) END AS amount_usd,
       CASE WHEN f.id IS NOT NULL THEN f.merchant ELSE 'stored' END AS merchant_name,
       CASE WHEN f.id IS NOT NULL THEN f.card ELSE '0' END AS card_id,
       CASE WHEN f.id IS NOT NULL THEN f.budget ELSE '0' END AS budget_id,
       CAST(CASE WHEN o.id IS NOT NULL THEN DATE '2020-01-01' ELSE DATE '2026-01-03' END AS DATE) AS created_on
FROM fact f FULL OUTER JOIN old o ON o.id = f.id""")
def transaction_day_sync(t: Tables) -> DataFrame:
    """The transactions table after the day."""
    spec = TABLES["transactions"]
    merged = merge_upsert(
        stored_transactions(t), transaction_delta(t), spec.keys, spec.update_cols,
        {"created_at": F.lit("2026-01-03 00:00:00").cast("timestamp_ntz")},
    )
    return merged.withColumn("created_on", F.to_date("created_at")).drop("created_at")


@query(f"""WITH {DELTA_SQL}
SELECT f.id AS transaction_id, 'card' AS link, f.card AS key, c_name AS name
FROM fact f JOIN customer ON CAST(c_custkey AS VARCHAR) = f.card WHERE c_mktsegment <> 'MACHINERY'
UNION ALL SELECT f.id, 'budget', f.budget, 'budget ' || f.budget FROM fact f WHERE f.budget <> '5-LOW'""")
def transaction_star_day(t: Tables) -> DataFrame:
    """Both junctions of the day's delta, from one pinned fact."""
    cards = t.customer.filter("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").cast("string").alias("card_id"), F.col("c_name").alias("card_name")
    )
    budgets = t.orders.filter("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderpriority").alias("budget_id"),
        F.concat(F.lit("budget "), F.col("o_orderpriority")).alias("budget_name"),
    )
    built = build_star(transaction_delta(t), cards, budgets)
    links = [
        built.transaction_cards.select(
            "transaction_id", F.lit("card").alias("link"), F.col("card_id").alias("key"), F.col("card_name").alias("name")
        ),
        built.transaction_budgets.select(
            "transaction_id", F.lit("budget").alias("link"), F.col("budget_id").alias("key"),
            F.col("budget_name").alias("name"),
        ),
    ]
    return links[0].unionByName(links[1])


@query(f"""WITH {DELTA_SQL},
n AS (SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS again,
             (SELECT count(*) FROM orders WHERE o_totalprice >= 5000) AS named, (SELECT count(*) FROM dump) AS good,
             (SELECT count(*) FROM dump d LEFT JOIN old o ON o.id = d.id WHERE o.id IS NULL OR o.amount IS DISTINCT FROM d.amount) AS delta,
             (SELECT count(*) FROM fact) AS converted),
m AS (SELECT *, named + CASE WHEN orders > named THEN 1 ELSE 0 END AS kept FROM n)
SELECT 0 AS step, 'extracted' AS stage, orders + again AS rows_in, kept AS rows_ok, 0 AS rows_failed, orders + again - kept AS rows_skipped FROM m
UNION ALL SELECT 1, 'transactions', kept, good, kept - good, 0 FROM m
UNION ALL SELECT 2, 'delta', good, delta, 0, good - delta FROM m
UNION ALL SELECT 3, 'conversion', delta, converted, delta - converted, 0 FROM m""")
def run_metrics_balance(t: Tables) -> DataFrame:
    """What became of every row of a transactions dump, stage by stage: kept, failed or skipped."""
    stored = stored_transactions(t).withColumn("updated_at", F.lit(None).cast("timestamp"))
    prepared = transactions.prepare(transactions.extract_transactions(transaction_dump(t)), stored, rates(t))
    return balance(t.spark, *prepared.steps).select(
        F.col("step"), "stage", *[F.col(c) for c in ("rows_in", "rows_ok", "rows_failed", "rows_skipped")]
    )

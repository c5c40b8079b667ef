"""Filters, quarantine, integrity and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.reconciliation import incoming_users, stored_users
from tidemark.catalog.registry import Tables, query
from tidemark.functions.columns import MONEY, safe_id
from tidemark.functions.currencies import CURRENCY_CODES
from tidemark.operators import quality as Q
from tidemark.operators.reconcile import reconcile_snapshot

CODES_SQL = ", ".join(f"'{code}'" for code in CURRENCY_CODES)


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey AS VARCHAR)
       WHEN 'O' THEN o_orderpriority END AS role_name FROM orders WHERE o_orderstatus <> 'F'""")
def numeric_name_exclude(t: Tables) -> DataFrame:
    """Names of digits only are out; a missing name is no numeric name and stays."""
    named = t.orders.select("o_orderkey", F.expr(
        """case o_orderstatus when 'F' then cast(o_orderkey as string) when 'O' then o_orderpriority end"""
    ).alias("role_name"))
    return named.filter(~Q.digits_only(F.col("role_name")))


@query("""SELECT c_custkey, c_name AS user_name FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""")
def required_text_filter(t: Tables) -> DataFrame:
    users = t.customer.select("c_custkey", F.expr(
        "case c_mktsegment when 'BUILDING' then '' when 'MACHINERY' then null else c_name end").alias("user_name"))
    good, _ = Q.validate(users, [Q.missing("user_name")])
    return good


CODE_CASE = """case o_orderpriority when '1-URGENT' then 'USD' when '2-HIGH' then 'EUR' when '3-MEDIUM' then 'usd'
                  when '4-NOT SPECIFIED' then 'QQQ' else if(o_orderstatus = 'F', null, 'ZMK') end"""
CODE_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'USD' WHEN '2-HIGH' THEN 'EUR' WHEN '3-MEDIUM' THEN 'usd'
    WHEN '4-NOT SPECIFIED' THEN 'QQQ' ELSE CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'ZMK' END END"""


@query(f"""SELECT * FROM (SELECT o_orderkey, {CODE_SQL} AS currency_code FROM orders)
WHERE currency_code IN ({CODES_SQL})""")
def allow_list_filter(t: Tables) -> DataFrame:
    coded = t.orders.select("o_orderkey", F.expr(CODE_CASE).alias("currency_code"))
    good, _ = Q.validate(coded, [Q.not_listed("currency_code", CURRENCY_CODES)])
    return good


@query("""SELECT group_id, parent_group_id FROM (
    SELECT c_custkey AS group_id, CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey
           WHEN c_custkey > 0 THEN (c_custkey - 1) // 2 END AS parent_group_id FROM customer)
WHERE parent_group_id IS NULL OR group_id <> parent_group_id""")
def self_loop_filter(t: Tables) -> DataFrame:
    """Ids arrive as text and are compared after the cast."""
    groups = t.customer.select(
        F.col("c_custkey").cast("string").alias("raw_id"),
        F.expr("""case when c_mktsegment = 'BUILDING' then concat('0', c_custkey)
                       when c_custkey > 0 then cast((c_custkey - 1) div 2 as string) end""").alias("raw_parent"),
    ).select(safe_id(F.col("raw_id")).alias("group_id"), safe_id(F.col("raw_parent")).alias("parent_group_id"))
    good, _ = Q.validate(groups, [Q.self_loop("group_id", "parent_group_id")])
    return good


def faulty_orders(t: Tables) -> DataFrame:
    """Orders as transactions with planted faults: no id, no card, negative or non-numeric amount, odd currency."""
    return t.orders.select(
        "o_orderkey",
        F.expr("if(o_totalprice < 20000, '', cast(o_orderkey as string))").alias("transaction_id"),
        F.expr("if(o_orderstatus = 'P' and o_totalprice > 400000, null, cast(o_custkey as string))").alias("card_id"),
        F.expr("""case when o_orderpriority = '5-LOW' and o_orderstatus = 'F' then 'NaN'
                       when o_orderpriority = '2-HIGH' and o_orderstatus = 'P' then concat('-', o_totalprice)
                       else cast(o_totalprice as string) end""").try_cast(MONEY).alias("original_amount"),
        F.expr(CODE_CASE).alias("currency_code"),
    )


def rules() -> list[Q.Rule]:
    return [
        Q.missing("transaction_id"),
        Q.missing("card_id"),
        Q.Rule("bad_amount", F.col("original_amount") < 0),
        Q.not_listed("currency_code", CURRENCY_CODES),
    ]


REASONS_SQL = f"""SELECT o_orderkey, o_orderstatus, concat_ws(',',
    CASE WHEN o_totalprice < 20000 THEN 'missing_transaction_id' END,
    CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN 'missing_card_id' END,
    CASE WHEN (o_orderpriority = '5-LOW' AND o_orderstatus = 'F') OR
              (o_orderpriority = '2-HIGH' AND o_orderstatus = 'P') THEN 'bad_amount' END,
    CASE WHEN ({CODE_SQL}) IN ({CODES_SQL}) THEN NULL ELSE 'unknown_currency_code' END) AS reasons
FROM orders"""


@query(f"SELECT o_orderkey, reasons, CASE WHEN reasons = '' THEN 'good' ELSE 'bad' END AS side FROM ({REASONS_SQL})")
def quarantine_split(t: Tables) -> DataFrame:
    """Both sides of the split with all reasons per row; together they are the whole input."""
    tagged = Q.tag_faults(faulty_orders(t), rules())
    sides = [
        Q.good_rows(tagged).select("o_orderkey", F.lit("").alias("reasons"), F.lit("good").alias("side")),
        Q.bad_rows(tagged).select(
            "o_orderkey", F.concat_ws(",", Q.REASONS).alias("reasons"), F.lit("bad").alias("side")
        ),
    ]
    return sides[0].unionByName(sides[1])


@query(f"""SELECT reason, CAST(count(*) AS BIGINT) AS rows FROM (
    SELECT unnest(string_split(reasons, ',')) AS reason FROM ({REASONS_SQL}) WHERE reasons <> '') GROUP BY reason""")
def quarantine_reasons(t: Tables) -> DataFrame:
    return Q.reason_counts(Q.tag_faults(faulty_orders(t), rules()))


@query(f"""SELECT 'orders' AS stage, CAST(count(*) AS BIGINT) AS rows_in,
       CAST(count_if(reasons = '') AS BIGINT) AS rows_ok, CAST(count_if(reasons <> '') AS BIGINT) AS rows_failed
FROM ({REASONS_SQL})
UNION ALL SELECT 'customers', CAST(count(*) AS BIGINT), CAST(count_if(c_acctbal >= 0) AS BIGINT),
       CAST(count_if(c_acctbal < 0) AS BIGINT) FROM customer""")
def stage_metrics(t: Tables) -> DataFrame:
    customers = Q.tag_faults(t.customer, [Q.Rule("in_debt", F.col("c_acctbal") < 0)])
    orders = Q.tag_faults(faulty_orders(t), rules())
    return Q.stage_metrics(orders, "orders").unionByName(Q.stage_metrics(customers, "customers"))


@query("""SELECT status, CAST(count(*) AS BIGINT) AS rows FROM (
    SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'inactive' ELSE 'active' END AS status FROM customer)
GROUP BY status""")
def status_summary(t: Tables) -> DataFrame:
    return Q.status_summary(reconcile_snapshot(incoming_users(t), stored_users(t), ["user_id"]))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""")
def referential_orphans(t: Tables) -> DataFrame:
    known = t.supplier.filter("s_acctbal >= 0")
    links = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    return Q.orphans(links, known, {"l_suppkey": "s_suppkey"})


@query("""SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_keys(t: Tables) -> DataFrame:
    return Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


def _reference_sql(child: str, column: str, parent: str, key: str, rows: str, keys: str) -> str:
    lost = f"{column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {keys})"
    return f"""SELECT '{child}.{column} -> {parent}.{key}' AS reference, count(*) AS row_count, count_if({column} IS NULL) AS null_rows,
        count_if({lost}) AS orphan_rows, count(DISTINCT CASE WHEN {lost} THEN {column} END) AS orphan_keys FROM {rows}"""


@query("WITH large AS (SELECT * FROM orders WHERE o_totalprice > 100000), fewer AS (SELECT * FROM part WHERE p_size < 50),\n"
       "named AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey + 20 END AS o_custkey FROM orders)\n" + "\nUNION ALL ".join([
           _reference_sql("lineitem", "l_orderkey", "large", "o_orderkey", "lineitem", "large"),
           _reference_sql("lineitem", "l_partkey", "fewer", "p_partkey", "lineitem", "fewer"),
           _reference_sql("lineitem", "l_suppkey", "supplier", "s_suppkey", "lineitem", "supplier"),
           _reference_sql("named", "o_custkey", "customer", "c_custkey", "named", "customer"),
       ]))
def run_integrity_report(t: Tables) -> DataFrame:
    """Rows that point at nothing, over four references in one aggregation."""
    frames = {
        "lineitem": t.lineitem, "large": t.orders.filter("o_totalprice > 100000"), "fewer": t.part.filter("p_size < 50"), "supplier": t.supplier,
        "customer": t.customer, "named": t.orders.select(F.expr("if(o_orderstatus = 'P', null, o_custkey + 20)").alias("o_custkey")),
    }
    references = [
        Q.Reference("lineitem", "l_orderkey", "large", "o_orderkey"), Q.Reference("lineitem", "l_partkey", "fewer", "p_partkey"),
        Q.Reference("lineitem", "l_suppkey", "supplier", "s_suppkey"), Q.Reference("named", "o_custkey", "customer", "c_custkey"),
    ]
    return Q.check_references(frames, references)

"""Reconcile, merge, delta, child sync and survivors.

Stand-ins: users and groups are customers, a market segment decides which snapshot a customer is in and what has
changed (BUILDING is new, MACHINERY is gone, FURNITURE was renamed, AUTOMOBILE lost its name, HOUSEHOLD was
inactive); every customer takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tidemark.catalog.registry import Tables, query
from tidemark.operators import links as L
from tidemark.operators import reconcile as R
from tidemark.schemas import MONEY, TABLES, align_schema, conform

def stored_users(t: Tables) -> DataFrame:
    return t.customer.filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.expr("concat(lower(c_name), '@example.org')").alias("user_email"),
        F.expr("if(c_mktsegment = 'HOUSEHOLD', 'inactive', 'active')").alias("status"),
        F.lit(1).alias("created_day"),
        F.lit(1).alias("updated_day"),
    )


def incoming_users(t: Tables) -> DataFrame:
    return t.customer.filter("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").alias("user_id"),
        F.expr("""case c_mktsegment when 'FURNITURE' then concat('Renamed ', c_name)
                  when 'AUTOMOBILE' then null else c_name end""").alias("user_name"),
        F.expr("concat(lower(c_name), '@example.com')").alias("user_email"),
        F.lit("active").alias("status"),
        F.lit(2).alias("created_day"),
        F.expr("if(c_acctbal < 0, null, 2)").alias("updated_day"),
    )


USERS_SQL = """
old AS (SELECT c_custkey AS user_id, c_name AS user_name, lower(c_name) || '@example.org' AS user_email,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'inactive' ELSE 'active' END AS status,
               1 AS created_day, 1 AS updated_day
        FROM customer WHERE c_mktsegment <> 'BUILDING'),
new AS (SELECT c_custkey AS user_id,
               CASE c_mktsegment WHEN 'FURNITURE' THEN 'Renamed ' || c_name WHEN 'AUTOMOBILE' THEN NULL
                    ELSE c_name END AS user_name,
               lower(c_name) || '@example.com' AS user_email, 'active' AS status, 2 AS created_day,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE 2 END AS updated_day
        FROM customer WHERE c_mktsegment <> 'MACHINERY')
"""


@query(f"""WITH {USERS_SQL}
SELECT coalesce(n.user_id, o.user_id) AS user_id, coalesce(n.user_name, o.user_name) AS user_name,
       coalesce(n.user_email, o.user_email) AS user_email, coalesce(n.updated_day, o.updated_day) AS updated_day,
       CASE WHEN o.user_id IS NOT NULL THEN o.created_day ELSE n.created_day END AS created_day,
       CASE WHEN n.user_id IS NOT NULL THEN 'active' ELSE 'inactive' END AS status
FROM new n FULL OUTER JOIN old o ON n.user_id = o.user_id""")
def snapshot_reconcile(t: Tables) -> DataFrame:
    return R.reconcile_snapshot(
        incoming_users(t),
        stored_users(t),
        ["user_id"],
        coalesce_cols=["user_name", "user_email", "updated_day"],
        keep_cols=["created_day"],
    )


@query("""WITH old AS (SELECT c_custkey AS group_id, c_name AS group_name, 'about ' || c_mktsegment AS description,
               CASE WHEN c_custkey > 0 THEN (c_custkey - 1) // 2 END AS parent_group_id
        FROM customer WHERE c_mktsegment <> 'BUILDING'),
new AS (SELECT c_custkey AS group_id, c_name || '!' AS group_name,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE 'new ' || c_mktsegment END AS description,
               CASE WHEN c_mktsegment <> 'FURNITURE' AND c_custkey > 0 THEN (c_custkey - 1) // 2 END
                   AS parent_group_id,
               CASE WHEN c_acctbal >= 0 THEN 'active' ELSE 'inactive' END AS derived
        FROM customer WHERE c_mktsegment <> 'MACHINERY')
SELECT coalesce(n.group_id, o.group_id) AS group_id, coalesce(n.group_name, o.group_name) AS group_name,
       coalesce(n.description, o.description) AS description,
       CASE WHEN n.group_id IS NOT NULL THEN n.parent_group_id ELSE o.parent_group_id END AS parent_group_id,
       CASE WHEN n.group_id IS NOT NULL THEN n.derived ELSE 'inactive' END AS status
FROM new n FULL OUTER JOIN old o ON n.group_id = o.group_id""")
def group_reconcile(t: Tables) -> DataFrame:
    parent = "if(c_custkey > 0, (c_custkey - 1) div 2, null)"
    old = t.customer.filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("group_id"),
        F.col("c_name").alias("group_name"),
        F.expr("concat('about ', c_mktsegment)").alias("description"),
        F.expr(parent).alias("parent_group_id"),
    )
    new = t.customer.filter("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").alias("group_id"),
        F.expr("concat(c_name, '!')").alias("group_name"),
        F.expr("if(c_mktsegment = 'AUTOMOBILE', null, concat('new ', c_mktsegment))").alias("description"),
        F.expr(f"if(c_mktsegment <> 'FURNITURE', {parent}, null)").alias("parent_group_id"),
        F.expr("if(c_acctbal >= 0, 'active', 'inactive')").alias("derived"),
    )
    return R.reconcile_snapshot(
        new,
        old,
        ["group_id"],
        coalesce_cols=["group_name", "description"],
        source_wins_cols=["parent_group_id"],
        status=F.col("new.derived"),
    )


@query(f"""WITH {USERS_SQL}
SELECT coalesce(n.user_id, o.user_id) AS user_id,
       CASE WHEN n.user_id IS NOT NULL THEN n.user_name ELSE o.user_name END AS user_name,
       CASE WHEN n.user_id IS NOT NULL THEN n.user_email ELSE o.user_email END AS user_email,
       CASE WHEN n.user_id IS NOT NULL THEN n.status ELSE o.status END AS status,
       CASE WHEN o.user_id IS NOT NULL THEN o.created_day ELSE n.created_day END AS created_day,
       CASE WHEN n.user_id IS NOT NULL AND o.user_id IS NOT NULL THEN n.updated_day
            WHEN n.user_id IS NOT NULL THEN coalesce(n.updated_day, 7) ELSE o.updated_day END AS updated_day
FROM new n FULL OUTER JOIN old o ON n.user_id = o.user_id""")
def merge_upsert(t: Tables) -> DataFrame:
    return R.merge_upsert(
        stored_users(t),
        incoming_users(t),
        ["user_id"],
        ["user_name", "user_email", "status", "updated_day"],
        defaults={"updated_day": F.lit(7)},
    )


@query("""WITH links AS (SELECT DISTINCT o_custkey AS user_id, o_orderpriority AS role_id, o_orderstatus = 'P' AS fresh
               FROM orders),
synced AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
SELECT user_id, role_id FROM links WHERE NOT fresh AND user_id NOT IN (SELECT c_custkey FROM synced)
GROUP BY ALL
UNION ALL
SELECT user_id, role_id FROM links WHERE fresh AND user_id IN (SELECT c_custkey FROM synced)""")
def replace_children(t: Tables) -> DataFrame:
    """Links of synced users are replaced, and cleared where the batch has none; other users keep theirs."""
    synced = t.customer.filter("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").alias("user_id"))
    links = t.orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("role_id"), "o_orderstatus")
    stored = links.filter("o_orderstatus <> 'P'").select("user_id", "role_id").distinct()
    batch = links.filter("o_orderstatus = 'P'").select("user_id", "role_id").distinct()
    return R.replace_children(stored, batch.join(synced, "user_id", "left_semi"), "user_id", synced)


@query("""WITH incoming AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderstatus,
                         o_orderpriority FROM orders),
stored AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                  WHEN o_orderpriority = '1-URGENT' THEN CAST(amount + 1 AS DECIMAL(18,2)) ELSE amount END AS amount
           FROM incoming WHERE o_orderstatus <> 'P')
SELECT i.o_orderkey, i.amount, i.o_orderstatus, i.o_orderpriority
FROM incoming i LEFT JOIN stored s ON i.o_orderkey = s.o_orderkey
WHERE s.o_orderkey IS NULL OR i.amount IS DISTINCT FROM s.amount""")
def delta_detect(t: Tables) -> DataFrame:
    incoming = t.orders.select(
        "o_orderkey", F.col("o_totalprice").try_cast(MONEY).alias("amount"), "o_orderstatus", "o_orderpriority"
    )
    stored = incoming.filter("o_orderstatus <> 'P'").select(
        "o_orderkey",
        F.expr("""case o_orderpriority when '5-LOW' then null when '1-URGENT' then amount + 1 else amount end""")
        .cast(MONEY).alias("amount"),
    )
    return R.delta_detect(incoming, stored, ["o_orderkey"], ["amount"])


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1""")
def dedup_latest(t: Tables) -> DataFrame:
    return R.dedup_latest(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag) AS rn
      FROM lineitem) WHERE rn = 1""")
def dedup_by_key(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag",
        "l_shipdate",
    )
    return R.dedup_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def named_links(t: Tables) -> DataFrame:
    """Every order as one mention of a role by a user; the medium priority's role is named by a number."""
    return t.orders.select(
        F.col("o_custkey").alias("user_id"),
        F.expr("if(o_orderstatus = 'P', null, o_orderpriority)").alias("role_id"),
        F.expr("if(o_orderpriority = '3-MEDIUM', '3', substring(o_orderpriority, 3))").alias("role_name"),
        F.expr("concat('priority ', o_orderpriority)").alias("role_desc"),
    )


@query("""SELECT DISTINCT o_orderpriority AS role_id, substr(o_orderpriority, 3) AS role_name,
       'priority ' || o_orderpriority AS role_desc
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '3-MEDIUM'""")
def distinct_roles(t: Tables) -> DataFrame:
    return L.distinct_roles(named_links(t))


@query("""SELECT DISTINCT o_custkey AS user_id, o_orderpriority AS role_id, substr(o_orderpriority, 3) AS role_name
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '3-MEDIUM'""")
def distinct_links(t: Tables) -> DataFrame:
    return L.distinct_links(named_links(t))


@query("""SELECT c.c_custkey AS user_id, c.c_name, o.o_orderkey, o.o_totalprice
FROM customer c LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
    FROM orders) o ON o.o_custkey = c.c_custkey AND o.rn = 1""")
def left_enrich(t: Tables) -> DataFrame:
    """Customers with their latest order as the details record."""
    index = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name")
    details = t.orders.select(
        F.col("o_custkey").alias("user_id"), "o_orderkey", "o_totalprice", "o_orderdate"
    )
    return R.left_enrich(index, details, "user_id", ["o_orderdate"]).select(
        "user_id", "c_name", "det.o_orderkey", "det.o_totalprice"
    )


@query("""SELECT l_orderkey AS group_id, l_partkey AS user_id,
       CASE WHEN p_size = 50 THEN 'active' ELSE 'inactive' END AS user_status
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_brand <> 'Brand#1') ON p_partkey = l_partkey""")
def member_status(t: Tables) -> DataFrame:
    members = t.lineitem.select(F.col("l_orderkey").alias("group_id"), F.col("l_partkey").alias("user_id"))
    return L.member_status(members, part_users(t).filter("p_brand <> 'Brand#1'"))


def part_users(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("user_id"),
        F.expr("if(p_size = 50, 'active', 'inactive')").alias("status"),
        "p_brand",
    )


@query("""SELECT o_orderkey AS group_id, coalesce(bool_or(p_size = 50), false) AS has_active_member
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey
GROUP BY o_orderkey""")
def direct_activity(t: Tables) -> DataFrame:
    members = t.lineitem.select(F.col("l_orderkey").alias("group_id"), F.col("l_partkey").alias("user_id"))
    direct = L.direct_activity(L.member_status(members, part_users(t)))
    groups = t.orders.select(F.col("o_orderkey").alias("group_id"))
    return groups.join(direct, "group_id", "left").na.fill(False, ["has_active_member"])


@query("""SELECT c_custkey AS user_id, c_name AS user_name, CAST(NULL AS VARCHAR) AS user_email, 'active' AS status,
       CAST(NULL AS BIGINT) AS seen_on FROM customer""")
def conform_schema(t: Tables) -> DataFrame:
    """An older layout brought to the target: ids re-typed, surplus columns dropped, absent ones typed nulls."""
    older = t.customer.select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.lit("active").alias("status"),
        "c_acctbal",
    )
    typed = conform(older, TABLES["users"].schema).drop("created_at", "updated_at")
    wider = T.StructType([*typed.schema.fields, T.StructField("seen_on", T.LongType())])
    return align_schema(typed, wider)


@query("""WITH lines AS (SELECT o_orderkey, l_linenumber, o_orderpriority, CAST(o_orderdate AS DATE) + CAST(l_linenumber - 4 AS INTEGER) AS updated_on,
        CAST(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice ELSE l_extendedprice END AS DECIMAL(18,2)) AS amount
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
incoming AS (SELECT o_orderkey, updated_on, amount FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY updated_on DESC, amount) AS rn
    FROM lines WHERE l_linenumber <= CASE o_orderpriority WHEN '1-URGENT' THEN 3 ELSE 5 END) WHERE rn = 1),
stored AS (SELECT o_orderkey, updated_on, min(amount) AS amount FROM lines WHERE l_linenumber = 4 GROUP BY o_orderkey, updated_on)
SELECT i.o_orderkey, i.updated_on, i.amount, CASE WHEN s.o_orderkey IS NULL THEN 'new' WHEN i.updated_on < s.updated_on THEN 'late'
    WHEN i.amount <> s.amount THEN 'changed' WHEN i.updated_on > s.updated_on THEN 'newer' ELSE 'same' END AS outcome
FROM incoming i LEFT JOIN stored s ON s.o_orderkey = i.o_orderkey""")
def late_update_guard(t: Tables) -> DataFrame:
    """Versions of orders against stored ones: what is new, changed or the same, and what comes after a later version was stored."""
    lines = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey", "l_linenumber", "o_orderpriority", F.expr("date_add(to_date(o_orderdate), int(l_linenumber) - 4)").alias("updated_on"),
        F.expr("if(o_orderpriority = '5-LOW', o_totalprice, l_extendedprice)").try_cast(MONEY).alias("amount"),
    )
    sent = lines.filter("l_linenumber <= if(o_orderpriority = '1-URGENT', 3, 5)").select("o_orderkey", "updated_on", "amount")
    stored = lines.filter("l_linenumber = 4").groupBy("o_orderkey", "updated_on").agg(F.min("amount").alias("amount"))
    return R.classify_delta(R.dedup_latest(sent, ["o_orderkey"], ["updated_on"]), stored, ["o_orderkey"], ["amount"], "updated_on")

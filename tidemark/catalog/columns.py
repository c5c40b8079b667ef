"""Projections, casts, arrays and explodes, over rows of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.registry import Tables, query
from tidemark.functions import columns as C
from tidemark.operators import links as L


@query("""SELECT c_custkey, c_name AS user_name, CAST(NULL AS VARCHAR) AS c_phone, c_nationkey AS nation,
       CAST(NULL AS BIGINT) AS rank FROM customer""")
def optional_column(t: Tables) -> DataFrame:
    nested = t.customer.select("c_custkey", F.struct(F.col("c_name").alias("name"), "c_nationkey").alias("contact"))
    return nested.select(
        "c_custkey",
        C.optional_col(nested, "contact.name").alias("user_name"),
        C.optional_col(nested, "c_phone"),
        C.optional_col(nested, "contact.c_nationkey", "int").alias("nation"),
        C.optional_col(nested, "contact.rank", "bigint"),
    )


@query("""SELECT c_custkey, coalesce(s_name, CASE WHEN c_mktsegment <> 'BUILDING'
                                     THEN concat_ws(' ', c_mktsegment, c_name) END, 'Unknown Name') AS user_name,
       CASE WHEN s_suppkey IS NULL THEN 'no-email@placeholder.com' ELSE lower(s_name) || '@example.org' END
           AS user_email
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def coalesce_fallback(t: Tables) -> DataFrame:
    joined = t.customer.join(t.supplier, F.col("s_suppkey") == F.col("c_custkey"), "left")
    composite = F.when(
        F.col("c_mktsegment") != "BUILDING", C.composite_name(F.col("c_mktsegment"), F.col("c_name"))
    )
    return joined.select(
        "c_custkey",
        C.first_non_null(F.col("s_name"), composite, default="Unknown Name").alias("user_name"),
        C.first_non_null(
            F.concat(F.lower("s_name"), F.lit("@example.org")), default="no-email@placeholder.com"
        ).alias("user_email"),
    )


@query("""WITH texts AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN CAST(o_orderkey AS VARCHAR)
    WHEN 'F' THEN 'abc' || o_orderkey ELSE o_orderkey || '.5' END AS raw_id FROM orders)
SELECT o_orderkey, raw_id, CASE WHEN regexp_full_match(raw_id, '[0-9]+') THEN CAST(raw_id AS BIGINT) END AS group_id
FROM texts""")
def safe_id_cast(t: Tables) -> DataFrame:
    texts = t.orders.select("o_orderkey", F.expr(
        """case o_orderstatus when 'O' then cast(o_orderkey as string) when 'F' then concat('abc', o_orderkey)
           else concat(o_orderkey, '.5') end""").alias("raw_id"))
    return texts.select("o_orderkey", "raw_id", C.safe_id(F.col("raw_id")).alias("group_id"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN CAST(epoch(o_orderdate) AS BIGINT) END AS created_at
FROM orders""")
def safe_timestamp_cast(t: Tables) -> DataFrame:
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    text = F.when(F.col("o_orderstatus") == "F", F.concat(F.substring(day, 1, 8))).otherwise(
        F.concat(day, F.lit("T00:00:00Z"))
    )
    return t.orders.select("o_orderkey", F.unix_seconds(C.safe_timestamp(text)).alias("created_at"))


@query("""WITH minor AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS units, o_orderpriority, o_orderstatus
               FROM orders)
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN NULL
    WHEN o_orderpriority = '1-URGENT' THEN units * CAST(0.001 AS DECIMAL(4,3))
    WHEN o_orderpriority = '2-HIGH' THEN units * CAST(1 AS DECIMAL(4,3))
    ELSE units * CAST(0.01 AS DECIMAL(4,3)) END AS DECIMAL(18,2)) AS original_amount
FROM minor""")
def minor_unit_amount(t: Tables) -> DataFrame:
    """Exponents 3, 0 (absent) and 2; some amounts are no numbers."""
    amount = F.expr("""if(o_orderstatus = 'F' and o_orderpriority = '5-LOW', 'n/a',
                          cast(cast(round(o_totalprice * 100) as bigint) as string))""")
    exponent = F.expr("case o_orderpriority when '1-URGENT' then '3' when '2-HIGH' then null else '2' end")
    return t.orders.select("o_orderkey", C.minor_units(amount, exponent).alias("original_amount"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE)
       WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 1 END AS transaction_date FROM orders""")
def coalesce_date(t: Tables) -> DataFrame:
    """The transaction's own date, else the day it occurred, else none."""
    own = F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate").cast("string"))
    occurred = F.when(
        F.col("o_orderstatus") == "F",
        F.concat(F.date_add("o_orderdate", 1).cast("string"), F.lit("T23:59:59.000+00:00")),
    )
    return t.orders.select("o_orderkey", C.day_of(F.coalesce(own, occurred)).alias("transaction_date"))


@query("""SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS rate_date FROM lineitem""")
def fx_date_key(t: Tables) -> DataFrame:
    """The day as written, whatever the zone offset behind it."""
    text = F.concat(F.substring(F.col("l_shipdate").cast("string"), 1, 10), F.lit("T23:30:00.000-08:00"))
    return t.lineitem.select("l_orderkey", "l_linenumber", C.day_of(text).alias("rate_date"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN -1 ELSE 2 END AS n_ids,
       CASE WHEN l_returnflag <> 'N' THEN l_partkey + l_suppkey END AS id_sum,
       2 AS n_members FROM lineitem""")
def array_field_extract(t: Tables) -> DataFrame:
    """Ids of an array of structs, and of a struct that holds the array."""
    nested = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.expr("""if(l_returnflag = 'N', null, array(named_struct('id', cast(l_partkey as string)),
                                                   named_struct('id', cast(l_suppkey as string))))""").alias("users"),
        F.struct(F.array("l_partkey", "l_suppkey").alias("id")).alias("members"),
    )
    ids = C.array_field_ids(nested, "users.id")
    return nested.select(
        "l_orderkey",
        "l_linenumber",
        F.coalesce(F.size(ids), F.lit(-1)).alias("n_ids"),
        F.aggregate(ids, F.lit(0).cast("bigint"), lambda total, item: total + item).alias("id_sum"),
        F.size(C.array_field_ids(nested, "members.id")).alias("n_members"),
    ).withColumn("n_ids", F.expr("if(n_ids < 0, -1, n_ids)"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 2 END AS n_members FROM orders""")
def null_array_to_empty(t: Tables) -> DataFrame:
    nested = t.orders.select(
        "o_orderkey", F.expr("if(o_orderstatus = 'P', null, array(o_custkey, o_orderkey))").alias("agent_ids")
    )
    return nested.select("o_orderkey", F.size(C.member_ids(nested)).alias("n_members"))


@query("""SELECT l_orderkey, l_linenumber, 3 AS n_items, l_partkey AS first_id, l_suppkey AS last_id FROM lineitem""")
def csv_to_array(t: Tables) -> DataFrame:
    """Ids from a comma list; the item in the middle is no number and becomes null."""
    ids = C.csv_to_array(F.concat_ws(",", "l_partkey", F.lit("x"), "l_suppkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", ids.alias("ids")).select(
        "l_orderkey", "l_linenumber", F.size("ids").alias("n_items"), F.col("ids")[0].alias("first_id"),
        F.col("ids")[2].alias("last_id"),
    )


@query("""SELECT o_orderkey AS group_id, o_custkey AS user_id FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, o_custkey + 1 FROM orders WHERE o_orderstatus = 'O'""")
def explode_members(t: Tables) -> DataFrame:
    """Repeated members count once; groups without members or with a null list give no row."""
    groups = t.orders.select(
        F.col("o_orderkey").alias("group_id"),
        F.expr("""case o_orderstatus when 'O' then array(o_custkey, o_custkey + 1, o_custkey)
                  when 'F' then cast(array() as array<bigint>) end""").alias("user_ids"),
    )
    return L.explode_members(groups)


@query("""SELECT o_orderkey AS user_id, o_custkey, o_orderpriority AS role_id FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, o_custkey, '0-BASIC' FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, o_custkey, NULL FROM orders WHERE o_orderstatus <> 'O'""")
def explode_outer_roles(t: Tables) -> DataFrame:
    users = t.orders.select(
        F.col("o_orderkey").alias("user_id"),
        "o_custkey",
        F.expr("""case o_orderstatus when 'O' then array(o_orderpriority, '0-BASIC')
                  when 'F' then cast(array() as array<string>) end""").alias("role_ids"),
    )
    return L.explode_roles(users)

"""The forest of groups: orders stand for groups, each below the order of half its number.

Members are the parts of an order; a part of size 50 is an active user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.reconciliation import part_users
from tidemark.catalog.registry import Tables, query
from tidemark.operators import activity as A
from tidemark.operators import hierarchy as H
from tidemark.operators import links as L
from tidemark.scratch import materialize

HEAP = "if(o_orderkey > 0, (o_orderkey - 1) div 2, null)"
HEAP_SQL = "CASE WHEN o_orderkey > 0 THEN (o_orderkey - 1) // 2 END"


def forest(t: Tables, parent: str = HEAP) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("group_id"), F.expr(parent).alias("parent_group_id"))


def edges(t: Tables, parent: str = HEAP) -> DataFrame:
    return H.forest_edges(forest(t, parent), "group_id", "parent_group_id")


PROPAGATED_SQL = f"""WITH RECURSIVE edges AS (SELECT o_orderkey AS child, {HEAP_SQL} AS parent FROM orders),
live AS (SELECT DISTINCT l_orderkey AS node FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size = 50
         UNION
         SELECT e.parent FROM live JOIN edges e ON e.child = live.node WHERE e.parent IS NOT NULL)
SELECT o_orderkey AS group_id,
       CASE WHEN o_orderkey IN (SELECT node FROM live) THEN 'active' ELSE 'inactive' END AS status
FROM orders"""


def order_activity(t: Tables, method: str) -> DataFrame:
    members = t.lineitem.select(F.col("l_orderkey").alias("group_id"), F.col("l_partkey").alias("user_id"))
    direct = L.direct_activity(L.member_status(members, part_users(t)))
    return H.group_activity(forest(t), direct, method)


@query(PROPAGATED_SQL)
def hierarchy_propagate(t: Tables) -> DataFrame:
    return order_activity(t, "auto")


@query(PROPAGATED_SQL)
def hierarchy_propagate_doubling(t: Tables) -> DataFrame:
    return order_activity(t, "doubling")


@query(f"""WITH RECURSIVE edges AS (SELECT o_orderkey AS child, {HEAP_SQL} AS parent FROM orders),
up AS (SELECT child AS node, parent AS ancestor, 1 AS depth FROM edges WHERE parent IS NOT NULL
       UNION ALL
       SELECT u.node, e.parent, u.depth + 1 FROM up u JOIN edges e ON e.child = u.ancestor
       WHERE e.parent IS NOT NULL)
SELECT node, ancestor, depth FROM up""")
def hierarchy_closure(t: Tables) -> DataFrame:
    return H.closure(edges(t)).select("node", "ancestor", "depth")


@query(f"""WITH RECURSIVE edges AS (SELECT o_orderkey AS child, {HEAP_SQL} AS parent FROM orders),
down AS (SELECT o_orderkey AS start, o_orderkey AS node, 0 AS depth FROM orders WHERE o_totalprice > 450000
         UNION ALL
         SELECT d.start, e.child, d.depth + 1 FROM down d JOIN edges e ON e.parent = d.node)
SELECT start, node, depth FROM down WHERE depth > 0""")
def hierarchy_descendants(t: Tables) -> DataFrame:
    starts = t.orders.filter("o_totalprice > 450000").select("o_orderkey")
    return H.descendants(edges(t), starts)


# Pending orders point at their neighbour instead: two pending neighbours form a cycle.
LOOPED = f"if(o_orderstatus = 'P', o_orderkey ^ 1, {HEAP})"
LOOPED_SQL = f"CASE WHEN o_orderstatus = 'P' THEN xor(o_orderkey, 1) ELSE {HEAP_SQL} END"


@query(f"""WITH RECURSIVE edges AS (SELECT o_orderkey AS child, {LOOPED_SQL} AS parent FROM orders),
walk AS (SELECT child AS start, parent AS node FROM edges WHERE parent IS NOT NULL
         UNION
         SELECT w.start, e.parent FROM walk w JOIN edges e ON e.child = w.node WHERE e.parent IS NOT NULL)
SELECT DISTINCT start AS node FROM walk WHERE start = node""")
def hierarchy_cycles(t: Tables) -> DataFrame:
    return H.find_cycles(edges(t, LOOPED))


@query(f"""WITH RECURSIVE edges AS (SELECT o_orderkey AS child, {LOOPED_SQL} AS parent FROM orders),
up AS (SELECT child AS node, parent AS ancestor, 1 AS depth FROM edges WHERE parent IS NOT NULL
       UNION
       SELECT u.node, e.parent, u.depth + 1 FROM up u JOIN edges e ON e.child = u.ancestor
       WHERE e.parent IS NOT NULL AND u.depth < 40)
SELECT node, ancestor, min(depth) AS depth, node = ancestor AS in_cycle FROM up GROUP BY node, ancestor""")
def hierarchy_cyclic_closure(t: Tables) -> DataFrame:
    """Ancestors in a graph with cycles: chains that lead into one meet each of its nodes once."""
    return H.closure(edges(t, LOOPED)).select("node", "ancestor", "depth", "in_cycle")


def _counts_sql(parent: str, lines: str) -> str:
    return f"""WITH RECURSIVE edges AS (SELECT o_orderkey AS child, {parent} AS parent FROM orders),
live AS (SELECT l_orderkey AS node, count(DISTINCT l_partkey) AS n FROM lineitem JOIN part ON p_partkey = l_partkey
         WHERE p_size = 50 AND {lines} GROUP BY l_orderkey),
up AS (SELECT node, node AS ancestor, n FROM live
       UNION ALL SELECT u.node, e.parent, u.n FROM up u JOIN edges e ON e.child = u.ancestor WHERE e.parent IS NOT NULL),
sums AS (SELECT ancestor, sum(n) AS below FROM up GROUP BY ancestor)
SELECT child AS group_id, parent AS parent_group_id, CAST(coalesce(n, 0) AS BIGINT) AS direct, CAST(coalesce(below, 0) AS BIGINT) AS below
FROM edges LEFT JOIN live ON node = child LEFT JOIN sums ON ancestor = child"""


def order_members(t: Tables, lines: str) -> DataFrame:
    members = t.lineitem.filter(lines).select(F.col("l_orderkey").alias("group_id"), F.col("l_partkey").alias("user_id"))
    return A.direct_counts(L.member_status(members, part_users(t)))


@query(_counts_sql(HEAP_SQL, "true"))
def activity_counts(t: Tables) -> DataFrame:
    """Active members of every group and of all below it together."""
    return A.count_activity(forest(t), order_members(t, "true"))


# On the second day pending orders stand two levels higher, and returned lines are no members any more.
MOVED = f"if(o_orderstatus = 'P', if(o_orderkey > 3, (o_orderkey - 1) div 4, null), {HEAP})"
MOVED_SQL = f"CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey > 3 THEN (o_orderkey - 1) // 4 END ELSE {HEAP_SQL} END"


@query(_counts_sql(MOVED_SQL, "l_returnflag <> 'R'"))
def activity_counts_update(t: Tables) -> DataFrame:
    """The counts after a second day, from those of the first: only ancestors of what changed are counted anew."""
    stored = materialize(A.count_activity(forest(t), order_members(t, "true")), "counts")
    return A.update_activity(stored, forest(t, MOVED), order_members(t, "l_returnflag <> 'R'"))[0]

"""Activity kept up from day to day: counts of active members per group and everything below, changed only above what changed.

``forest`` is ``group_id, parent_group_id`` with one row per group. Counts are a table ``group_id, parent_group_id, direct, below``: the
active direct members of a group, and those of the group and all groups under it together. A group is active when ``below`` is
not zero. Groups on a cycle are all above each other, so they share one count.

A full count takes a few rounds, each over the groups not yet counted. An update reads the stored counts, finds the groups
whose members, parent or existence changed, and counts anew only those and their ancestors of yesterday and today. All other
groups keep their row; as children they enter with the count they have.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.hierarchy import PEELED_SHARE, ROUND_LIMIT, NoConvergence, forest_edges, propagate_up, rings
from tidemark.operators.reconcile import ACTIVE, INACTIVE
from tidemark.scratch import materialize, measured

COLUMNS = ["group_id", "parent_group_id", "direct", "below"]


def direct_counts(members: DataFrame) -> DataFrame:
    """``group_id, direct``: distinct active members; ``members(group_id, user_id, user_status)``."""
    live = members.filter(F.col("user_status") == ACTIVE).select("group_id", "user_id").distinct()
    return live.groupBy("group_id").agg(F.count(F.lit(1)).alias("direct"))


def _subtree_sums(values: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, below``: sums of ``values(node, own)`` over every node and all nodes below it, by doubling.

    A round adds, to each node, the sums of the nodes that stand exactly as far below it as its own sum reaches.
    """
    pointed = values.join(edges, F.col("node") == F.col("child"), "left").select("node", F.col("own").alias("below"), F.col("parent").alias("up"))
    # A parent outside of the values takes part in nothing.
    known = values.select(F.col("node").alias("_known"))
    state, seen = measured(
        pointed.join(known, F.col("up") == F.col("_known"), "left").select("node", "below", F.col("_known").alias("up")), "sums",
        going=F.count_if(F.col("up").isNotNull()),
    )
    for _ in range(ROUND_LIMIT):
        if not seen["going"]:
            return state.select("node", "below")
        # Combined before the shuffle, so a parent of very many groups gets few rows.
        arriving = state.filter("up is not null").groupBy(F.col("up").alias("_to")).agg(F.sum("below").alias("_more"))
        onward = state.select(F.col("node").alias("_node"), F.col("up").alias("_up"))
        moved = state.join(arriving, F.col("node") == F.col("_to"), "left").join(onward, F.col("up") == F.col("_node"), "left")
        state, seen = measured(
            moved.select("node", (F.col("below") + F.coalesce("_more", F.lit(0))).alias("below"), F.col("_up").alias("up")), "sums",
            going=F.count_if(F.col("up").isNotNull()),
        )
    raise NoConvergence("sums did not settle")


def _counted(values: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, below``: sums of ``values(node, own)`` over every node and all nodes below it, the nodes of a cycle taken as one.

    ``edges`` must lead from nodes to nodes of ``values``. Leaves hand their sums on and are done, again and again: a bushy forest
    leaves a fraction of its rows each round, so all rounds together shuffle little more than the first. Chains and cycles, where a round ends
    less than an eighth, are left to doubling.
    """
    kids = edges.groupBy(F.col("parent").alias("_parent")).agg(F.count(F.lit(1)).alias("kids"))
    state = values.groupBy("node").agg(F.sum("own").alias("below"), F.count(F.lit(1)).alias("times")).join(
        edges.select(F.col("child").alias("_child"), F.col("parent").alias("up")), F.col("node") == F.col("_child"), "left"
    ).join(kids, F.col("node") == F.col("_parent"), "left").select("node", "below", "up", F.coalesce("kids", F.lit(0)).alias("kids"), "times")
    state, seen = measured(state, "leaves", ended=F.count_if(F.col("kids") == 0), times=F.max("times"))
    if (seen["times"] or 0) > 1:
        # Groups with several rows: every way up has rows of its own.
        return _counted_around(values, edges)
    done = []
    while seen["rows"] and seen["ended"] * PEELED_SHARE >= seen["rows"]:
        leaves = state.filter("kids = 0")
        done.append(leaves.select("node", "below"))
        handed = leaves.filter("up is not null").groupBy(F.col("up").alias("_to")).agg(F.sum("below").alias("_more"), F.count(F.lit(1)).alias("_ended"))
        state, seen = measured(state.filter("kids > 0").join(handed, F.col("node") == F.col("_to"), "left").select(
            "node", (F.col("below") + F.coalesce("_more", F.lit(0))).alias("below"), "up", (F.col("kids") - F.coalesce("_ended", F.lit(0))).alias("kids")
        ), "leaves", ended=F.count_if(F.col("kids") == 0))
    if seen["rows"] or not done:
        left = state.filter("up is not null").select(F.col("node").alias("child"), F.col("up").alias("parent"))
        done.append(_counted_around(state.select("node", F.col("below").alias("own")), left))
    return reduce(DataFrame.unionByName, done)


def _counted_around(values: DataFrame, edges: DataFrame) -> DataFrame:
    """As ``_counted``, by doubling over the cycles taken as one node each."""
    circles = materialize(rings(edges.withColumn("length", F.lit(1).cast("bigint"))).select(F.col("node").alias("_node"), "ring"), "circles")
    owned = materialize(values.join(circles, F.col("node") == F.col("_node"), "left").select("node", "own", F.coalesce("ring", "node").alias("ring")), "owned")
    child, parent = circles.toDF("_c", "_child_ring"), circles.toDF("_p", "_parent_ring")
    between = edges.join(child, F.col("child") == F.col("_c"), "left").join(parent, F.col("parent") == F.col("_p"), "left").select(
        F.coalesce("_child_ring", "child").alias("child"), F.coalesce("_parent_ring", "parent").alias("parent")
    ).filter("child <> parent")
    whole = owned.groupBy(F.col("ring").alias("node")).agg(F.sum("own").alias("own"))
    sums = _subtree_sums(materialize(whole, "whole"), materialize(between, "between"))
    return owned.join(sums.withColumnRenamed("node", "ring"), "ring").select("node", "below")


def count_activity(forest: DataFrame, direct: DataFrame) -> DataFrame:
    """Counts of the whole ``forest``, from ``direct(group_id, direct)``."""
    groups = materialize(forest.select("group_id", "parent_group_id").join(direct, "group_id", "left").select(
        "group_id", "parent_group_id", F.coalesce("direct", F.lit(0)).cast("bigint").alias("direct")
    ), "forest")
    known = groups.select(F.col("group_id").alias("parent"))
    edges = materialize(forest_edges(groups, "group_id", "parent_group_id").join(known, "parent", "left_semi"), "edges")
    sums = _counted(groups.select(F.col("group_id").alias("node"), F.col("direct").alias("own")), edges.select("child", "parent"))
    return groups.join(sums.withColumnRenamed("node", "group_id"), "group_id").select(*COLUMNS)


def update_activity(stored: DataFrame, forest: DataFrame, direct: DataFrame, method: str = "frontier") -> tuple[DataFrame, DataFrame]:
    """The counts after a day, and the rows of them that were counted anew.

    ``stored`` are the counts of the day before (a written table), ``forest`` and ``direct`` the day's. ``method`` is how ancestors are found, see
    ``propagate_up``: the frontier touches only the changed groups' ancestors, one round a level.
    """
    now = forest.select("group_id", "parent_group_id").join(direct, "group_id", "left").select(
        "group_id", "parent_group_id", F.coalesce("direct", F.lit(0)).cast("bigint").alias("direct"), F.lit(True).alias("_now")
    )
    old = stored.select(
        "group_id", F.col("parent_group_id").alias("_parent"), F.col("direct").alias("_direct"), F.col("below").alias("_below"), F.lit(True).alias("_old")
    )
    both = now.join(old, "group_id", "full_outer")
    same = (
        F.col("_now").isNotNull() & F.col("_old").isNotNull() & F.col("parent_group_id").eqNullSafe(F.col("_parent"))
        & (F.col("direct") == F.col("_direct"))
    )
    both = materialize(both.withColumn("_changed", ~F.coalesce(same, F.lit(False))), "both")
    changed = both.filter("_changed").select(F.col("group_id").alias("node"))
    current, before = both.filter("_now"), both.filter("_old")
    edges = forest_edges(current, "group_id", "parent_group_id")
    # A group whose parent came or went keeps its pointer, but the parent is among the changed ones, and its count is.
    then = forest_edges(before, "group_id", "_parent")
    if method == "frontier":
        # Pointers of yesterday and today differ only at changed groups, which are seeds: one walk over both finds what two would.
        other = forest_edges(before.filter("_changed and not (_parent <=> parent_group_id)"), "group_id", "_parent")
        touched = propagate_up(edges.unionByName(other), changed, method)
    else:
        touched = propagate_up(edges, changed, method).unionByName(propagate_up(then, changed, method)).distinct()
    touched = materialize(touched.withColumn("_touched", F.lit(True)), "touched")
    marked = materialize(current.join(touched, F.col("group_id") == F.col("node"), "left").drop("node"), "marked")
    again, rest = marked.filter("_touched"), marked.filter("_touched is null")
    # Children that are not touched bring what they had.
    brought = rest.filter(F.col("parent_group_id").isNotNull() & (F.col("parent_group_id") != F.col("group_id"))).groupBy(
        F.col("parent_group_id").alias("_to")
    ).agg(F.sum("_below").alias("_more"))
    values = again.join(brought, F.col("group_id") == F.col("_to"), "left").select(
        F.col("group_id").alias("node"), (F.col("direct") + F.coalesce("_more", F.lit(0))).alias("own")
    )
    values = materialize(values, "values")
    inside = forest_edges(again, "group_id", "parent_group_id").join(values.select(F.col("node").alias("parent")), "parent", "left_semi")
    sums = _counted(values, materialize(inside.select("child", "parent"), "edges"))
    fresh = materialize(again.join(sums.withColumnRenamed("node", "group_id"), "group_id").select(*COLUMNS), "fresh")
    return rest.select("group_id", "parent_group_id", "direct", F.col("_below").alias("below")).unionByName(fresh), fresh


def status_of(counts: DataFrame) -> DataFrame:
    """``group_id, status`` from counts."""
    return counts.select("group_id", F.when(F.col("below") > 0, F.lit(ACTIVE)).otherwise(F.lit(INACTIVE)).alias("status"))

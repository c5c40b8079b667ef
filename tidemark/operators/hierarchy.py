"""Forests given as parent pointers: activity spread upward, ancestor closure, cycles.

``edges`` always means (child, parent) with one parent per child; roots have no edge or a null parent. Every loop
writes each round as a table in the shared scratch folder (``tidemark.scratch``), so lineage stays short, a lost
executor costs one round at most, and Spark knows from the file sizes when a frontier is small enough to broadcast.
The driver only ever sees one row count per round.

Joins here have at most one row per key on one side (a node has one parent), so a parent that very many chains
run through makes only the other side uneven; adaptive execution splits that side.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, functions as F

from tidemark.scratch import Rounds, counted, materialize, measured

# A level costs one scan of the edges, a doubling round about four (it shuffles them). How deep a forest is shows
# only on the way, so levels are climbed until they have cost about as much as doubling would have.
LEVELS_BEFORE_DOUBLING = 20
# A doubling loop covers 2**rounds levels, so no data that fits anywhere gets this far.
ROUND_LIMIT = 64
# Leaves are taken away while a round takes at least one in so many of the rows left; a round costs about an eighth of doubling.
PEELED_SHARE = 8


class NoConvergence(RuntimeError):
    """A doubling loop did not settle within ROUND_LIMIT rounds."""


def forest_edges(nodes: DataFrame, key: str, parent: str) -> DataFrame:
    """(child, parent) of every node that has a parent other than itself."""
    return nodes.select(F.col(key).alias("child"), F.col(parent).alias("parent")).filter(
        F.col("parent").isNotNull() & (F.col("child") != F.col("parent"))
    )


def _written_edges(edges: DataFrame) -> DataFrame:
    return materialize(
        edges.select("child", "parent").filter(F.col("child").isNotNull() & F.col("parent").isNotNull()), "edges"
    )


def _double(jumps: DataFrame) -> DataFrame:
    """A jump table composed with itself: twice as far; chains that end on the way drop out."""
    onward = jumps.select(F.col("child").alias("_at"), F.col("parent").alias("_to"))
    return jumps.join(onward, F.col("parent") == F.col("_at")).select("child", F.col("_to").alias("parent"))


# -- activity ---------------------------------------------------------------------------------------------------


def _climb(edges: DataFrame, seeds: DataFrame, levels: int | None) -> tuple[DataFrame, bool]:
    """Frontier walk: each round only the nodes found last move up one level."""
    reached = Rounds(edges.sparkSession, "climb")
    reached.add(seeds)
    for _ in range(levels) if levels is not None else count():
        parents = reached.last().join(edges, F.col("node") == F.col("child")).select(F.col("parent").alias("node"))
        if not reached.add(parents.distinct().join(reached.all(), "node", "left_anti")):
            return reached.all(), True
    return reached.all(), False


def _spread(edges: DataFrame, reached: DataFrame) -> DataFrame:
    """Pointer doubling: rounds grow with the logarithm of the depth."""
    jumps, size = edges, reached.count()
    for _ in range(ROUND_LIMIT):
        landed = reached.join(jumps, F.col("node") == F.col("child")).select(F.col("parent").alias("node"))
        reached, grown = counted(reached.unionByName(landed).distinct(), "reached")
        if grown == size:
            return reached
        size = grown
        jumps = materialize(_double(jumps), "jumps")
    raise NoConvergence("activity did not settle")


def propagate_up(edges: DataFrame, seeds: DataFrame, method: str = "doubling") -> DataFrame:
    """Seeds and all their ancestors as column ``node``; cycles are harmless, the set only grows.

    ``frontier`` takes one round per level and touches only new nodes; ``doubling`` takes about log2(depth)
    rounds over the jump table, whatever the forest's shape; ``auto`` climbs a few levels first and doubles from there
    when the forest turns out to be deep.
    """
    if method not in ("auto", "frontier", "doubling"):
        raise ValueError(f"unknown method {method!r}")
    edges = _written_edges(edges)
    reached = seeds.select(F.col(seeds.columns[0]).alias("node")).distinct()
    if method != "doubling":
        reached, settled = _climb(edges, reached, LEVELS_BEFORE_DOUBLING if method == "auto" else None)
        if settled:
            return reached
    return _spread(edges, materialize(reached, "reached"))


def group_activity(groups: DataFrame, direct: DataFrame, method: str = "doubling") -> DataFrame:
    """(group_id, status): active when the group or any group below it has an active direct member."""
    seeds = direct.filter("has_active_member").select("group_id")
    live = propagate_up(forest_edges(groups, "group_id", "parent_group_id"), seeds, method)
    mark = live.select(F.col("node").alias("group_id"), F.lit(True).alias("_live"))
    status = F.when(F.col("_live"), F.lit("active")).otherwise(F.lit("inactive"))
    return groups.join(mark, "group_id", "left").select("group_id", status.alias("status"))


# -- cycles -----------------------------------------------------------------------------------------------------


def leading_into_cycles(edges: DataFrame) -> DataFrame:
    """Edges of the nodes whose chain of parents never ends: those on a cycle and those below one.

    After k doublings exactly the nodes with a chain of at least 2**k parents are left. A chain that ends passes
    through every shorter length on its way, so once a doubling drops no node, no chain left can end. Rounds: about
    log2 of the deepest proper chain.
    """
    edges = _written_edges(edges)
    jumps, left = edges, None
    for _ in range(ROUND_LIMIT):
        jumps, remaining = counted(_double(jumps), "jumps")
        if remaining in (0, left):
            return materialize(edges.join(jumps.select("child"), "child", "left_semi"), "trapped")
        left = remaining
    raise NoConvergence("chains did not settle")


def _without_leaves(edges: DataFrame) -> tuple[DataFrame, bool]:
    """Written ``edges`` without those of nodes that nothing stands below, taken away again and again; whether none of these is left.

    What is left holds every cycle, and is the cycles if no leaf is left. In a bushy forest each round leaves a fraction of the
    rows, so all rounds together cost little more than the first; when one takes less than an eighth, the rest is left to doubling,
    so that a chain doesn't go node by node.
    """
    left, size = edges, None
    for _ in count():
        above = left.select(F.col("parent").alias("child")).distinct()
        left, kept = counted(left.join(above, "child", "left_semi").select("child", "parent"), "core")
        if not kept or kept == size:
            return left, True
        if size is not None and (size - kept) * PEELED_SHARE < size:
            return left, False
        size = kept


def find_cycles(edges: DataFrame) -> DataFrame:
    """``node`` of every node that lies on a cycle, whatever its length.

    Leaves are taken away as long as that shrinks the graph. Among the nodes left that lead into cycles, the images of ever longer
    jumps shrink to the cycles themselves; a set is down to cycles when the parent pointer maps it one to one onto itself.
    """
    core, bare = _without_leaves(_written_edges(edges))
    if bare:
        return materialize(core.select(F.col("child").alias("node")).distinct(), "image")
    trapped = leading_into_cycles(core.distinct())
    jumps = trapped
    for _ in range(ROUND_LIMIT):
        image, nodes = counted(jumps.select(F.col("parent").alias("node")).distinct(), "image")
        parents = image.join(trapped, F.col("node") == F.col("child")).select("parent").distinct().count()
        if nodes == parents:
            return image
        jumps = materialize(_double(jumps), "jumps")
    raise NoConvergence("cycles did not settle")


# -- ancestors and descendants ----------------------------------------------------------------------------------


def closure(edges: DataFrame, with_path: bool = False) -> DataFrame:
    """(node, ancestor, depth, in_cycle) for every node and each of its ancestors, at any depth.

    One row per pair that really is related, so the size is nodes times their depth. Composing paths doubles the
    covered depth each round. A node that leads into a cycle meets the cycle's nodes once each, at their shortest
    distance; ``in_cycle`` marks the pair of such a node with itself. ``with_path`` adds the chain of nodes
    from the node to the ancestor.
    """
    return _closure(_written_edges(edges), with_path)


def _closure(edges: DataFrame, with_path: bool = False) -> DataFrame:
    """As ``closure``, over written ``edges(child, parent)``; with a column ``length``, also ``distance``, the lengths on the way together."""
    cycles = find_cycles(edges)
    pairs = _proper(edges, with_path) if cycles.isEmpty() else _around(edges, cycles, with_path)
    return pairs.withColumn("in_cycle", F.col("node") == F.col("ancestor"))


def _proper(edges: DataFrame, with_path: bool) -> DataFrame:
    """Pairs of written ``edges`` without cycles. Columns of ``edges`` that begin with ``_`` are handed down to all pairs with that ancestor."""
    known = Rounds(edges.sparkSession, "pairs")
    known.add(_as_pairs(edges, with_path))
    reach = 1
    for _ in range(ROUND_LIMIT):
        outermost = known.all().filter(F.col("depth") == reach)
        reach *= 2
        known.add(_extend(outermost, known.all()), at_reach=F.count_if(F.col("depth") == reach))
        if not known.seen["at_reach"]:
            return known.all()
    raise NoConvergence("closure did not settle")


def _as_pairs(edges: DataFrame, with_path: bool) -> DataFrame:
    columns = [F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("depth")]
    if "length" in edges.columns:
        columns.append(F.col("length").alias("distance"))
    if with_path:
        columns.append(F.array("child", "parent").alias("path"))
    return edges.select(*columns, *[c for c in edges.columns if c.startswith("_")])


def _extend(lower: DataFrame, upper: DataFrame) -> DataFrame:
    """Pairs of ``lower`` carried on from their ancestor by the pairs of ``upper``."""
    carried = upper.select(*[F.col(c).alias(f"_up_{c}") for c in upper.columns])
    columns = [F.col("node"), F.col("_up_ancestor").alias("ancestor"), (F.col("depth") + F.col("_up_depth")).alias("depth")]
    if "distance" in lower.columns:
        columns.append((F.col("distance") + F.col("_up_distance")).alias("distance"))
    if "path" in lower.columns:
        tail = F.slice(F.col("_up_path"), F.lit(2), F.size("_up_path"))
        columns.append(F.concat("path", tail).alias("path"))
    columns += [F.col(f"_up_{c}").alias(c) for c in lower.columns if c.startswith("_")]
    # Of the lower pairs only these columns are read, so nothing more is shuffled.
    read = [c for c in lower.columns if not c.startswith("_")]
    return lower.select(*read).join(carried, F.col("ancestor") == F.col("_up_node")).select(*columns)


def rings(edges: DataFrame) -> DataFrame:
    """``node, ring, place, size, way, round``: the place of every node of a cycle on it.

    ``ring`` is the cycle's least node. ``place`` counts the steps from a node up to it (0 for the least node itself), ``size`` the nodes
    of the cycle; ``way`` and ``round`` are the same in lengths of ``edges(child, parent, length)``. From a node to another one
    of its cycle it is ``place - place`` steps, modulo the size. Rounds: about log2 of the longest cycle.
    """
    return _rings(edges, find_cycles(edges))


def _rings(edges: DataFrame, cycles: DataFrame) -> DataFrame:
    """``rings`` of ``edges`` whose ``cycles(node)`` are known."""
    inside = materialize(edges.join(cycles, F.col("child") == F.col("node"), "left_semi").select("child", "parent", "length"), "ring")
    # The least of the 2**k nodes from each one on; when a round changes none, every window has the least of its cycle.
    lows = inside.select("child", F.col("parent").alias("at"), F.col("child").alias("low"))
    for _ in range(ROUND_LIMIT):
        onward = lows.select(F.col("child").alias("_child"), F.col("at").alias("_at"), F.col("low").alias("_low"))
        lower = F.col("_low") < F.col("low")
        lows, seen = measured(lows.join(onward, F.col("at") == F.col("_child")).select(
            "child", F.col("_at").alias("at"), F.least("low", "_low").alias("low"), lower.alias("fell")
        ), "lows", fell=F.count_if("fell"))
        if not seen["fell"]:
            break
        lows = lows.drop("fell")
    else:
        raise NoConvergence("cycles did not settle")
    owner = lows.select(F.col("child").alias("node"), F.col("low").alias("ring"))
    # From the least node its own mark is met again after the whole way around.
    steps = materialize(nearest_marked(inside, owner.select(F.col("ring").alias("node")).distinct()), "steps")
    whole = steps.filter("node = mark").select(F.col("mark").alias("ring"), F.col("depth").alias("size"), F.col("distance").alias("round"))
    first = F.col("node") == F.col("mark")
    placed = steps.select(
        "node", F.col("mark").alias("ring"), F.when(first, 0).otherwise(F.col("depth")).alias("place"),
        F.when(first, 0).otherwise(F.col("distance")).alias("way"),
    )
    return placed.join(whole, "ring").select("node", "ring", "place", "size", "way", "round")


def _around(edges: DataFrame, cycles: DataFrame, with_path: bool) -> DataFrame:
    """Closure of ``edges`` with ``cycles(node)``: chains up to where they meet a cycle by composing, pairs with its nodes from their places on it."""
    far = "length" in edges.columns
    lengths = edges if far else edges.withColumn("length", F.lit(1).cast("bigint"))
    placed = materialize(_rings(lengths, cycles), "rings")
    entries = placed.select(F.col("node").alias("parent"), F.lit(True).alias("_met"))
    # The edges of cycle nodes are left out here, so every chain ends where it meets its cycle.
    tails = edges.join(cycles, F.col("child") == F.col("node"), "left_anti").join(entries, "parent", "left").select(
        *edges.columns, F.coalesce("_met", F.lit(False)).alias("_entry")
    )
    proper = _proper(materialize(tails, "tails"), with_path)
    own = [F.lit(0).cast("bigint").alias("distance")] if far else []
    own += [F.array("node").alias("path")] if with_path else []
    entered = proper.filter("_entry").drop("_entry").unionByName(
        placed.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth"), *own)
    )
    start = placed.select(F.col("node").alias("ancestor"), "ring", *[F.col(c).alias(f"_{c}") for c in ("place", "way")])
    steps, way = F.pmod(F.col("_place") - F.col("place"), F.col("size")), F.pmod(F.col("_way") - F.col("way"), F.col("round"))
    # A node on a cycle meets itself after a whole round; one below has met its entry already.
    back = steps == 0
    met = entered.join(start, "ancestor").join(placed.withColumnRenamed("node", "_met"), "ring").filter(~back | (F.col("depth") == 0))
    columns = [
        F.col("node"), F.col("_met").alias("ancestor"), (F.col("depth") + F.when(back, F.col("size")).otherwise(steps)).cast("int").alias("depth"),
    ]
    if far:
        columns.append((F.col("distance") + F.when(back, F.col("round")).otherwise(way)).alias("distance"))
    if with_path:
        # As long as the longest path asked for: the cycle twice over, in the direction of the parents.
        ordered = F.transform(F.sort_array(F.collect_list(F.struct("place", "node")), asc=False), lambda x: x["node"])
        once = placed.groupBy("ring").agg(ordered.alias("_ring"))
        met = met.join(once, "ring")
        taken = F.when(back, F.col("size")).otherwise(steps).cast("int")
        twice = F.concat("_ring", "_ring")
        columns.append(F.concat("path", F.slice(twice, (F.col("size") - F.col("_place") + 1).cast("int"), taken)).alias("path"))
    return proper.drop("_entry").unionByName(met.select(*columns))


# -- nearest marked ancestor and descendants ---------------------------------------------------------------------


def nearest_marked(edges: DataFrame, marks: DataFrame) -> DataFrame:
    """(node, mark, depth, distance): the nearest marked ancestor of every node that has one, itself not counted.

    Pointers double until they stand on a mark or their chain ends: about log2 of the longest way to a mark, whatever the
    depth of the forest. Chains that turn in a cycle without marks are given up when a round ends none of the others.
    """
    spark_edges = edges if "length" in edges.columns else edges.withColumn("length", F.lit(1).cast("bigint"))
    held = materialize(marks.select(F.col(marks.columns[0]).alias("mark")).distinct(), "marks")
    jumps, seen = measured(spark_edges.join(held, F.col("parent") == F.col("mark"), "left").select(
        "child", F.col("parent").alias("at"), F.lit(1).alias("depth"), F.col("length").alias("distance"), F.col("mark").isNotNull().alias("done")
    ), "jumps", going=F.count_if(~F.col("done")))
    left = seen["going"]
    for _ in range(ROUND_LIMIT):
        if not left:
            break
        onward = jumps.select(*[F.col(c).alias(f"_{c}") for c in jumps.columns])
        moved = jumps.filter("not done").join(onward, F.col("at") == F.col("_child")).select(
            "child", F.col("_at").alias("at"), (F.col("depth") + F.col("_depth")).alias("depth"),
            (F.col("distance") + F.col("_distance")).alias("distance"), F.col("_done").alias("done"),
        )
        jumps, seen = measured(jumps.filter("done").unionByName(moved), "jumps", going=F.count_if(~F.col("done")))
        if seen["going"] == left:
            break
        left = seen["going"]
    else:
        raise NoConvergence("ways to the marks did not settle")
    return jumps.filter("done").select(F.col("child").alias("node"), F.col("at").alias("mark"), "depth", "distance")


def descendants(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(start, node, depth) for all nodes below the asked ones.

    Every node finds the nearest asked one above it; asked ones above that one follow from the closure of the asked ones
    alone. The rounds grow with the logarithm of the depth, and apart from the pointers every row made is a row of the result.
    """
    edges = _written_edges(edges)
    near = materialize(nearest_marked(edges, starts), "near")
    asked = starts.select(F.col(starts.columns[0]).alias("node")).distinct()
    between = near.join(asked, "node", "left_semi").select(F.col("node").alias("child"), F.col("mark").alias("parent"), F.col("distance").alias("length"))
    above = _closure(materialize(between, "between")).filter("not in_cycle").select(
        F.col("node").alias("mark"), F.col("ancestor").alias("start"), F.col("distance").alias("_further")
    )
    direct = near.select(F.col("mark").alias("start"), "node", "depth")
    further = near.join(above, "mark").select("start", "node", (F.col("distance") + F.col("_further")).cast("int").alias("depth"))
    # On a cycle the way leads back to the node itself.
    return direct.unionByName(further).filter("start <> node")

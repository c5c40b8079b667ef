"""Merkle dataset manifest: a hash tree over all documents, and a version of it for every changed leaf.

Each row is a leaf. Per source, leaves in order of doc_id form a tree in which every node is the hash of up to ``FAN`` consecutive
ones below it; the sources' roots, in order of the sources, form the tree above them. Nodes are lowercase hex SHA-256.

The tree is persistent: a change of one leaf gives a version that shares every node off the leaf's path with the original and
copies the ancestors alone.

1. Leaves (and changed leaves) are hashed by built-in functions where their rows are read; texts go no further.
2. Leaves are numbered within their source through a range-partitioned sort: numbers are places within a partition plus
   what earlier partitions hold, so a source of any size is spread over many tasks.
3. Aligned blocks of ``FAN ** DEPTH`` leaves are worked on one at a time in tasks. Within a block versions copy the
   ancestors of their leaf in memory.
4. Block roots go up level by level as grouped tables, ``FAN`` children a group, first to the sources' roots, then to the root. On the way every
   block keeps the shared nodes beside its path, one pair of texts per level.
5. A second pass over the blocks takes those along: versions go on from their block's copied root, and every leaf gets its proof.

Null values count as ``-``. Leaves without a doc_id come first in their source; rows that repeat a doc_id are leaves of their own, in order
of their hash. Rows without a source form a source of their own, the first one. Very long texts are hashed as they are. Extra columns are not
touched. Empty tables give empty results. A hash tree of many sources with few rows each has a long proof for each row: rows
then carry up to ``FAN - 1`` digests for every level above their source.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.scratch import materialize

FAN = 16
#: Levels of a block: 4,096 leaves, about 1 MB in a task.
DEPTH = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves of documents whose id has a checksum that this divides are changed.
TAMPER_EVERY = 5
_SIDES = "array<struct<left: string, right: string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(column: Column) -> Column:
    """A value with its length in front, so that no two rows read the same."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(**changed: Column) -> Column:
    """The hash of a row of ``FIELDS``, some of them changed."""
    return F.sha2(F.concat(*[field(changed.get(name, F.col(name))) for name in FIELDS]), 256)


def lowered(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered() -> Column:
    """The leaf after its text was lower-cased, for the documents chosen by the checksum of their id; null for others."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0
    return F.when(chosen, leaf_of(text=lowered(F.col("text"))))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` (a written table) with their ``place`` in their group, from 0, the group's ``size`` and the group's own number ``rank``.

    ``group`` is a text without nulls. Partitions are ranges of (group, order), so that a large group lies in many of them.
    """
    keys = [group, *order, "_tie"]
    # A written table has the same rows at the same places however often it is read, so this number settles ties for good.
    sorted_rows = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    local = materialize(sorted_rows.drop("_tie").withColumns({
        "_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    }), "sorted")
    # One row per partition and group in it: at most the number of partitions plus that of groups.
    runs = local.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    runs = materialize(runs.withColumns({
        "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "size": F.sum("_n").over(whole), "_first": F.min("_part").over(whole),
    }), "runs")
    # A group's number: groups that begin in earlier partitions, plus those that begin before it in its own.
    begun = runs.filter("_part = _first")
    counts = materialize(begun.groupBy("_part").agg(F.count(F.lit(1)).alias("_groups")), "groups")
    sums = counts.select("_part", F.coalesce(
        F.sum("_groups").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ).alias("_ahead"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy("_from")) - 1
    ranks = begun.withColumn("_own", own).join(sums, "_part").select(group, (F.col("_ahead") + F.col("_own")).alias("rank"))
    placed = runs.join(ranks, group).select(group, "_part", "size", "rank", (F.col("_before") - F.col("_from")).alias("_shift"))
    return local.join(placed, [group, "_part"]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def levels_of(size: int, fan: int = FAN) -> int:
    """Levels above the leaves until one node remains."""
    count = 0
    while size > 1:
        size, count = -(-size // fan), count + 1
    return count


class Block:
    """A block's tree, and versions of it: ``levels[0]`` are leaves, the last level has one node."""

    def __init__(self, leaves: list[str], height: int, fan: int = FAN):
        self.fan, self.levels = fan, [leaves]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append([digest("".join(below[k:k + fan])) for k in range(0, len(below), fan)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def beside(self, place: int) -> list[tuple[str, str]]:
        """The nodes left and right of a leaf's path, level by level, joined; every version shares them."""
        out = []
        for level in self.levels[:-1]:
            run = place - place % self.fan
            out.append(("".join(level[run:place]), "".join(level[place + 1:run + self.fan])))
            place //= self.fan
        return out

    def version(self, place: int, leaf: str) -> list[str]:
        """The copied path of a version with another leaf: that leaf and its ancestors up to the block's root."""
        path = [leaf]
        for left, right in self.beside(place):
            path.append(digest(left + path[-1] + right))
        return path


def _blocks(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[dict]]:
    """Rows of one block at a time; partitions are sorted by (grp, block, place)."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.select(columns).to_pylist():
            if held and (row["grp"], row["block"]) != (held[0]["grp"], held[0]["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _tree(rows: list[dict], fan: int, depth: int) -> Block:
    return Block([row["leaf"] for row in rows], min(levels_of(rows[0]["size"], fan), depth), fan)


def _roots_of(fan: int, depth: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches, ["grp", "block", "size", "rank", "place", "leaf"]):
            yield pa.RecordBatch.from_pylist([{
                "grp": rows[0]["grp"], "rank": rows[0]["rank"], "block": rows[0]["block"], "blocks": -(-rows[0]["size"] // fan**depth),
                "node": _tree(rows, fan, depth).root,
            }])

    return job


def _versions_of(fan: int, depth: int, with_nodes: bool):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (head, *rows) in _blocks(batches, ["doc_id", "grp", "block", "size", "place", "leaf", "changed", "subroot", "root", "above"]):
            tree, above, root = _tree(rows, fan, depth), head["above"], head["root"]
            shared = "".join(side["left"] + side["right"] for side in above)
            out = []
            for at, row in enumerate(rows):
                sides = tree.beside(at)
                path = tree.version(at, row["changed"]) if row["changed"] is not None else []
                top = path[-1] if path else None
                for side in above if path else []:
                    top = digest(side["left"] + top + side["right"])
                    path.append(top)
                if not path:
                    # Without a change, the proof is folded with the leaf itself.
                    top = tree.version(at, row["leaf"])[-1]
                    for side in above:
                        top = digest(side["left"] + top + side["right"])
                line = {
                    "doc_id": row["doc_id"], "leaf": row["leaf"], "subroot": head["subroot"], "root": root,
                    "proof_sha256": digest("".join(left + right for left, right in sides) + shared),
                    "folded_root": top, "verified": top == root,
                }
                out.append(line | {"place": row["place"], "source_key": row["grp"], "copied": path} if with_nodes else line)
            yield pa.RecordBatch.from_pylist(out, _REPORT if not with_nodes else _REPORT_NODES)

    return job


_REPORT = pa.schema([
    ("doc_id", pa.int64()), *((name, pa.string()) for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_()),
])
_REPORT_NODES = pa.schema([*_REPORT, ("place", pa.int64()), ("source_key", pa.string()), ("copied", pa.list_(pa.string()))])


def climbed(nodes: DataFrame, fan: int = FAN) -> DataFrame:
    """``nodes(grp, at, n, node, ...)``, of each group n at places 0 to n - 1, with ``top``, their group's root, and ``sides`` of their paths.

    Level by level: a parent is the hash of its children in order, and every node below learns what stands beside its path.
    """
    nodes = materialize(nodes.withColumns({"top": F.col("node"), "sides": F.array().cast(_SIDES), "_at": F.col("at"), "_n": F.col("n")}), "nodes")
    most = nodes.agg(F.max("n").alias("n")).first()["n"] or 0
    for _ in range(levels_of(most, fan)):
        # Nodes of this level are known by group and place; many rows may lie below one of them.
        level = nodes.filter("_n > 1").groupBy("grp", "_at").agg(F.first("top").alias("top"))
        parents = level.groupBy("grp", F.floor(F.col("_at") / fan).alias("_up")).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("_at", "top"))), lambda x: x["top"]).alias("_children")
        )
        going = nodes.withColumn("_up", F.floor(F.col("_at") / fan)).join(parents, ["grp", "_up"], "left")
        slot = (F.col("_at") % fan).cast("int")
        side = F.struct(
            F.array_join(F.slice("_children", F.lit(1), slot), "").alias("left"),
            F.array_join(F.slice("_children", slot + 2, F.lit(fan)), "").alias("right"),
        )
        up = F.col("_n") > 1
        nodes = materialize(going.select(
            *[c for c in nodes.columns if c not in ("top", "sides", "_at", "_n")],
            F.when(up, F.sha2(F.array_join("_children", ""), 256)).otherwise(F.col("top")).alias("top"),
            F.when(up, F.concat("sides", F.array(side))).otherwise(F.col("sides")).alias("sides"),
            F.when(up, F.col("_up")).otherwise(F.col("_at")).alias("_at"), F.when(up, F.ceil(F.col("_n") / fan)).otherwise(F.col("_n")).alias("_n"),
        ), "nodes")
    return nodes.drop("_at", "_n")


class Manifest:
    """The tree over ``docs`` with the columns ``FIELDS``; ``changed`` gives the changed leaf of a row, or null."""

    def __init__(self, docs: DataFrame, changed: Column | None = None, fan: int = FAN, depth: int = DEPTH):
        self.fan, self.depth = fan, depth
        rows = docs.select(*FIELDS).select(
            "doc_id", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("grp"), leaf_of().alias("leaf"),
            (tampered() if changed is None else changed).alias("changed"),
        )
        leaves = numbered(materialize(rows, "leaves"), "grp", ["doc_id", "leaf"])
        size = fan**depth
        # Sorted by block within partitions: a task holds one block's rows at a time.
        self._leaves = materialize(leaves.withColumn("block", F.floor(F.col("place") / size)), "placed")
        roots = self._by_block(self._leaves).mapInArrow(_roots_of(fan, depth), "grp string, rank long, block long, blocks long, node string")
        blocks = climbed(roots.withColumnsRenamed({"block": "at", "blocks": "n"}), fan)
        tops = blocks.filter("at = 0").select(F.lit("").alias("grp"), F.col("rank").alias("at"), F.col("top").alias("node"), F.col("grp").alias("source_key"))
        tops = materialize(tops, "subroots")
        tops = climbed(tops.withColumn("n", F.lit(tops.count()).cast("long")), fan)
        #: One row per source: ``source_key`` ("=" and the source, "" without one), ``subroot``, ``root``.
        self.sources = tops.select("source_key", F.col("node").alias("subroot"), F.col("top").alias("root"), F.col("sides").alias("_sides"))
        upper = self.sources.withColumnRenamed("source_key", "grp")
        self._upper = materialize(blocks.join(upper, "grp").select(
            "grp", F.col("at").alias("block"), "subroot", "root", F.concat("sides", "_sides").alias("above")
        ), "upper")

    def _by_block(self, leaves: DataFrame) -> DataFrame:
        return leaves.repartition("grp", "block").sortWithinPartitions("grp", "block", "place")

    def report(self, with_nodes: bool = False) -> DataFrame:
        """One row per leaf: its digest, the roots, the hash of its proof, and the root that its version has.

        ``with_nodes`` adds ``source_key``, ``place`` and ``copied``, the nodes a version doesn't share: the leaf's, then its ancestors'.
        """
        shape = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        # What a block's rows have in common comes along once, ahead of them, not with every row.
        heads = self._upper.withColumn("place", F.lit(-1).cast("long"))
        rows = self._by_block(self._leaves.unionByName(heads, allowMissingColumns=True))
        return rows.mapInArrow(_versions_of(self.fan, self.depth, with_nodes), shape + ", place long, source_key string, copied array<string>" * with_nodes)


def oracle(levels: int = 5, fan: int = FAN) -> str:
    """The report in DuckDB SQL, for sources of up to ``fan ** levels`` leaves and as many sources."""
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "{text}")
    part = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0})) || ':' || {0} END"
    leaf = "sha256(" + " || ".join(part.format(name) for name in fields) + ")"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # The checksum bit by bit: 0xEDB88320 is its polynomial.
    step = "xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce([xor(a, ascii(b))] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: {step})"
    crc = (
        "xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), "
        f"lambda a, b: {byte.replace('ascii(b)', 'b')}), 4294967295)"
    )
    out = [
        f"leaves AS (SELECT doc_id, source, {leaf.format(text='text')} AS leaf, CASE WHEN {crc} % {TAMPER_EVERY} = 0 THEN "
        f"{leaf.format(text=f'translate(text, {upper!r}, {lower!r})')} ELSE {leaf.format(text='text')} END AS now FROM documents)",
        "a0 AS (SELECT *, leaf AS node, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, "
        "count(*) OVER (PARTITION BY source) AS n FROM leaves)",
    ]

    def tree(name: str, group: str) -> None:
        """Levels ``name``1 and up, each from the one below: a node, what stands beside it, and the hash of its parent."""
        for k in range(levels):
            run = f"PARTITION BY {group}pos // {fan}"
            out.append(
                f"{name}{k}s AS (SELECT {group}pos, n, node, coalesce(string_agg(node, '') OVER ({run} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                f"coalesce(string_agg(node, '') OVER ({run} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"
            )
            out.append(
                f"{name}{k + 1} AS (SELECT {group}pos // {fan} AS pos, (any_value(n) + {fan - 1}) // {fan} AS n, "
                f"CASE WHEN any_value(n) = 1 THEN any_value(node) ELSE any_value(sha256(l || node || r)) END AS node FROM {name}{k}s GROUP BY {group}pos // {fan})"
            )

    tree("a", "source, ")
    out.append(f"b0 AS (SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM a{levels})")
    tree("b", "")
    out.append("p0 AS (SELECT doc_id, source, leaf, pos, now, '' AS proof FROM a0)")
    count = 0
    for name, group in (("a", "source"), ("b", None)):
        for k in range(levels):
            on = f"s.pos = p.pos // {fan**k}" + (f" AND s.{group} IS NOT DISTINCT FROM p.{group}" if group else "")
            out.append(
                f"p{count + 1} AS (SELECT p.* REPLACE (CASE WHEN s.n = 1 THEN p.now ELSE sha256(s.l || p.now || s.r) END AS now, p.proof || s.l || s.r AS proof) "
                f"FROM p{count} p JOIN {name}{k}s s ON {on})"
            )
            count += 1
        if group:
            out.append(
                f"p{count + 1} AS (SELECT p.doc_id, p.source, p.leaf, b.pos, p.now, p.proof, b.node AS subroot FROM p{count} p "
                "JOIN b0 b ON b.source IS NOT DISTINCT FROM p.source)"
            )
            count += 1
    return (
        "WITH " + ",\n".join(out) + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, now AS folded_root, now = root AS verified "
        f"FROM p{count}, (SELECT node AS root FROM b{levels})"
    )

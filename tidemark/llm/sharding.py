"""Sharding by balanced label propagation: linked documents move towards their neighbours' shards under quotas.

The law is ``rows``: the counts of two shards differ by one at most. Links are equal texts: a group's members are all
neighbours of each other. Documents first get shards in a random, exactly balanced deal. Then, in each round, every linked
document whose group has as many members in another shard, or more, wants to go there. As many go as want to change places
in pairs or longer circles of shards, equal counts each way, and then as many as the capacity leaves beside a shard's linked
documents. Every move lowers the cut. Which of several equal shards a group prefers is dealt anew in each round; where
shards are full, groups also gather in the best shard that has room. Rounds go on until ``IDLE`` of them in a row
found no move. Unlinked documents move at no cost, so last they fill every shard up to its capacity, as many as possible where
they are. A group larger than a shard spreads over the shards that it needs.

Texts are read once; rounds work on a written table of ids and hashes. Numbers within a shard are found in two steps, by
counts of many small buckets and by rank within a bucket, so no shard, group or flow is sorted in one task. What the
driver sees are the counts of 8 by 8 flows.

Null texts are empty: size 1, crc 0, linked with each other. Null and repeated doc_ids are rows like any other. Extra
columns are not touched. Empty tables give empty results, fewer documents than shards leave some empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.scratch import counted, materialize

SHARDS = 8
#: Rounds without a move, preferences dealt anew in each, after which propagation ends.
IDLE = 3
#: Rows of one bucket of the numbering, on average.
BUCKET_ROWS = 4000


def numbered(rows: DataFrame, by: list[str], name: str, buckets: int) -> DataFrame:
    """``rows(uid, ...)`` with a gapless number from 0 within ``by``, in an order fixed by uid's hash."""
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64("uid"), F.lit(buckets)))
    counts = placed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy("uid")) - 1
    return placed.join(starts, [*by, "_bucket"]).withColumn(name, (F.col("_start") + rank).cast("long")).drop("_bucket", "_start")


def _capacity(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def _case(column: Column, values: dict[int, int], default: int = 0) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in values.items() for x in kv]), column.cast("long")), F.lit(default).cast("long")) if values else F.lit(default).cast("long")


def quotas(flows: dict[tuple[int, int], int], free: dict[int, int]) -> dict[tuple[int, int], int]:
    """How many of each wished flow may go: circles of shards change places, shortest circles first; then free room is filled."""
    left, out = dict(flows), dict.fromkeys(flows, 0)

    def take(path: list[tuple[int, int]], n: int) -> None:
        for edge in path:
            left[edge] -= n
            out[edge] += n

    def path(start: int, ends: set[int]) -> list[tuple[int, int]] | None:
        """A shortest way along wished flows, widest edges first."""
        ways, seen = [(start, [])], set()
        for at, way in ways:
            for edge in sorted((e for e, n in left.items() if n > 0 and e[0] == at and e[1] not in seen), key=lambda e: (-left[e], e)):
                if edge[1] in ends:
                    return [*way, edge]
                seen.add(edge[1])
                ways.append((edge[1], [*way, edge]))
        return None

    while circles := [way for k in sorted({i for i, _ in left}) if (way := path(k, {k}))]:
        best = min(circles, key=len)
        take(best, min(left[edge] for edge in best))
    room = {k: max(n, 0) for k, n in free.items()}
    while ways := [way for k in sorted({i for i, _ in left}) if (way := path(k, {x for x, n in room.items() if n > 0 and x != k}))]:
        # Whoever comes fills the room at the end, and leaves room at the beginning.
        best = min(ways, key=len)
        n = min(room[best[-1][1]], *(left[edge] for edge in best))
        take(best, n)
        room[best[-1][1]] -= n
        room[best[0][0]] += n
    return out


def sharded(docs: DataFrame, shards: int = SHARDS, idle: int = IDLE) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, linked`` for every row of ``docs(doc_id, text)``."""
    text = F.coalesce("text", F.lit(""))
    rows, total = counted(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("same"), F.monotonically_increasing_id().alias("uid"),
    ), "rows")
    buckets = max(8, min(1 << 16, total // (BUCKET_ROWS * shards)))
    room = _capacity(total, shards)
    pairs = rows.groupBy("same").agg(F.count(F.lit(1)).alias("members"))
    whole = numbered(rows.withColumn("_all", F.lit(0)), ["_all"], "number", buckets * shards).drop("_all")
    dealt = materialize(
        whole.join(pairs, "same").withColumn("linked", F.col("members") > 1)
        .withColumn("shard", F.pmod("number", F.lit(shards)).cast("int")).drop("number", "members"), "dealt"
    )
    linked, count = counted(dealt.filter("linked").select("uid", "same", "shard"), "linked")
    turn = still = 0
    while count and still < idle:
        sizes = {row["shard"]: row["n"] for row in linked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        free = {k: room[k] - sizes.get(k, 0) for k in range(shards)}
        tally = linked.groupBy("same", "shard").agg(F.count(F.lit(1)).alias("n"))
        quota: dict[tuple[int, int], int] = {}
        # Towards the shard with most of the group; without a move, towards the one of those that have room.
        for full in [], [k for k in free if free[k] <= 0]:
            most = F.max(F.when(~F.col("shard").isin(full), F.struct("n", F.xxhash64("same", "shard", F.lit(turn)).alias("h"), "shard")))
            target = tally.groupBy("same").agg(most.alias("most")).select("same", F.col("most.shard").alias("to"), F.col("most.n").alias("there"))
            wish = linked.join(tally.withColumnRenamed("n", "here"), ["same", "shard"]).join(target, "same")
            wish = wish.filter("to <> shard and there >= here").select("uid", "shard", "to")
            flows = {(r["shard"], r["to"]): r["n"] for r in wish.groupBy("shard", "to").agg(F.count(F.lit(1)).alias("n")).collect()}
            quota = quotas(flows, free)
            if any(quota.values()) or not flows or not full:
                break
        turn += 1
        if not flows and not full:
            break
        if not any(quota.values()):
            still += 1
            continue
        still = 0
        ranked = numbered(wish, ["shard", "to"], "rank", buckets)
        goes = ranked.filter(F.col("rank") < _case(F.col("shard") * shards + F.col("to"), {i * shards + j: n for (i, j), n in quota.items()}))
        linked = materialize(
            linked.join(goes.select("uid", "to"), "uid", "left").select("uid", "same", F.coalesce("to", "shard").alias("shard")), "linked"
        )
    sizes = {row["shard"]: row["n"] for row in linked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    free = {k: room[k] - sizes.get(k, 0) for k in range(shards)}
    single = numbered(dealt.filter("not linked").select("uid", "shard"), ["shard"], "rank", buckets)
    stays = single.withColumn("stays", F.col("rank") < _case(F.col("shard"), free))
    stays = materialize(stays.select("uid", "shard", "stays"), "singles")
    kept = {row["shard"]: row["n"] for row in stays.filter("stays").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Those without a place take the open ones in order.
    ends, at = {}, 0
    for k in range(shards):
        at += free[k] - kept.get(k, 0)
        ends[k] = at
    moving = numbered(stays.filter("not stays").select("uid").withColumn("_all", F.lit(0)), ["_all"], "number", buckets).drop("_all")
    place = F.coalesce(*[F.when(F.col("number") < end, F.lit(k)) for k, end in ends.items()]).cast("int")
    final = linked.select("uid", "shard").unionByName(stays.filter("stays").select("uid", "shard")).unionByName(
        moving.select("uid", place.alias("shard"))
    )
    final = materialize(dealt.drop("shard").join(final, "uid"), "placed")
    return numbered(final, ["shard"], "slot", buckets).select("doc_id", "size", "text_crc32", "shard", "slot", "linked", "same")


def cut(placed: DataFrame) -> DataFrame:
    """Pairs of equal texts, and how many of them lie in different shards."""
    tally = placed.groupBy("same", "shard").agg(F.count(F.lit(1)).cast("double").alias("n"))
    per = tally.groupBy("same").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("inner"))
    return per.agg(
        F.sum((F.col("all") * F.col("all") - F.col("all")) / 2).alias("pairs"),
        F.sum((F.col("all") * F.col("all") - F.col("inner")) / 2).alias("cut"),
    )

"""Best-fit packing: best-fit decreasing over all documents, with a segment tree over the capacities that bins have left.

A document is its ids and one end id; a longer one than a sequence is cut into whole sequences, of which only the first piece may be shorter.
Which bin a piece gets depends on its length alone, so the packing is planned on lengths and their counts:

1. One pass finds the ids, writes down the pieces, and numbers those of equal length within their task.
2. The counts per length (as many numbers as a sequence has places, however many documents there are) give the plan.
   Lengths come in falling order. A segment tree over remaining capacities tells in logarithmic time the tightest one that has open
   bins; these take pieces until they can't take another one, and new bins are opened where none fits. Bins that are alike are
   kept as runs, so that one step places a run of pieces. The outcome is that of best-fit decreasing piece by piece.
3. A piece's number among all pieces of its length is its number in its task plus what earlier tasks have. The plan, a table of runs, tells its
   bin and place.

Nothing but the counts reaches the driver. A plan has at most about ``4 * length * log2(length)`` runs, as each length adds few
runs of bins and a bin's room is more than halved by every step: it is sent to all tasks whatever the number of documents.

Null and empty texts have the end id alone. Very long texts are many pieces. Repeated rows, rows of one doc_id and rows without one are
packed each for themselves. Ties (pieces of equal length) are in the order of the input. Extra columns are not touched; empty
tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm import words as W
from tidemark.llm.tokens import CHUNK_BYTES, ByteLevel
from tidemark.scratch import materialize

LENGTH = 2048
END = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"
#: A number within one length must stay below this.
_NUMBERS = 1 << 45


class Rooms:
    """Open bins by remaining capacity, as runs ``(first, count)``; a segment tree counts the runs below each node."""

    def __init__(self, length: int):
        self._leaves = 1 << length.bit_length()
        self._tree = [0] * (2 * self._leaves)
        self._runs: dict[int, list[tuple[int, int]]] = {}

    def _count(self, room: int, by: int) -> None:
        at = room + self._leaves
        while at:
            self._tree[at] += by
            at >>= 1

    def put(self, room: int, first: int, count: int) -> None:
        if room and count:
            self._runs.setdefault(room, []).append((first, count))
            self._count(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._count(room, -1)
        return self._runs[room].pop()

    def tightest(self, size: int) -> int | None:
        """The least remaining capacity of ``size`` or more that some open bin has."""
        at = size + self._leaves
        if self._tree[at]:
            return size
        # Up to the first right-hand neighbour that holds something, then down its left-most path.
        while at > 1 and (at & 1 or not self._tree[at + 1]):
            at >>= 1
        if at <= 1:
            return None
        at += 1
        while at < self._leaves:
            at = 2 * at if self._tree[2 * at] else 2 * at + 1
        return at - self._leaves


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(size, first number, pieces a bin, first bin, offset)`` of best-fit decreasing.

    Piece ``i`` of a size, counted from the run's first number, goes to bin ``first + i // a``, behind ``i % a`` of its kind
    there, ``a`` being the pieces a bin.
    """
    rooms, runs, opened = Rooms(length), [], 0
    for size in sorted(counts, reverse=True):
        left, number = counts[size], 0
        while left:
            room = rooms.tightest(size)
            if room is None:
                room, first = length, opened
                bins = -(-left // (length // size))
                opened += bins
            else:
                first, bins = rooms.take(room)
            each = room // size
            full = min(bins, left // each)
            if full:
                runs.append((size, number, each, first, length - room))
                rooms.put(room - each * size, first, full)
                number, left, first, bins = number + full * each, left - full * each, first + full, bins - full
            if left and bins:
                runs.append((size, number, left, first, length - room))
                rooms.put(room - left * size, first, 1)
                left, first, bins = 0, first + 1, bins - 1
            rooms.put(room, first, bins)
    return runs


def cuts(n: int, length: int = LENGTH) -> list[int]:
    """Lengths of the pieces of ``n`` ids; where there are several, all but the first are whole sequences."""
    return [n % length] * (n % length > 0) + [length] * (n // length)


def _pieces_of(path: str, length: int, end: int, with_ids: bool):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task = ByteLevel.of(path), TaskContext.get().partitionId()
        seen = np.zeros(length + 1, np.int64)
        for batch in batches:
            for part, texts in W.chunks(batch, "text", CHUNK_BYTES):
                ids, first = tokenizer.ids(texts)
                rows: list[tuple] = []
                for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    own = np.append(ids[first[i]:first[i + 1]], np.uint32(end)).astype("<u4")
                    at = 0
                    for k, size in enumerate(cuts(len(own), length)):
                        piece = own[at:at + size]
                        row = (doc_id, k, at, size, crc32(piece.tobytes()), task, int(seen[size]))
                        rows.append((*row, piece.tolist()) if with_ids else row)
                        seen[size] += 1
                        at += size
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()] + [pa.list_(pa.int64())] * with_ids
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"] + ["ids"] * with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return job


def _placed_by(held):
    """``held``: the broadcast plan."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, number, each, first, offset = held.value
        keys = size * _NUMBERS + number
        for batch in batches:
            length = batch.column("length").to_numpy()
            own = batch.column("number").to_numpy() + batch.column("earlier").to_numpy()
            run = np.searchsorted(keys, length * _NUMBERS + own, side="right") - 1
            behind = own - number[run]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in batch.schema.names if name not in ("task", "number", "earlier")),
                    pa.array(first[run] + behind // each[run]), pa.array(offset[run] + behind % each[run] * length),
                ],
                names=[name for name in batch.schema.names if name not in ("task", "number", "earlier")] + ["sequence_id", "offset"],
            )

    return job


def packed(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, with_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)`` with its ``sequence_id`` and ``offset``; ``with_ids`` adds the ids themselves."""
    if length < 1:
        raise ValueError("length must be positive")
    ids = ", ids array<long>" * with_ids
    pieces = materialize(docs.select("doc_id", "text").mapInArrow(_pieces_of(path, length, end, with_ids), PIECES + ids), "pieces")
    # A task has at most as many rows here as a sequence has places.
    by_task = materialize(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = sorted(plan(counts, length)) or [(0, 0, 1, 0, 0)]
    held = docs.sparkSession.sparkContext.broadcast(tuple(np.array(column, np.int64) for column in zip(*runs, strict=True)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    shape = "doc_id long, piece int, start long, length long, ids_crc32 long" + ids + ", sequence_id long, offset long"
    return pieces.join(earlier, ["task", "length"]).select(*pieces.columns, "earlier").mapInArrow(_placed_by(held), shape)


def sequences(pieces: DataFrame, length: int = LENGTH, padding: int = END) -> DataFrame:
    """``sequence_id, ids, used``: the ids of every sequence in place, padded; ``pieces`` are those of ``packed(..., with_ids=True)``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
    used = F.size("ids")
    return joined.select(
        "sequence_id", F.concat("ids", F.array_repeat(F.lit(padding).cast("long"), length - used)).alias("ids"), used.cast("long").alias("used")
    )


def use(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row: sequences, ids, and the fewest sequences that so many ids could fill."""
    return pieces.agg(
        F.coalesce(F.max("sequence_id") + 1, F.lit(0)).alias("sequences"), F.coalesce(F.sum("length"), F.lit(0)).alias("ids")
    ).withColumn("fewest", F.ceil(F.col("ids") / F.lit(length)))

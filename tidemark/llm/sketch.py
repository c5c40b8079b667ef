"""Fixed-size counter tables summed over all tasks: what is gathered follows the input, what is kept has a fixed size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Counters in one row of a table on its way to be summed.
PIECE = 1 << 14
ROWS = "piece int, at binary, counts binary"
SCHEMA = pa.schema([("piece", pa.int32()), ("at", pa.binary()), ("counts", pa.binary())])


def pieces(table: np.ndarray) -> Iterator[tuple[int, bytes | None, bytes]]:
    """A task's counters (int64) as rows; pieces that are mostly zero travel as places and counts."""
    for k in range(0, len(table), PIECE):
        part = table[k:k + PIECE]
        at = np.flatnonzero(part)
        if len(at) * 2 < len(part):
            if len(at):
                yield k // PIECE, at.astype(np.int32).tobytes(), part[at].tobytes()
        else:
            yield k // PIECE, None, part.tobytes()


def add(into: np.ndarray, at: bytes | None, counts: bytes) -> None:
    found = np.frombuffer(counts, np.int64)
    if at is None:
        into[:len(found)] += found
    else:
        into[np.frombuffer(at, np.int32)] += found


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the pieces that meet in this task; memory is that of the table, however many tasks sent some."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, at, counts in zip(*(batch.column(name).to_pylist() for name in ("piece", "at", "counts")), strict=True):
            add(held.setdefault(piece, np.zeros(PIECE, np.int64)), at, counts)
    if held:
        yield pa.RecordBatch.from_pydict(
            {"piece": list(held), "at": [None] * len(held), "counts": [x.tobytes() for x in held.values()]}, SCHEMA
        )


def total(rows: DataFrame, size: int) -> np.ndarray:
    """The summed table of ``size`` counters, on the driver: ``8 * size`` bytes whatever the input.

    Tasks' pieces are summed in two steps, so that no task sees all tasks' rows of a piece one by one at once.
    """
    whole = -(-size // PIECE)
    parts = min(whole, 64)
    summed = rows.select("piece", "at", "counts").repartition(parts, "piece").mapInArrow(_sums, ROWS)
    table = np.zeros(whole * PIECE, np.int64)
    for row in summed.collect():
        add(table[row["piece"] * PIECE:(row["piece"] + 1) * PIECE], row["at"], row["counts"])
    return table[:size]


#: Bits of a presence map: 8 MB in each task and on the driver, whatever the number of values.
PRESENT_BITS = 1 << 26
_PRESENT_PIECE = 1 << 17


def _places(values: np.ndarray) -> np.ndarray:
    spread = values.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (spread >> np.uint64(64 - 26)).astype(np.int64)


def maybe_present(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """False only for values that were not put into ``bits``."""
    at = _places(values)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def presence(values: DataFrame) -> np.ndarray:
    """A map of the bigints in the one column of ``values``, to pass over most others; nulls are left out."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = _places(batch.column(0).drop_null().to_numpy())
            for piece in np.unique(at >> 20):
                own = at[at >> 20 == piece] & ((1 << 20) - 1)
                np.bitwise_or.at(held.setdefault(int(piece), np.zeros(_PRESENT_PIECE, np.uint8)), own >> 3, np.uint8(1) << (own & 7).astype(np.uint8))
        for piece, bits in held.items():
            yield pa.RecordBatch.from_pydict({"piece": pa.array([piece], pa.int32()), "bits": [bits.tobytes()]})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, bits in zip(batch.column("piece").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                held.setdefault(piece, np.zeros(_PRESENT_PIECE, np.uint8))
                held[piece] |= np.frombuffer(bits, np.uint8)
        for piece, bits in held.items():
            yield pa.RecordBatch.from_pydict({"piece": pa.array([piece], pa.int32()), "bits": [bits.tobytes()]})

    rows = "piece int, bits binary"
    out = np.zeros(PRESENT_BITS >> 3, np.uint8)
    for row in values.mapInArrow(mapped, rows).repartition(64, "piece").mapInArrow(merged, rows).collect():
        out[row["piece"] * _PRESENT_PIECE:(row["piece"] + 1) * _PRESENT_PIECE] = np.frombuffer(row["bits"], np.uint8)
    return out

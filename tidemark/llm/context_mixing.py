"""Language-model scoring by online logistic context mixing.

A token is coded as the bits of its code, 20 bits of the hash of the whole word, and then as itself among the words of that code. Every
bit is predicted by mixing: for each hashed context (none, the first bytes of the two words before, the word before, the one before that,
both, and three words before) a predictor holds how often each bit followed in training texts after the same first bits; their logits
are combined by weights gated by the bit's place in the code, and each text refines its own weights as it is read, after every block of
tokens, along the gradient of coding cost. Codes are shared by few words, so that these bits tell the word; among the words of
its code a token has its smoothed share of their training tokens. Together this is a probability for every text, hence total bits, and bits
per byte.

Counts of tokens are exact over all training texts: combined in tasks, summed by a shuffle, whatever their number. The
predictors' tables have a fixed size (contexts are hashed), and are summed over all training texts. To score, the words
most frequent in their slot of a fixed table travel to every task; tokens that are not in it are joined with the counts.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, then one end. Words are compared by 64-bit hashes. Null and empty
texts have the end only. Rows that repeat are each scored. Extra columns are not touched. Empty tables give empty results;
without training texts every token is unknown.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import words as W
from tidemark.scratch import materialize, measured

#: A code is five groups of four bits. A row of a predictor counts the sixteen values of a group, after the groups before and the context.
BITS, LEAVES, GROUPS = 4, 16, 5
CODE_BITS = BITS * GROUPS
CLASSES = 63
END_HASH = np.uint64(0x5BD1E9955BD1E995)
#: Rows of each predictor's table: without context one for every beginning of a code, the others hashed. Fixed whatever the corpus.
PLAIN = np.concatenate([[0], np.cumsum(LEAVES ** np.arange(GROUPS))])
ROW_BITS = 17
ROWS = (70656, *[1 << ROW_BITS] * 5)
FIRST = np.concatenate([[0], np.cumsum(ROWS)])
COUNTERS = int(FIRST[-1]) * LEAVES
#: A row is the upper bits of (context + beginning * 0x9E3779B97F4A7C15) * SPREAD.
SPREAD = np.uint64(0xC4CEB9FE1A85EC53)
MARK = np.uint64(0x9E3779B97F4A7C15 * 0xC4CEB9FE1A85EC53 % (1 << 64))
#: Counters that travel together, with whole rows; steps of a logit in the table; largest logit.
PIECE = 1 << 14
SCALE, MOST = 16, 127
#: Weights at a text's start, one for each predictor; tokens after which a text's weights are refined; by how much.
START = np.array([0.8, 0.1, 0.2, 0.1, 0.2, 0.3])
BLOCK = 32
RATE = 0.02
PRIOR = 0.4
#: Texts whose blocks are worked on at once, few enough for their numbers to stay in the processor's cache; rows of the table likewise.
LANES = 32
PATH_ROWS = 4096
#: Slots of the table of frequent words that every task gets: 16 bytes each.
SLOTS = 1 << 18
CHUNK_BYTES = 1 << 20


class Tokens:
    """The tokens of a chunk of texts: hash, code and position, each text's end included."""

    def __init__(self, texts: pa.Array):
        words = W.split(texts, W.BLANKS)
        n, docs = len(words.start), len(texts)
        self.first = words.first + np.arange(docs + 1)
        at = np.arange(n) + words.doc
        self.hash = np.full(n + docs, END_HASH, np.uint64)
        self.hash[at] = words.hash
        self.code = code_of(self.hash)
        second = words.data[np.minimum(words.start + 1, max(len(words.data) - 1, 0))] * (words.end - words.start > 1)
        lead = (words.data[words.start].astype(np.uint64) << np.uint64(8)) | second.astype(np.uint64)
        self.cls = np.full(n + docs, CLASSES, np.uint64)
        self.cls[at] = W.mix(lead + np.uint64(1)) % np.uint64(CLASSES)
        self.doc = np.repeat(np.arange(docs), np.diff(self.first))
        self.place = np.arange(n + docs) - self.first[self.doc]

    @cached_property
    def contexts(self) -> list[np.ndarray]:
        """A hash of each context of every token, but the empty one, spread over the rows of a table."""

        def before(values: np.ndarray, k: int) -> np.ndarray:
            own = np.zeros(len(values), np.uint64)
            own[k:] = np.where(self.place[k:] >= k, values[:-k] + np.uint64(1), np.uint64(0))
            return own

        one, two, three = (before(self.hash, k) for k in (1, 2, 3))
        coarse = before(self.cls, 1) * np.uint64(65) + before(self.cls, 2)
        pair = W.mix(one) + two
        return [W.mix(x) * SPREAD for x in (coarse, one, two ^ np.uint64(0x9E3779B97F4A7C15), pair, W.mix(pair) + three)]

    def places(self, at: np.ndarray | slice = slice(None)) -> Iterator[np.ndarray]:
        """Per predictor: which of its counters the tokens ``at`` have, one for each group of bits (the first axis)."""
        code = self.code[at]
        apart = (-1,) + (1,) * code.ndim
        begun = code >> np.arange(CODE_BITS, -1, -BITS).reshape(apart)
        group = begun[1:] & (LEAVES - 1)
        yield (PLAIN[:GROUPS].reshape(apart) + begun[:-1]) * LEAVES + group
        marks = (begun[:-1] + (1 << BITS * np.arange(GROUPS)).reshape(apart)).astype(np.uint64) * MARK
        for context in self.contexts:
            row = marks + context[at]
            row >>= np.uint64(64 - ROW_BITS - BITS)
            row &= np.uint64(-LEAVES % (1 << 64))
            own = row.view(np.int64)
            own |= group
            yield own


def code_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CODE_BITS)).astype(np.int64)


def _packed(table: np.ndarray) -> Iterator[tuple[int, bytes | None, bytes]]:
    """A task's counters as rows, each count as narrow as its piece allows; pieces that are mostly zero travel as places and counts."""
    for k in range(0, len(table), PIECE):
        part = table[k:k + PIECE]
        kind = np.min_scalar_type(part.max())
        at = np.flatnonzero(part)
        if len(at) * (2 + kind.itemsize) < PIECE * kind.itemsize:
            if len(at):
                yield k // PIECE, at.astype(np.uint16).tobytes(), part[at].astype(kind).tobytes()
        else:
            yield k // PIECE, None, part.astype(kind).tobytes()


def _predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the pieces that meet in this task, and turn them into logits; memory is that of the table, however many tasks sent some."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, at, counts in zip(*(batch.column(name).to_pylist() for name in ("piece", "at", "counts")), strict=True):
            into = held.setdefault(piece, np.zeros(PIECE, np.int64))
            size = len(counts) // (PIECE if at is None else len(at) // 2)
            found = np.frombuffer(counts, f"u{size}")
            if at is None:
                into += found
            else:
                into[np.frombuffer(at, np.uint16)] += found.astype(np.int64)
    for piece, counts in held.items():
        yield pa.RecordBatch.from_pydict({"piece": pa.array([piece], pa.int32()), "logits": [logits(counts).tobytes()]})


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, waiting, held = np.zeros(COUNTERS, np.uint32), [], 0

    def out() -> Iterator[pa.RecordBatch]:
        if waiting:
            h, c = (np.concatenate(x) for x in zip(*waiting, strict=True))
            values, inverse = np.unique(h, return_inverse=True)
            none = pa.nulls(len(values))
            yield pa.RecordBatch.from_arrays([
                pa.array(W.signed(values)), pa.array(np.bincount(inverse, weights=c).astype(np.int64)),
                none.cast(pa.int32()), none.cast(pa.binary()), none.cast(pa.binary()),
            ], names=["word", "n", "piece", "at", "counts"])
            waiting.clear()

    for batch in batches:
        for _, texts in W.chunks(batch, "text", CHUNK_BYTES):
            tokens = Tokens(texts)
            waiting.append(np.unique(tokens.hash, return_counts=True))
            values = waiting[-1][0]
            held += len(values)
            if held > 1_000_000:
                yield from out()
                held = 0
            for part, places in zip(parts(table), tokens.places(), strict=True):
                np.add.at(part, places.reshape(-1), np.uint32(1))
    yield from out()
    for piece, at, counts in _packed(table):
        none = pa.nulls(1).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([
            none, none, pa.array([piece], pa.int32()), pa.array([at], pa.binary()), pa.array([counts], pa.binary()),
        ], names=["word", "n", "piece", "at", "counts"])


def logits(counts: np.ndarray) -> np.ndarray:
    """Per row and node of the tree over a group's bits: the logit of a one, from leaf counts, in steps of 1 / SCALE."""
    level = counts.reshape(-1, LEAVES).astype(np.float64)
    out = np.zeros(level.shape, np.int8)
    for depth in reversed(range(BITS)):
        zero, one = level[:, 0::2], level[:, 1::2]
        out[:, 1 << depth:2 << depth] = np.clip(np.rint(np.log((one + PRIOR) / (zero + PRIOR)) * SCALE), -MOST, MOST)
        level = zero + one
    return out.reshape(-1)


def parts(table: np.ndarray) -> list[np.ndarray]:
    """Each predictor's part of a table."""
    return [table[a * LEAVES:b * LEAVES] for a, b in zip(FIRST[:-1], FIRST[1:], strict=True)]


def paths(table: np.ndarray) -> np.ndarray:
    """Per counter: the logits of its group's four bits, each for the bit being as it is there, in one number."""
    leaf, depth = np.arange(LEAVES)[:, None], np.arange(BITS)
    node = ((1 << depth) + (leaf >> (BITS - depth))).reshape(-1)
    sign = np.where(leaf >> (BITS - 1 - depth) & 1, 1, -1).astype(np.int8).reshape(-1)
    rows, out = table.reshape(-1, LEAVES), np.empty(len(table), np.uint32)
    told = out.view(np.int8).reshape(-1, LEAVES * BITS)
    for k in range(0, len(rows), PATH_ROWS):
        np.multiply(rows[k:k + PATH_ROWS].take(node, axis=1), sign, out=told[k:k + PATH_ROWS])
    return out


def mixed(tokens: Tokens, told: np.ndarray) -> np.ndarray:
    """Per text: natural logarithm of the probability of its tokens' codes, every bit of them mixed; ``told`` is from ``paths``."""
    docs = len(tokens.first) - 1
    # A run is a text's block; a step takes runs of one block of up to LANES texts, long ones first.
    runs = np.flatnonzero(tokens.place % BLOCK == 0)
    size, block = np.diff(np.append(runs, len(tokens.place))), tokens.place[runs] // BLOCK
    order = np.lexsort((-size, block))
    runs, size, block = runs[order], size[order], block[order]
    starts = np.searchsorted(block, np.arange(block[-1] + 2))
    steps = [(k, min(k + LANES, int(b))) for a, b in zip(starts[:-1], starts[1:], strict=True) for k in range(int(a), int(b), LANES)]
    # Axes: predictor, group, token of the run, text, bit of the group. Steps use the same memory again.
    weights = np.empty((len(ROWS), GROUPS, docs, BITS), np.float32)
    weights[:] = START.reshape(-1, 1, 1, 1)
    space = np.empty((2, len(ROWS), GROUPS * BLOCK * LANES * BITS), np.float32)
    out, told = np.zeros(docs), parts(told)
    for first, last in steps:
        n, texts = size[first:last], tokens.doc[runs[first:last]]
        turn = np.arange(n[0])[:, None]
        at = runs[first:last] + np.minimum(turn, n - 1)
        inputs, sums = space[:, :, :GROUPS * at.size * BITS].reshape(2, len(ROWS), GROUPS, *at.shape, BITS)
        for predictor, places in enumerate(tokens.places(at)):
            inputs[predictor] = told[predictor].take(places).view(np.int8).reshape(inputs.shape[1:])
        own = weights[:, :, texts]
        # In the order in which numpy's ``einsum`` adds up six products.
        np.multiply(inputs, own[:, :, None], out=sums)
        sums[:2] += sums[4:]
        sums[0:4:2] += sums[1:4:2]
        x = sums[0] + sums[2]
        x *= np.float32(1 / SCALE)
        np.clip(x, -15, 15, out=x)
        missed = 1 / (1 + np.exp(x))
        cost = np.log1p(-missed).sum(axis=0, dtype=np.float64)
        if n[-1] < n[0]:
            cost[turn >= n] = 0
        out[texts] += cost.sum(axis=0).sum(axis=1)
        # Only a text's last run is shorter, and there is nothing to refine weights for after it.
        full = int(np.searchsorted(-n, -BLOCK, side="right"))
        if full:
            inputs *= missed
            weights[:, :, texts[:full]] = own[:, :, :full] + np.float32(RATE / SCALE) * _summed(inputs[:, :, :, :full])
    return out


def _summed(slopes: np.ndarray) -> np.ndarray:
    """Sums over the tokens of whole runs (axis 2), in the order in which numpy's ``reduceat`` adds up one run, so that scores stay the same."""
    eights = (BLOCK - 1) // 8 * 8
    some = slopes[:, :, 1:9] + slopes[:, :, 9:17]
    for k in range(17, eights, 8):
        some += slopes[:, :, k:k + 8]
    while some.shape[2] > 1:
        some = some[:, :, 0::2] + some[:, :, 1::2]
    rest = some[:, :, 0]
    for k in range(eights + 1, BLOCK):
        rest += slopes[:, :, k]
    return slopes[:, :, 0] + rest


_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, known long, counted double, rest double, n_bytes long, rare array<long>, rare_n array<long>"
)


def _score_of(held):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs, table, shares = held.value
        told = paths(table)
        for batch in batches:
            for part, texts in W.chunks(batch, "text", CHUNK_BYTES):
                tokens = Tokens(texts)
                slot = (tokens.hash >> np.uint64(46)).astype(np.int64)
                hit = keys[slot] == tokens.hash
                heads = tokens.first[:-1]
                counted = np.add.reduceat(np.where(hit, logs[slot], 0.0), heads)
                rest = np.add.reduceat(shares[tokens.code], heads) + mixed(tokens, told) / np.log(10)
                miss = np.flatnonzero(~hit)
                by = np.searchsorted(tokens.doc[miss], np.arange(len(texts) + 1))
                rare, times = [], []
                for i in range(len(texts)):
                    values, n = np.unique(tokens.hash[miss[by[i]:by[i + 1]]], return_counts=True)
                    rare.append(W.signed(values))
                    times.append(n)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("held_out"), pa.array(np.diff(tokens.first)),
                    pa.array(np.add.reduceat(hit.astype(np.int64), heads)), pa.array(counted), pa.array(rest),
                    pa.array(np.diff(W.raw(texts)[1])), pa.array(rare, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64())),
                ], names=["doc_id", "held_out", "n_tokens", "known", "counted", "rest", "n_bytes", "rare", "rare_n"])

    return job


def scored(docs: DataFrame, parts: int = 5, held: int = 1) -> DataFrame:
    """Scores of ``docs(doc_id, text)``, learned from those whose crc32 of the id modulo ``parts`` isn't ``held``."""
    number = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0))
    texts = docs.select("doc_id", "text", (number % parts == held).alias("held_out"))
    learned = materialize(texts.filter("not held_out").select("text").mapInArrow(
        _train, "word long, n long, piece int, at binary, counts binary"
    ), "learned")
    sums = learned.filter("word is not null").groupBy("word").agg(F.sum("n").alias("c"))
    counts, seen = measured(sums, "counts", total=F.coalesce(F.sum("c"), F.lit(0)))
    n, v = seen["total"] or 0, seen["rows"]
    shares = np.full(1 << CODE_BITS, -np.log10(0.5))
    code = F.shiftrightunsigned("word", 64 - CODE_BITS).cast("int")
    codes = counts.groupBy(code.alias("code")).agg((F.sum("c") + 0.5 * (F.count(F.lit(1)) + 1)).alias("all")).toArrow()
    shares[codes.column("code").to_numpy()] = -np.log10(codes.column("all").to_numpy())
    top = counts.groupBy(F.shiftrightunsigned("word", 46).alias("slot")).agg(F.max(F.struct("c", "word")).alias("m")).select("slot", "m.c", "m.word").toArrow()
    keys, logs = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS)
    slots = top.column("slot").to_numpy()
    keys[slots] = top.column("word").to_numpy().view(np.uint64)
    logs[slots] = np.log10(top.column("c").to_numpy() + 0.5)
    table = np.zeros(COUNTERS, np.int8)
    pieces = learned.filter("piece is not null").select("piece", "at", "counts").repartition(64, "piece").mapInArrow(_predict, "piece int, logits binary")
    for row in pieces.collect():
        table[row["piece"] * PIECE:(row["piece"] + 1) * PIECE] = np.frombuffer(row["logits"], np.int8)
    shared = docs.sparkSession.sparkContext.broadcast((keys, logs, table, shares))
    rows = materialize(texts.mapInArrow(_score_of(shared), _SCORED).withColumn("uid", F.monotonically_increasing_id()), "scored")
    rare = rows.select("uid", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select(
        "uid", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("times")
    ).join(counts.select("word", "c"), "word", "left").groupBy("uid").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("times"))).alias("more_known"),
    )
    sums = F.col("counted") + F.coalesce("more", F.lit(0.0))
    score = sums + F.col("rest")
    return rows.drop("rare", "rare_n").join(rare, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (sums - F.col("n_tokens") * F.lit(float(np.log10(n + 0.5 * (v + 1))))).alias("base_score"), score.alias("score"),
        (-score / float(np.log10(2)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )

"""Similarity join on word n-grams: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

Two texts link when the Jaccard similarity of their n-gram sets is at least the threshold. How the links are found:

1. One pass gives every text the size and the fingerprint of its set, and a bitmap whose bits are the parities of its hashed
   n-grams. Equal sets are one node from here on. Hashed counters of a fixed size tell which n-grams may be very common; these are
   written under several salts, so that no task gets all rows of one.
2. A second pass writes down, per node, as many n-grams as a set may lack in a link, and a quarter of the set more: the first ones in
   an order (rarer by the counters, then by hash). Two linked sets have as many of these in common as the smaller one's quarter. A shuffle
   counts which nodes share each, and a node with too few shared ones is out, whatever passages it has in common with others.
   Of the shared ones, in order of their exact count (rare first, salted ones last), two linked sets have one in common among the
   first few of each. Those are kept. The result doesn't depend on the orders.
3. Nodes that meet in an n-gram form tiles by size band: a partner's size lies in the same band or the next.
   Within a tile every member is compared with one leader first. Members that are then connected need no
   further comparison among themselves, so a group of n near copies costs about n comparisons, not n squared. Rounds
   with other leaders follow while they pay; then every remaining pair of different components, whose sizes allow
   a link, is compared. A pair that meets in several n-grams is compared where it meets first: rows carry the few tile
   n-grams before theirs in the node's order, and a meeting is passed over when those of both sides have one in common.
   No tile, list or group is cut.
4. A comparison first bounds the overlap from above: sets that differ in d n-grams have bitmaps that differ in d bits at
   most. Rows of a tile carry the bitmap folded to 256 bits, so most pairs end where they meet; then whole bitmaps, wide as
   the sets are large, are compared. What the bound leaves is decided by intersecting the sorted arrays.
5. Links become components by star contraction in joins.

Within a component only as many links are looked up as connect it; ``links`` therefore is a connecting set, not all pairs.

Nodes are 64-bit fingerprints of sets and n-grams 64-bit hashes; the chance that any two of n differ but collide is
about n * n / 2**65.

Rows need a doc_id; rows without one get no links of their own. Null and empty texts and texts without words have empty sets and link with nothing. A text with fewer words than the
n-gram length has its whole sequence as its one n-gram. Rows that repeat are members of the same node. Extra columns are
not touched. Empty tables give empty results.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm import sketch, words as W
from tidemark.llm.graph import components
from tidemark.scratch import counted, materialize

WIDTH = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Counters that tell which n-grams are salted: 8 MB on the driver, 1 MB (one byte each) in each task. No n-gram occurs more
#: often than its counter says, so what is not salted has at most twice the counters' mean and ``SALT_EVERY`` rows.
COUNTERS = 1 << 20
#: An n-gram whose counter passes this is written under several salts, one for each so many.
SALT_EVERY = 1 << 14
#: Leader rounds go on while the rest would take more comparisons than this many for each n-gram written down, and
#: while a round saves at least this share of them. Then the rest is compared outright.
OUTRIGHT = 8
PAYS = 0.5

#: So many n-grams before its own does a row of a tile carry, to pass over pairs that have met there already.
EARLIER = 4

#: Bits of a bitmap for each n-gram, at least. With 4, sets at the threshold lose a fourteenth of their difference to
#: n-grams that share a bit, whatever their size; with 1, a quarter.
ROOM = 4
#: Bits of the short signature that rows of a tile carry: the bitmap folded to so many.
SIGNATURE = 256

_SETS = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("bits", pa.binary()), *sketch.SCHEMA,
])
SIGNS = [f"s{k}" for k in range(SIGNATURE // 64)]
#: Columns of small numbers stand together: rows are then compressed better in a shuffle.
_POSTS = pa.schema([("salt", pa.int32()), ("gram", pa.int64()), ("node", pa.int64())])
#: This share of a set's n-grams is written down beside those that it may lack: one in so many.
MORE = 4
#: Stands for the count of a salted n-gram.
COMMON = 1 << 40


def _shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    return W.windows(W.split(texts, W.BLANKS), width, short=True)


def bitmap(grams: np.ndarray) -> bytes:
    """Parity bits of hashed n-grams: a power of two, ``ROOM`` times the size or more, 256 at least."""
    size = max(SIGNATURE, ROOM << max(len(grams) - 1, 0).bit_length())
    odd = np.bincount((grams & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(bits: bytes, size: int) -> np.ndarray:
    """A bitmap at a smaller power of two: places are hashes modulo the size, so halves are added as parities."""
    got = np.frombuffer(bits, np.uint8)
    while len(got) > size:
        got = got[:len(got) // 2] ^ got[len(got) // 2:]
    return got


def may_link(n: int, m: int, one: bytes, other: bytes, percent: int = PERCENT) -> bool:
    """False only if sets of ``n`` and ``m`` n-grams with these bitmaps can't link."""
    size = min(len(one), len(other))
    apart = int(np.bitwise_count(_folded(one, size) ^ _folded(other, size)).sum())
    overlap = min((n + m - apart) // 2, n, m)
    return 100 * overlap >= percent * (n + m - overlap)


def _signed_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the short signature, as four bigints."""
    for batch in batches:
        folded = [_folded(bits, SIGNATURE // 8) for bits in batch.column("bits").to_pylist()]
        short = np.array(folded, np.uint8).reshape(-1, SIGNATURE // 8).view(np.int64)
        for k in range(SIGNATURE // 64):
            batch = batch.append_column(f"s{k}", pa.array(short[:, k]))
        yield batch


def _bound(n: str, m: str, one: str, other: str, percent: int) -> str:
    """SQL: false only if sets whose short signatures are in ``one`` and ``other`` can't link."""
    apart = " + ".join(f"bit_count(s{k}{one} ^ s{k}{other})" for k in range(SIGNATURE // 64))
    overlap = f"least(({n} + {m} - ({apart})) div 2, {n}, {m})"
    return f"100 * {overlap} >= {percent} * ({n} + {m} - {overlap})"


def _sets_of(width: int, extra: list[str]):
    schema = pa.schema([*_SETS, *((name, pa.int64()) for name in extra)])

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part, texts in W.chunks(batch, "text"):
                values, first = W.sorted_sets(*_shingles(texts, width))
                table += np.bincount((values >> np.uint64(44)).astype(np.int64), minlength=COUNTERS)
                rows = [(0, None, None)] * len(texts)
                for i in range(len(texts)):
                    own = values[first[i]:first[i + 1]]
                    if len(own):
                        rows[i] = (len(own), xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63), bitmap(own))
                size, node, bits = zip(*rows, strict=True)
                none = pa.nulls(len(rows))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(bits, pa.binary()),
                    none.cast(pa.int32()), none.cast(pa.binary()), none.cast(pa.binary()), *(part.column(name) for name in extra),
                ], schema=schema)
        found = list(sketch.pieces(table))
        for k in range(0, len(found), 8):
            piece, at, counts = zip(*found[k:k + 8], strict=True)
            none = pa.nulls(len(piece))
            yield pa.RecordBatch.from_arrays([
                none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()),
                pa.array(piece, pa.int32()), pa.array(at, pa.binary()), pa.array(counts, pa.binary()), *(none.cast(pa.int64()) for _ in extra),
            ], schema=schema)

    return job


def _posts_of(width: int, percent: int, levels, total: int):
    """The n-grams to test of every node, once a task. ``levels``: broadcast logarithms of the counters; ``total``: their mean."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = levels.value, set()
        most = 1 << np.maximum(level.astype(np.int64) - 1, 0)
        salted = 1 + np.maximum(most - total, 0) // SALT_EVERY
        for batch in batches:
            for _, texts in W.chunks(batch, "text"):
                values, first = W.sorted_sets(*_shingles(texts, width))
                out = []
                for i in range(len(texts)):
                    own = values[first[i]:first[i + 1]]
                    if not len(own):
                        continue
                    node = xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)
                    if node in seen:
                        continue
                    seen.add(node)
                    tested = len(own) - -(-percent * len(own) // 100) + max(len(own) // MORE, 1)
                    if tested < len(own):
                        # The level in the top five bits, the hash below it.
                        rank = (level[(own >> np.uint64(44)).astype(np.int64)].astype(np.uint64) << np.uint64(59)) | (own >> np.uint64(5))
                        own = own[np.argpartition(rank, tested - 1)[:tested]]
                    out.append((own, node))
                if out:
                    grams = np.concatenate([own for own, _ in out])
                    nodes = np.repeat(np.array([node for _, node in out], np.int64), [len(own) for own, _ in out])
                    spread = salted[(grams >> np.uint64(44)).astype(np.int64)]
                    salts = np.where(spread > 1, 1 + nodes % spread, 0).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(salts), pa.array(W.signed(grams)), pa.array(nodes)], schema=_POSTS)

    return job


def _arrays_of(width: int, wanted):
    """Sorted arrays of the texts whose doc_id is in a broadcast presence map, with a few more."""
    schema = pa.schema([("node", pa.int64()), ("grams", pa.binary())])

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            some = sketch.maybe_present(wanted.value, ids.fill_null(0).to_numpy()) & ids.is_valid().to_numpy(zero_copy_only=False)
            for _, texts in W.chunks(batch.filter(pa.array(some)), "text"):
                values, first = W.sorted_sets(*_shingles(texts, width))
                runs = [values[first[i]:first[i + 1]].tobytes() for i in range(len(texts))]
                yield pa.RecordBatch.from_arrays([
                    pa.array([xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in runs], pa.int64()), pa.array(runs, pa.binary()),
                ], schema=schema)

    return job


def _bounded(percent: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, one, other = (batch.column(x).to_pylist() for x in ("n", "m", "bits_a", "bits_b"))
            keep = [may_link(*x, percent) for x in zip(n, m, one, other, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return job


def _exact(percent: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("grams_a"), batch.column("grams_b"), strict=True):
                one, other = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(one) > len(other):
                    one, other = other, one
                both = np.concatenate([one, other])
                both.sort(kind="stable")  # two runs in order: a merge
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return job


class NgramJoin:
    """The join over ``docs(doc_id, text)``; ``members`` and ``links`` are its results. Members carry the bigints ``extra``."""

    def __init__(self, docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, extra: tuple[str, ...] = ()):
        self.spark, self.width, self.percent = docs.sparkSession, width, percent
        self.docs = docs.select("doc_id", "text")
        fields = "doc_id long, n_shingles long, node long, bits binary, " + sketch.ROWS + "".join(f", {name} long" for name in extra)
        both = materialize(docs.select("doc_id", "text", *extra).mapInArrow(_sets_of(width, list(extra)), fields), "sets")
        #: doc_id, n_shingles, node (null for an empty set), extra
        self.members = both.filter("n_shingles is not null").select("doc_id", "n_shingles", "node", *extra)
        self._bits = both.filter("node is not null").select("node", "bits", F.col("n_shingles").alias("n"))
        self._counts = sketch.total(both.filter("piece is not null"), COUNTERS)

    def _common(self, n: str) -> str:
        """SQL: tested n-grams that a set of ``n`` has in common with any larger one that it links with."""
        return f"greatest({n} div {MORE}, 1)"

    def _met(self) -> DataFrame:
        """Where nodes meet: n-grams of the nodes that share enough of theirs to link, among the first few of two nodes or more."""
        levels = np.zeros(COUNTERS, np.uint8)
        some = self._counts > 0
        levels[some] = np.floor(np.log2(self._counts[some])).astype(np.uint8) + 1
        held = self.spark.sparkContext.broadcast(levels)
        posts = self.docs.select("text").mapInArrow(
            _posts_of(self.width, self.percent, held, int(self._counts.mean())), "salt int, gram long, node long"
        )
        # Rows of a node from several tasks follow each other here; one goes on.
        here = "over (partition by gram, salt)"
        shared = posts.selectExpr(
            "*", "lag(node) over (partition by gram, salt order by node) as before",
            f"min(node) {here} as low", f"max(node) {here} as high", f"count(*) {here} as nodes",
        ).filter("(salt > 0 or low < high) and (before is null or before < node)").selectExpr(
            "salt", f"if(salt > 0, {COMMON}L, nodes) as common", "gram", "node"
        )
        sizes = self._bits.groupBy("node").agg(F.min("n").alias("n"))
        # The smallest partner has percent of the nodes' n-grams and needs its own share of tested ones in common.
        placed = shared.join(sizes, "node").selectExpr(
            "salt", "gram", "node", "n", "count(*) over (partition by node) as shared",
            "row_number() over (partition by node order by common, gram) - 1 as pos",
        ).selectExpr("salt", "pos", "shared - pos as rest", "n", "gram", "node").filter(f"rest >= {self._common(f'({self.percent} * n div 100)')}")
        # An n-gram that two nodes wrote down gives its pair here. One of three or more keeps its members, and each with the
        # least as a first leader. A salted n-gram is held to be one of those, since its rows are not all in one place.
        # Only nodes that could link with the next smaller or, from within their short prefix, the next larger one count.
        sized = placed.selectExpr(
            "*", "lag(n) over (partition by gram, salt order by n) as below", "lead(n) over (partition by gram, salt order by n) as above"
        ).filter(f"salt > 0 or 100 * below >= {self.percent} * n or rest >= {self._common('n')} and 100 * n >= {self.percent} * above")
        ends = sized.selectExpr(
            "gram", "salt", "node", "n", "pos", "rest",
            "min(node) over (partition by gram, salt) as low", "max(node) over (partition by gram, salt) as high",
        ).filter("salt > 0 or low < high")
        shared = ends.selectExpr("*", "max(node > low and node < high or salt > 0) over (partition by gram, salt) as many")
        kept = shared.filter("many or node = high").selectExpr(
            "if(many, gram, null) as gram", "node", "n", "pos", "rest", "low as leader", "many"
        )
        return materialize(kept, "met")

    def links(self) -> DataFrame:
        """``a, b``: links between nodes, enough of them to connect what any links connect."""
        met = self._met()
        # Only nodes that meet another one are ever compared.
        meeting = met.select(F.explode(F.array("node", "leader")).alias("node")).distinct()
        self._known = materialize(self._bits.join(meeting, "node", "left_semi").dropDuplicates(["node"]).mapInArrow(
            _signed_bits, "node long, bits binary, n long, " + ", ".join(f"s{k} long" for k in range(SIGNATURE // 64))
        ), "bits")
        pairs = met.filter("node <> leader").select(F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b"))
        found = self._verified(pairs)
        band = F.floor(F.log("n") / F.lit(math.log(100 / self.percent))).alias("band")
        live, rows = counted(met.filter("many").select("gram", "node", "n", "pos", "rest", band), "live")
        before = math.inf
        for turn in itertools.count():
            if not rows:
                break
            labels = materialize(components(found), "labels")
            placed = live.join(labels, "node", "left").select(live["*"], F.coalesce("root", "node").alias("comp"))
            sides = placed.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("size"))
            mains = sides.groupBy("gram").agg(
                F.sum("size").alias("total"), F.count(F.lit(1)).alias("sides"), F.max(F.struct("size", "comp")).alias("main")
            ).filter("sides > 1").select("gram", "total", F.col("main.size").alias("size"), F.col("main.comp").alias("main_comp"))
            # N-grams whose members are all connected are done with.
            placed, rows = counted(placed.join(mains, "gram"), "apart")
            # Comparisons, if all were done now: members outside a gram's main component, times all the gram's members.
            cost = placed.filter("comp <> main_comp").agg(F.sum(F.col("total").cast("double")).alias("cost")).first()["cost"] or 0
            last = cost <= OUTRIGHT * rows or cost > (1 - PAYS) * before
            # Only now do rows carry signatures: those that went through the joins above stay narrow.
            signed = placed.join(self._known.select("node", *SIGNS), "node")
            more = self._verified(self._outright(signed) if last else self._with_leaders(signed, turn))
            found = found.unionByName(more)
            if last:
                break
            live, before = placed.select(*live.columns), cost
        return found

    def _with_leaders(self, placed: DataFrame, turn: int) -> DataFrame:
        """Each member of a tile outside the gram's main component with a leader of that component in the tile."""
        lead = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("leader"), F.col("n").alias("m"), *[F.col(x).alias(f"{x}_2") for x in SIGNS]))
        leaders = placed.filter("comp = main_comp").groupBy("gram", "band").agg(lead.alias("lead")).select(
            "gram", "band", "lead.leader", "lead.m", *[f"lead.{x}_2" for x in SIGNS]
        )
        return placed.filter("comp <> main_comp").join(leaders, ["gram", "band"]).filter(
            f"100 * least(n, m) >= {self.percent} * greatest(n, m) and {_bound('n', 'm', '', '_2', self.percent)}"
        ).select(F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b"))

    def _outright(self, placed: DataFrame) -> DataFrame:
        """All pairs of different components that meet in a gram: one side lies outside the gram's main component.

        The first n-gram that both wrote down always gives the pair: nothing before it is common, so what either has from
        there on must hold the tested n-grams that they need in common. Of two sides outside the main component the lesser node comes first.
        """
        # A node has no more rows than its text has n-grams.
        ahead = Window.partitionBy("node").orderBy("pos").rowsBetween(-EARLIER, -1)
        sides = ["node", "n", "pos", "rest", "comp", "band", "earlier", *SIGNS]
        placed = materialize(
            placed.select("*", F.collect_list("gram").over(ahead).alias("earlier")).select("gram", "main_comp", *sides), "signed"
        )
        one = placed.filter("comp <> main_comp").select("gram", *sides)
        other = placed.select("gram", F.expr("comp = main_comp").alias("inner_2"), *[F.col(x).alias(f"{x}_2") for x in sides])
        met = one.join(other, "gram").filter(
            f"comp <> comp_2 and (inner_2 or node < node_2) and abs(band - band_2) <= 1 and 100 * least(n, n_2) >= {self.percent} * greatest(n, n_2)"
            f" and least(rest, rest_2) >= {self._common('least(n, n_2)')}"
            f" and {_bound('n', 'n_2', '', '_2', self.percent)} and not arrays_overlap(earlier, earlier_2)"
        )
        return met.select(F.greatest("node", "node_2").alias("a"), F.least("node", "node_2").alias("b"))

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs that link: first by the bitmaps' bound, then by the sorted arrays."""

        def with_both(df: DataFrame, side: DataFrame, names: list[str], out: list[str]) -> DataFrame:
            for key, mark in (("a", 0), ("b", 1)):
                df = df.join(side.select(F.col("node").alias(key), *[F.col(x).alias(y[mark]) for x, y in zip(names, out, strict=True)]), key)
            return df

        tested = with_both(pairs.distinct(), self._known, ["n", "bits"], [("n", "m"), ("bits_a", "bits_b")])
        may, some = counted(tested.mapInArrow(_bounded(self.percent), "a long, b long"), "may")
        if not some:
            return may
        nodes = may.select(F.col("a").alias("node")).unionByName(may.select(F.col("b").alias("node"))).distinct()
        owners = self.members.join(nodes, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
        wanted = self.spark.sparkContext.broadcast(sketch.presence(owners))
        arrays = materialize(self.docs.mapInArrow(_arrays_of(self.width, wanted), "node long, grams binary"), "arrays")
        sure = with_both(may, arrays, ["grams"], [("grams_a", "grams_b")])
        return materialize(sure.mapInArrow(_exact(self.percent), "a long, b long"), "links")

    def rooted(self) -> DataFrame:
        """``members`` with ``root``, the least node of their component, as a written table."""
        roots = components(self.links())
        return materialize(self.members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")

    def grouped(self) -> DataFrame:
        """``doc_id, n_shingles, node, component_id``: one row per row of the input."""
        rows = self.rooted()
        least = rows.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
        return rows.join(least, "root", "left").select(
            "doc_id", "n_shingles", "node", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
        )


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` without near copies: of each component one row stays, and all rows without words or without a doc_id.

    The row that stays has the least doc_id of the component; of rows that repeat it, the least hash of the text; of rows
    that repeat both, the least hash of the whole row. Rows that repeat a doc_id in different components are different rows.
    """
    named = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    key, text = (f"c{docs.columns.index(name)}" for name in ("doc_id", "text"))
    hashed = named.withColumn("_same", F.xxhash64(text))
    found = NgramJoin(hashed.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), "_same"), width, percent, ("_same",))
    rows = found.rooted().filter("root is not null and doc_id is not null").groupBy("root", "doc_id", "_same").agg(F.count(F.lit(1)).alias("n"))
    least = rows.groupBy("root").agg(F.min(F.struct("doc_id", "_same", "n")).alias("least"))
    keep = materialize(least.select(F.col("least.doc_id").alias(key), "least._same", "least.n"), "keep")
    wordless = ~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    once = hashed.join(keep.filter("n = 1").drop("n"), [key, "_same"], "left_semi").drop("_same")
    rank = F.row_number().over(Window.partitionBy(key, "_same").orderBy(F.xxhash64(*named.columns)))
    often = hashed.join(keep.filter("n > 1").drop("n"), [key, "_same"], "left_semi").withColumn("_rank", rank).filter("_rank = 1")
    rest = named.filter(wordless | F.col(key).isNull())
    return once.select(*named.columns).unionByName(often.select(*named.columns)).unionByName(rest).toDF(*docs.columns)

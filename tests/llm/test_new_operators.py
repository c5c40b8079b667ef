"""Merkle manifest, best-fit packing and whitening against plain versions, with nulls, ties, repeated rows, long texts and empty tables."""

import hashlib
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import best_fit, merkle, whitening
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.tokens import ByteLevel, Memory

SHAPE = "doc_id long, source string, lang string, n_chars long, text string, grp int, place string, task string"


def corpus(count, sources, seed=3):
    rng = random.Random(seed)
    out = []
    for k in range(count):
        text = rng.choice([None, "", "ABC def", f"Text Ü {k}", "low", "é" * rng.randint(0, 40)])
        out.append((rng.choice([k, k, k, k // 3]), rng.choice(sources), rng.choice(["en", None]), rng.choice([None, k]), text, 1, "x", "y"))
    return out + [(None, None, None, None, None, 1, "x", "y")] * 3 + out[:5]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, lower=False):
    def field(v):
        if v is None:
            return "-"
        v = str(v)
        return f"{len(v.encode())}:{v}"

    i, source, lang, n, text = row[:5]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return h("".join(map(field, (i, source, lang, n, text))))


def plain_manifest(rows):
    """The report by whole levels: every version is the whole tree made anew."""

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([h("".join(levels[-1][k:k + 16])) for k in range(0, len(levels[-1]), 16)])
        return levels

    def beside(levels, at):
        out = ""
        for level in levels[:-1]:
            run = at - at % 16
            out += "".join(x for k, x in enumerate(level[run:run + 16], run) if k != at)
            at //= 16
        return out

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    members = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r))) for s in sources}
    trees = {s: tree([plain_leaf(r) for r in members[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    root, out = top[-1][0], []
    for number, s in enumerate(sources):
        for at, row in enumerate(members[s]):
            leaf = trees[s][0][at]
            now = plain_leaf(row, lower=True) if row[0] is not None and crc32(str(row[0]).encode()) % 5 == 0 else leaf
            own = tree([*trees[s][0][:at], now, *trees[s][0][at + 1:]])[-1][0]
            folded = tree([*top[0][:number], own, *top[0][number + 1:]])[-1][0]
            proof = h(beside(trees[s], at) + beside(top, number))
            out.append((row[0], leaf, trees[s][-1][0], root, proof, folded, folded == root))
    return out


@pytest.mark.parametrize(("count", "sources", "depth"), [(1, [None], 1), (90, ["a", "B", None, "", "é"], 1), (700, ["one"], 1), (300, [f"s{k}" for k in range(40)], 2)])
def test_manifest(spark, count, sources, depth):
    data = corpus(count, sources)
    docs = spark.createDataFrame(data, SHAPE).repartition(3)
    found = [tuple(r) for r in merkle.Manifest(docs, depth=depth).report().collect()]
    assert sorted(found, key=str) == sorted(plain_manifest(data), key=str)


def test_versions_share_all_nodes_but_their_path(spark):
    data = corpus(400, ["a", "b"])
    report = merkle.Manifest(spark.createDataFrame(data, SHAPE), depth=1).report(with_nodes=True).collect()
    for row in report:
        assert (len(row.copied) > 0) == (row.doc_id is not None and crc32(str(row.doc_id).encode()) % 5 == 0)
        assert not row.copied or (row.copied[-1] == row.folded_root and row.verified == (row.copied[0] == row.leaf))


def test_manifest_of_nothing_and_of_a_long_text(spark):
    none = spark.createDataFrame([], SHAPE)
    assert merkle.Manifest(none).report().count() == 0
    row = (5, "s", "en", 1, "Long " * 400_000, 1, "x", "y")
    assert [tuple(r) for r in merkle.Manifest(spark.createDataFrame([row], SHAPE)).report().collect()] == plain_manifest([row])


def plain_bins(sizes, length):
    rooms = []
    for size in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= size]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else length) - size)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    length = rng.choice([1, 2, 7, 16, 50])
    sizes = [rng.randint(1, length) for _ in range(rng.randint(0, 150))]
    bins = {}
    for size, count in Counter(sizes).items():
        runs = sorted(r for r in best_fit.plan(Counter(sizes), length) if r[0] == size)
        for number in range(count):
            _, begin, each, first, offset = [r for r in runs if r[1] <= number][-1]
            behind = number - begin
            bins.setdefault(first + behind // each, []).append((offset + behind % each * size, size))
    left = []
    for places in bins.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        left.append(length - at)
    assert sorted(left) == plain_bins(sizes, length) and sorted(bins) == list(range(len(bins)))


def test_ids_are_those_of_whole_texts():
    rng = random.Random(5)
    parts = ["a", "b", "Z", " ", "  ", "\n", "\t", "\r", " \n", "'s", "'", "’", "é", "×", "日", "1", "23", ".", ",", "$$", "<|endoftext|>", "\xa0", "　", "\x1c", "_", "😀"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        own = ByteLevel(tokenizer_path(name))
        own.memory = Memory(4000)  # forgets often
        ids, first = own.ids(pa.array(texts))
        whole = own.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        assert [ids[first[i]:first[i + 1]].tolist() for i in range(len(texts))] == [x.ids for x in whole]


def test_best_fit_packing(spark):
    rng = random.Random(6)
    texts = [None, "", "same", "same", "Long text, " * 9000, *[" ".join(["word"] * rng.randint(0, 60)) for _ in range(200)]]
    docs = spark.createDataFrame([(k // 2 if k < 8 else k, t, 1, 2) for k, t in enumerate(texts)] + [(None, "no id", 1, 2)], "doc_id long, text string, task int, number int").repartition(3)
    path, length = tokenizer_path("byte_bpe_50k.json"), 64
    tokenizer = ByteLevel(path).tokenizer
    got = best_fit.packed(docs, path, length, with_ids=True)
    rows = got.collect()
    whole = Counter((r.doc_id, tuple(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + (0,)) for r in docs.collect())
    assert sum(r.length for r in rows) == sum(len(ids) * n for (_, ids), n in whole.items())
    expected = Counter()
    for (doc_id, ids), n in whole.items():
        at = 0
        for k, size in enumerate(best_fit.cuts(len(ids), length)):
            part = np.array(ids[at:at + size], "<u4")
            expected[(doc_id, k, at, size, crc32(part.tobytes()))] += n
            at += size
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    bins = {}
    for r in rows:
        assert r.ids_crc32 == crc32(np.array(r.ids, "<u4").tobytes())
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids))
    left = []
    for places in bins.values():
        at = 0
        for offset, size, _ in sorted(places):
            assert offset == at
            at += size
        left.append(length - at)
    assert sorted(left) == plain_bins([r.length for r in rows], length)
    for row in best_fit.sequences(got, length).collect():
        assert len(row.ids) == length and row.ids[:row.used] == [i for *_, ids in sorted(bins[row.sequence_id]) for i in ids]
    assert best_fit.use(got, length).first().sequences == len(bins)
    assert best_fit.packed(docs.filter("doc_id < 0"), path, length).count() == 0


VECTORS = "vec_id long, embedding array<float>, n int, deviation string"


def plain_whitening(vectors, components=8):
    x = np.array([[int(np.floor(1024 * c)) + 100000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(0)
    centred = (x * n - s).astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    keep = [k for k in range(len(values)) if values[k] > 1e-10 * values[0]][:components]
    return ((x * n - s) ** 2).sum(1), (centred @ axes / np.sqrt(np.abs(values) + 1e-300))[:, keep], values[keep] / values.sum()


@pytest.mark.parametrize(("count", "dims"), [(300, 12), (40, 3), (6, 10)])
def test_whitening(spark, count, dims):
    rng = np.random.default_rng(count)
    vectors = np.float32(rng.normal(size=(count, dims)) * np.arange(1, dims + 1)).tolist()
    vectors[1] = vectors[0]
    odd = [None, [], [None] * dims, [float("nan")] * dims, [float("inf")] + [0.0] * (dims - 1), [1.0] * (dims + 1)]
    data = [(k, v, 1, "x") for k, v in enumerate(vectors)] + [(900 + k, v, 1, "x") for k, v in enumerate(odd)]
    found = whitening.whiten(spark.createDataFrame(data, VECTORS).repartition(3)).collect()
    deviation, whitened, explained = plain_whitening(vectors)
    components = whitened.shape[1]
    assert len(found) == count * components and {r.n for r in found} == {count}
    got = np.zeros(whitened.shape)
    for r in found:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviation[r.vec_id] and abs(r.explained - explained[r.component - 1]) < 1e-9
    signs = np.sign((got * whitened).sum(0))
    assert np.abs(got - whitened * signs).max() < 1e-8
    assert max(r.identity_error for r in found) < 1e-9


def test_whitening_of_little(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0], 1, "x"), (None, [1.0, 2.0], 1, "x")], VECTORS)
    assert whitening.whiten(same).count() == 0
    far = spark.createDataFrame([(1, [3e38, 0.0], 1, "x"), (None, [-3e38, 1.0], 1, "x"), (3, [0.0, 0.0], 1, "x")], VECTORS)
    rows = whitening.whiten(far).collect()
    assert {r.vec_id for r in rows} == {1, None, 3} and all(r.deviation is None for r in rows if r.vec_id != 3)


def test_factor_and_rotations_keep_small_eigenvalues():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(400, 30)) * np.logspace(0, 4, 30)
    scatter = rows.T @ rows
    factor = whitening.pivoted_cholesky(scatter)
    assert np.allclose(factor @ factor.T, scatter)
    values, axes = whitening.eigen(scatter)
    assert np.abs(axes.T @ axes - np.eye(30)).max() < 1e-12
    assert np.abs(np.linalg.norm(rows @ axes, axis=0) ** 2 / values - 1).max() < 1e-9
    assert len(whitening.rounds_of(7)) == 7 and len({tuple(p) for r in whitening.rounds_of(7) for p in r.tolist()}) == 21

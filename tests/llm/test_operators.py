"""The operators against plain versions, on small tables with nulls, empty and repeated rows, and clashing columns."""

import hashlib
import re
import tracemalloc
from collections import Counter
from zlib import crc32

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    chat_format, context_mixing, decontaminate, html_text, license_scan, packing, quality_rules, sharding, substring_dedup,
)
from tidemark.llm import words as W
from tidemark.llm.ngram_join import NgramJoin, bitmap, may_link, one_of_each

BASE = [f"w{k}" for k in range(60)]
TEXTS = [
    (1, " ".join(BASE)), (2, " ".join([*BASE[:59], "other"])), (3, " ".join([*BASE[:40], *[f"z{k}" for k in range(20)]])),
    (4, " ".join(BASE)), (5, "Ab c"), (6, "aB  C\n"), (7, ""), (8, None), (9, " \n\t"), (10, "é " * 30), (11, " ".join(BASE).upper()),
]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture
def docs(rows):
    return rows("doc_id long, text string, node string, n_words int", *[(i, t, "x", 0) for i, t in TEXTS])


def empty(docs):
    return docs.filter("doc_id < 0")


def test_words_are_those_of_the_expression():
    texts = ["Ab\x00 c\x85d　e", "", "x  Y\x0bz", "é É"]
    found = W.split(pa.array(texts), W.BLANKS)
    for i, text in enumerate(texts):
        own = [found.data[a:b].tobytes() for a, b in zip(found.start, found.end, strict=True)][found.first[i]:found.first[i + 1]]
        assert own == [w.encode().replace(b"\x00", b"\xff") for w in plain_words(lower(text))]


def test_ngram_join(docs):
    sets = {}
    for i, text in TEXTS:
        w = plain_words(lower(text))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in NgramJoin(docs).grouped().collect()}
    assert got == {i: (len(sets[i]), root[i]) for i in sets}
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in sets if not sets[i] or root[i] == i}
    assert NgramJoin(empty(docs)).grouped().count() == 0


def test_bitmaps_bound_from_above():
    values = W.mix(pa.array(range(400)).to_numpy().astype("uint64"))
    for cut in (0, 30, 57, 120):
        one, other = values[:300], values[cut:300 + cut]
        linked = 100 * (300 - cut) >= 75 * (300 + cut)
        assert may_link(300, 300, bitmap(one), bitmap(other)) or not linked


def test_substring_dedup(rows):
    said = "One two three. Four five six. Seven eight nine ten."
    docs = rows("doc_id long, text string, places int, n_chars long", (2, f"Zero. {said} End of it.", 1, 0), (1, said, 1, 0), (3, None, 1, 0), (4, "", 1, 0))
    out = substring_dedup.dedup(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: said, 2: "Zero. End of it.", 3: None, 4: ""}
    assert substring_dedup.dedup(empty(docs)).count() == 0


def test_quality_rules(docs):
    ledger = quality_rules.ledger(docs, ["doc_id"])
    for row in ledger.collect():
        text = dict(TEXTS)[row.doc_id]
        assert (row.n_words, row.word_chars) == (len(plain_words(text)), sum(map(len, plain_words(text))))
    few = {r.doc_id for r in ledger.filter(~quality_rules.passes("base")).collect()}
    assert few == {5, 6, 7, 8, 9, 10}
    shares = {r.rule: (r.failing, r.kept_without) for r in quality_rules.ablation(ledger, "base").collect()}
    assert shares["few_words"] == (5, 10)
    kept = quality_rules.accepted(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 4}
    assert quality_rules.accepted(empty(docs)).count() == 0


def test_decontamination(rows, docs):
    items = rows("item_id long, text string", (7, " ".join(BASE[10:25])), (8, "ab, C"), (9, None), (7, " ".join(BASE[10:25])))
    got = {r.doc_id: r for r in decontaminate.report(docs, items).collect()}
    assert (got[1].n_hit, got[1].n_items, got[5].n_hit, got[8].n_words) == (15, 1, 2, 0)
    assert got[1].items_sha256 == hashlib.sha256(b"7").hexdigest()
    cleaned = {r.doc_id: r.text for r in decontaminate.clean(docs, items).collect()}
    assert plain_words(cleaned[1]) == BASE[:10] + BASE[25:]
    assert 5 not in cleaned and cleaned[8] is None
    assert decontaminate.clean(docs, empty(items.withColumnRenamed("item_id", "doc_id")).withColumnRenamed("doc_id", "item_id")).count() == len(TEXTS)
    with pytest.raises(ValueError):
        decontaminate.report(docs, items, limit=5)


def test_context_mixing(docs):
    rows_ = {r.doc_id: r for r in context_mixing.scored(docs).collect()}
    counts = Counter()
    for i, text in TEXTS:
        if crc32(str(i).encode()) % 5 != 1:
            counts.update([*plain_words(lower(text)), "\n"])
    for i, text in TEXTS:
        own = [*plain_words(lower(text)), "\n"]
        assert (rows_[i].n_tokens, rows_[i].train_tokens) == (len(own), sum(counts.values()))
        assert rows_[i].n_known == sum(counts[w] > 0 for w in own)
        assert rows_[i].held_out == (crc32(str(i).encode()) % 5 == 1) and rows_[i].score < 0
    assert context_mixing.scored(empty(docs)).count() == 0


def test_chat_format(rows):
    turns = rows("conv_id long, turn long, role string, text string, mask int", (1, 0, "system", "s", 0), (1, 1, "ann", "<|hi", 0), (1, 2, "bo", None, 0), (None, 0, "cy", "x", 0), (2, 0, "system", "only", 0))
    got = {(r.conv_id, r.perspective, r.turn): (r.kind, r.mask, r.rendered) for r in chat_format.rotated(turns).collect()}
    assert got[1, "ann", 1] == ("assistant", True, "<|assistant|>\n< |hi<|end|>\n")
    assert got[1, "bo", 1] == ("user", False, "<|user name=ann|>\n< |hi<|end|>\n")
    assert len(got) == 7 and (None, "cy", 0) in got
    assert chat_format.rotated(turns.limit(0)).count() == 0


def test_html_text():
    page = (
        "<html lang=en><nav><a href=x>Menu</a></nav><article><h1>Title &amp; more</h1><p>One\n two<p>Three <b>four</b></p>"
        "<div class='comments'>Nice!</div><script>var a='<p>';</script></article><aside>Side</aside><footer>&copy;</footer>"
    )
    assert html_text.main_text(page) == "Title & more One two Three four"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p") == ""


def test_packing(docs):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rows_ = packing.pieces(docs, path, length=16, with_ids=True).collect()
    assert len({r.sequence_id for r in rows_}) == len(rows_)
    for i, text in TEXTS:
        own = sorted((r for r in rows_ if r.doc_id == i), key=lambda r: r.start)
        assert [x for r in own for x in r.ids] == [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        assert all(r.length == len(r.ids) and r.length & (r.length - 1) == 0 and r.length <= 16 for r in own)
    assert packing.pieces(empty(docs), path).count() == 0


def test_license_scan(rows):
    docs = rows(
        "doc_id long, text string, labels int", (1, "x\nReleased under the MIT License.", 0), (2, None, 0),
        (3, "a " * 90 + "Licensed under CC BY-NC 4.0.", 0), (4, "mit", 0),
    )
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.labels, r.score) for r in license_scan.scan(docs).collect()}
    assert got == {1: (6, 1, 2, "mit", 1.0), 2: (0, 0, None, "", 0.0), 3: (97, 1, 92, "cc-by-nc", 1.0), 4: (1, 0, None, "", 0.0)}
    assert license_scan.scan(empty(docs)).count() == 0


def test_sharding(rows):
    docs = rows("doc_id long, text string, shard int", *[(k, f"t{k % 40}" if k < 60 else None if k < 70 else f"u{k}", 9) for k in range(203)])
    got = sharding.sharded(docs).collect()
    counts = Counter(r.shard for r in got)
    assert len(got) == 203 and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert {r.slot for r in got if r.shard == shard} == set(range(n))
    pairs = sharding.cut(sharding.sharded(docs)).first()
    assert pairs["cut"] <= 0.2 * pairs["pairs"]
    assert sharding.sharded(empty(docs)).count() == 0


def test_substring_dedup_keeps_rows_of_one_id_apart(rows):
    said = "One two three. Four five six. Seven eight nine ten."
    clean = "Red green blue. White black grey. Pink brown gold silver."
    long = f"Many more sentences here. Some that nobody else has. And so on it goes. {said} The end."
    docs = rows(
        "doc_id long, text string, row int", (1, said, 0), (2, clean, 1), (2, long, 2), (2, "", 3), (2, "Short.", 4),
        (None, f"Zero. {said} End of it.", 5), (None, f"Null. {said} Other end.", 6), (7, clean, 7), (7, clean, 8), (None, "", 9),
    )
    got = {r.row: r.text for r in substring_dedup.dedup(docs).collect()}
    # No id comes first, then by id; of rows without id and equal places, one keeps the passage.
    assert sorted([said in got[5], said in got[6]]) == [False, True]
    assert {got[5].replace(f"{said} ", ""), got[6].replace(f"{said} ", "")} == {"Zero. End of it.", "Null. Other end."}
    assert got[0] == "" and got[1] == clean and said not in got[2] and got[2].startswith("Many more sentences here.")
    assert (got[3], got[4], got[7], got[8], got[9]) == ("", "Short.", "", "", "")
    twice = rows("doc_id long, text string", (1, said), (1, said), (None, clean), (None, clean), (None, clean))
    assert sorted(r.text for r in substring_dedup.dedup(twice).collect()) == sorted([said, "", clean, "", ""])


def test_substring_dedup_of_short_lines_and_of_long_sentences(rows):
    brief = " ".join(f"V{k}." for k in range(60))
    lines = "\n".join(f"two l{k}" for k in range(40))
    docs = rows("doc_id long, text string", (1, brief), (2, f"Opening words. {brief}"), (3, lines), (4, lines), (5, "A. B. C."), (6, "A. B. C."))
    got = {r.doc_id: r.text for r in substring_dedup.dedup(docs).collect()}
    assert got == {1: brief, 2: "Opening words. ", 3: lines, 4: "", 5: "A. B. C.", 6: "A. B. C."}
    passage = " ".join(f"p{k}" for k in range(60))
    moved = [(k, " ".join([*(f"o{k}x{j}" for j in range(k)), passage, f"tail{k}"])) for k in range(16)]
    same = [(20, "one " * 100), (21, "one " * 90)]
    out = substring_dedup.dedup(rows("doc_id long, text string", *moved, *same), report=True).collect()
    lost = {r.doc_id: r.n_removed for r in out}
    assert lost[0] == 0 and all(30 <= lost[k] <= 60 for k in range(1, 16))
    for r in out:
        assert r.doc_id >= 20 or f"tail{r.doc_id}" in r.text and all(f"o{r.doc_id}x{j}" in r.text.split() for j in range(r.doc_id))
    assert lost[21] >= 80


def test_pipeline_hands_few_bytes_to_python_at_once(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    def probe(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    path = str(tmp_path / "documents.parquet")
    spark.range(2000).select(F.col("id").alias("doc_id"), F.expr("repeat(concat('word', id, ' '), 1500)").alias("text")).coalesce(1).write.parquet(path)
    before = {key: value for key, value in spark.conf.getAll.items() if key in corpus_pipeline.LIGHT}
    try:
        for _, stage in corpus_pipeline.STAGES[:1] + corpus_pipeline.STAGES[-1:]:
            for key in corpus_pipeline.LIGHT:
                spark.conf.unset(key)
            stage(spark, spark.read.parquet(path), str(tmp_path))
            seen = spark.read.parquet(path).mapInArrow(probe, "rows long, bytes long").collect()
            assert sum(r["rows"] for r in seen) == 2000
            # About 25 MB of text in one task; a row more than 4 MB at most.
            assert max(r["bytes"] for r in seen) < 5 << 20
        key = next(iter(corpus_pipeline.LIGHT))
        spark.conf.set(key, "1m")
        corpus_pipeline.quality(spark, spark.read.parquet(path), str(tmp_path))
        assert spark.conf.get(key) == "1m"
    finally:
        for key in corpus_pipeline.LIGHT:
            spark.conf.set(key, before[key]) if key in before else spark.conf.unset(key)


def test_pipeline_keeps_rows_without_or_with_repeated_ids(spark, tmp_path):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    import corpus_pipeline

    one, two, three, four, five = (" ".join(f"{x}{k}" for k in range(40)) for x in ("alpha", "beta", "gamma", "delta", "omega"))
    data = [
        (1, one), (1, two), (2, two), (2, three), (3, three), (None, four), (None, five), (4, one), (5, f"{three} more"), (6, five[:-7]),
        (7, "too short"), (None, ""), (8, None), (9, "zeta " + " ".join(f"eta{k}" for k in range(30))), (9, "zeta " + " ".join(f"eta{k}" for k in range(30))),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in one_of_each(docs.withColumn("_same", F.lit(1)).repartition(3)).drop("_same").collect()]
    want = [*data[:2], data[3], *data[5:7], *data[9:14]]
    assert sorted(map(str, kept)) == sorted(map(str, want))
    path = str(tmp_path)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "nothing of this stands in any text at all here now")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    whole = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    tokens = Counter()
    for r in corpus_pipeline.run(spark, path).collect():
        tokens[r.doc_id] += r.length
    # Short texts go by a rule, and what (6, ...) repeats of a row without id goes by its spans.
    want = Counter()
    for i, text in [(1, one), (1, two), (2, three), (None, four), (None, five), data[13]]:
        want[i] += len(whole.encode(text, add_special_tokens=False).ids) + 1
    assert {i: tokens[i] for i in want} == dict(want) and set(tokens) <= {*want, 6}


def test_license_notices_wrapped_and_near_each_other(rows):
    bsd = "Copyright (c)\n\n * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that\n"
    texts = {
        1: (bsd, "bsd"), 2: ("This is licensed under the GNU General\nPublic License version\n3.", "gpl-3"),
        3: ("Subject to the terms of the Mozilla Public\nLicense, version 2.0.", "mpl-2"), 4: ("GNU Lesser General Public\nLicense v2.1", "lgpl"),
        5: ("licensed under CC BY-SA 4.0", "cc-by-sa"), 6: ("made available under CC BY-NC-4.0, licensed", "cc-by-nc"),
        7: ("GNU General Public License version 2", "gpl-2"), 8: ("licensed under CC BY 4.0", ""), 9: ("with or without\nmodification are permitted", ""),
        10: ("x " * 400 + "\n" + bsd, "bsd"), 11: ("Licensed under the Apache License, Version 2.0.\nEs geht mit", "apache-2"),
    }
    docs = rows("doc_id long, text string", *[(k, text) for k, (text, _) in texts.items()])
    assert {r.doc_id: r.labels for r in license_scan.scan(docs).collect()} == {k: label for k, (_, label) in texts.items()}
    lines = {(r.doc_id, r.label): r.line for r in license_scan.matches(docs).collect()}
    assert lines[1, "bsd"] == 0 and lines[2, "gpl-3"] == 0


def test_sharding_of_tables_full_of_copies(rows):
    for size, bound in ((2, 0.05), (10, 0.45)):
        docs = rows("doc_id long, text string", *[(k, f"t{k // size}") for k in range(800)])
        got = sharding.sharded(docs)
        counts = Counter(r.shard for r in got.collect())
        assert set(counts.values()) == {100}
        pairs = sharding.cut(got).first()
        assert pairs["cut"] <= bound * pairs["pairs"], (size, pairs)
    assert sharding.quotas({(0, 1): 5, (1, 2): 4, (2, 0): 3, (1, 0): 2}, {0: 0, 1: 0, 2: 0}) == {(0, 1): 5, (1, 2): 3, (2, 0): 3, (1, 0): 2}


def test_license_scan_loses_no_pair_of_block_and_template(rows):
    long = " ".join(f"term{k}" for k in range(49))
    texts = {
        1: "This work is licensed under the GNU General Public License, version", 2: "GNU General Public License version", 3: "x " * 40 + long,
        4: "redistributions and use in source and binary forms with or without modification are permitted", 5: "released under the mit licence",
        6: "y " * 22 + "this work is licensed under the gnu general public license version 2",
    }
    docs = rows("doc_id long, text string", *texts.items())
    own = {"own": [long], "two": ["a b c d e"]}
    for templates in (license_scan.TEMPLATES, own):
        meant = set()
        stride = max(16, *(len(t.split()) for ts in templates.values() for t in ts))
        for i, text in texts.items():
            w = re.findall("[a-z0-9]+", lower(text))
            for block, k in enumerate(range(0, max(len(w) - stride - 1, 0) + 1, stride)):
                held = set(w[k:k + 2 * stride])
                meant |= {(i, block, x) for x, ts in templates.items() for t in ts if len(held & set(t.split())) >= 0.8 * len(set(t.split()))}
        found = license_scan.matches(docs, None if templates is license_scan.TEMPLATES else templates)
        assert {(r.doc_id, r.block, r.label) for r in found.collect()} == meant and meant
    labels = {r.doc_id: r.labels for r in license_scan.scan(docs).collect()}
    # Without its number a notice of either version is no sign of one; what a block cuts is decided by its neighbour.
    assert labels == {1: "gpl-3", 2: "", 3: "", 4: "bsd", 5: "mit", 6: "gpl-2"}
    assert {r.doc_id: r.labels for r in license_scan.scan(docs, own).collect()}[3] == "own"


def test_context_mixing_predicts_the_word_and_not_only_its_first_letters(rows):
    held = [k for k in range(400) if crc32(str(k).encode()) % 5 == 1][:4]
    said = [f"{a} {b}" for a, b in (("red", "xyone"), ("blue", "xytwo"), ("green", "xythree"), ("grey", "xyfour"))]
    texts = {k: " ".join([said[k % 4], said[k // 4 % 4]] * 3) for k in range(400)}
    other = ["red xytwo", "blue xyone", "green xyfour", "grey xythree"]
    texts |= {held[0]: " ".join(said), held[1]: " ".join(other), held[2]: "nobody said this", held[3]: None}
    got = {r.doc_id: r for r in context_mixing.scored(rows("doc_id long, text string", *texts.items())).collect()}
    true, turned = got[held[0]], got[held[1]]
    assert abs(true.base_score - turned.base_score) < 1e-9
    # The same words after others than in training: each is far less likely.
    assert true.score > turned.score + 2 and true.score > true.base_score
    assert got[held[2]].score < true.score and got[held[3]].n_tokens == 1


def test_bits_of_a_group_share_one_probability():
    counts = context_mixing.np.array([3, 0, 0, 7] + [0] * 11 + [40], dtype="int64")
    node = context_mixing.logits(counts) / context_mixing.SCALE
    total = 0
    for leaf in range(16):
        p = 1.0
        for depth in range(4):
            one = 1 / (1 + 2.718281828459045 ** -node[(1 << depth) + (leaf >> (4 - depth))])
            p *= one if leaf >> (3 - depth) & 1 else 1 - one
        total += p
    assert abs(total - 1) < 1e-9
    table = {packed[0]: packed for packed in context_mixing._packed(context_mixing.np.repeat(context_mixing.np.uint32([0, 300]), context_mixing.PIECE))}
    assert set(table) == {1} and len(table[1][2]) == 2 * context_mixing.PIECE


def _plain_mixed(words, logit):
    """Bit by bit, in double precision: what mixed() says for one text."""
    m = context_mixing
    tokens = m.Tokens(pa.array([" ".join(words)]))
    weights = m.np.tile(m.START, (m.CODE_BITS, 1))
    total, slope = 0.0, m.np.zeros_like(weights)
    spread = [None, *tokens.contexts]
    for t, code in enumerate(int(c) for c in tokens.code):
        for bit in range(m.CODE_BITS):
            group, depth = divmod(bit, m.BITS)
            begun, leaf = code >> (m.CODE_BITS - m.BITS * group), code >> (m.CODE_BITS - m.BITS * (group + 1)) & 15
            inputs = []
            for predictor, context in enumerate(spread):
                row = int(m.PLAIN[group]) + begun
                if predictor:
                    mark = (begun + (1 << m.BITS * group)) * 0x9E3779B97F4A7C15 * 0xC4CEB9FE1A85EC53
                    row = int(m.FIRST[predictor]) + ((int(context[t]) + mark) % (1 << 64) >> (64 - m.ROW_BITS))
                inputs.append(logit[row * 16 + (1 << depth) + (leaf >> (m.BITS - depth))] / m.SCALE)
            inputs, one = m.np.array(inputs), leaf >> (m.BITS - 1 - depth) & 1
            p = 1 / (1 + m.np.exp(-m.np.clip(inputs @ weights[bit], -15, 15)))
            total += m.np.log(p if one else 1 - p)
            slope[bit] += inputs * (one - p)
        if (t + 1) % m.BLOCK == 0:
            weights += m.RATE * slope
            slope[:] = 0
    return total


def test_mixing_in_steps_is_mixing_bit_by_bit():
    m = context_mixing
    table = m.np.random.default_rng(5).integers(-40, 41, m.COUNTERS).astype("int8")
    texts = [[f"w{(k * k + n) % 23}" for k in range(n)] for n in (0, 1, 31, 32, 33, 63, 64, 100, 7, *[40] * 70)]
    got = m.mixed(m.Tokens(pa.array([" ".join(t) for t in texts])), m.paths(table))
    for words, total in list(zip(texts, got, strict=True))[:10]:
        assert abs(total - _plain_mixed(words, table)) < 1e-5 * abs(total)


def test_mixing_holds_no_row_numbers_and_inputs_of_a_whole_chunk():
    m = context_mixing
    told = m.paths(m.np.ones(m.COUNTERS, "int8"))
    tokens = m.Tokens(pa.array([" ".join(f"w{k % 97}" for k in range(400))] * 600))
    tracemalloc.start()
    m.mixed(tokens, told)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Five contexts of eight bytes, and what it takes to make them; with every counter's number beside them it was 263 bytes a token.
    assert peak < 180 * len(tokens.hash)

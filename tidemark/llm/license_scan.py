"""License scan: an exact set-similarity join of text blocks with templates.

A block is a window of words, twice as long as the longest template and 32 at least, that starts at every half of its length, line
breaks being separators like others: a template's words standing together always lie in one block, however the notice is wrapped.
Block and template are sets of words; a block matches if it contains at least ``THRESHOLD`` of the template's words, and every such
pair is returned. Words are in order of how rare they are in the corpus (counted over all texts), and a template's prefix are so many
first words that a match must have one of them. Blocks with a word of some prefix are joined with the templates by those words; the
filter on length passes over blocks with too few words, that on position over pairs whose first common word comes so late that
what follows can't suffice. What remains is decided by the exact intersection.

Licences that share most words are told apart after that. A match that has all of its label's required words gives its label. Another one does
only where no such match stands in its block or the next ones, and no other label's is as good: without the number, a notice of one
version is no sign of the other.

The templates are a fixed table of a few rows, and are what is broadcast; no text is shuffled for the join. Each block
and template meet once, where their first common prefix word is.

Beside it, places where a base phrase stands word by word are counted. Words: A-Z in lower case, then
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Null and empty texts have no words, labels '' and score 0. The score is the largest
containment of a match that gives a label, 1 with a base phrase. Rows that repeat are each labelled. Extra columns are not touched; empty
tables give empty results. Only built-in functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, functions as F

#: Base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notices by label.
TEMPLATES = {
    "mit": ["released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy"],
    "apache-2": ["licensed under the apache license version 2 0"],
    "gpl-3": ["this work is licensed under the gnu general public license version 3", "gnu general public license version 3"],
    "gpl-2": ["gnu general public license version 2"],
    "lgpl": ["gnu lesser general public license version"],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "creative commons attribution sharealike license"],
    "cc-by": ["creative commons attribution 4 0 international license"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted"],
    "mpl-2": ["subject to the terms of the mozilla public license version 2 0"],
}
#: Words that make a match certain, if the template has them.
REQUIRED = {
    "mit": "released mit license", "apache-2": "apache license 2", "gpl-3": "gnu general 3", "gpl-2": "gnu general 2", "lgpl": "gnu lesser",
    "cc-by-nc": "cc by nc", "cc-by-sa": "cc by sa commons sharealike", "cc-by": "commons attribution 4 international",
    "bsd": "redistribution binary", "mpl-2": "mozilla 2",
}
THRESHOLD = 0.8
#: Half a block, if no template has more words.
STRIDE = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal(text: Column) -> Column:
    """The words of a text, in lower case, with one blank between them."""
    parted = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ")
    return F.trim(F.translate(parted, _UPPER, _LOWER))


def words_of(normal_text: Column) -> Column:
    return F.when(normal_text == "", F.array().cast("array<string>")).otherwise(F.split(normal_text, " "))


def frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many texts each word of the templates occurs: as many rows as there are such words."""
    own = F.array_intersect(words_of(normal(F.col("text"))), F.array(*map(F.lit, vocabulary)))
    counts = docs.select(F.explode(own).alias("word")).groupBy("word").count()
    found = {row["word"]: row["count"] for row in counts.collect()}
    return {word: found.get(word, 0) for word in vocabulary}


def _templates(docs: DataFrame, templates: dict[str, list[str]], required: dict[str, str], threshold: float) -> list[Row]:
    sets = [(label, list(dict.fromkeys(text.split()))) for label, texts in templates.items() for text in texts]
    counts = frequencies(docs, sorted({word for _, own in sets for word in own}))
    out = []
    for label, own in sets:
        ordered = sorted(own, key=lambda word: (counts[word], word))
        must = sorted(set(own) & set(required.get(label, "").split()))
        need = math.ceil(threshold * len(ordered) - 1e-9)
        # Position: with the first common word at k, at most len - k words are common.
        for k, word in enumerate(ordered[:len(ordered) - need + 1]):
            out.append(Row(word=word, label=label, tokens=ordered, earlier=ordered[:k], must=must, need=need))
    return out


def _blocks(prefixes: list[str], stride: int) -> Column:
    """Windows of ``words`` that have a word of some prefix: number, first word's place, distinct words."""
    wanted = "array(" + ", ".join(f"'{word}'" for word in prefixes) + ")"
    return F.expr(
        f"filter(transform(sequence(0, greatest(size(words) - {stride} - 1, 0), {stride}),"
        f" i -> struct(cast(i div {stride} as int) as block, i as at, slice(words, i + 1, {2 * stride}) as held)), x -> arrays_overlap(x.held, {wanted}))"
    )


def matches(docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, same, label, line, block, containment, certain``: every block that meets a template; ``same`` is the text's hash.

    ``line`` is that of the block's first word; ``certain`` are matches with all required words. Templates of one's own have none of these.
    """
    stride = max([STRIDE, *(len(text.split()) for texts in (templates or TEMPLATES).values() for text in texts)])
    found = _templates(docs, templates or TEMPLATES, {} if templates else REQUIRED, threshold)
    table = docs.sparkSession.createDataFrame(
        found, "word string, label string, tokens array<string>, earlier array<string>, must array<string>, need int"
    )
    prefixes = sorted({row.word for row in found})
    near = rf"(?i)(?:^|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])(?:{'|'.join(prefixes)})(?:$|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])"
    texts = docs.filter(F.col("text").rlike(near)).select("doc_id", F.xxhash64("text").alias("same"), "text")
    lines = texts.select("doc_id", "same", F.transform(F.split("text", "\n"), lambda x: words_of(normal(x))).alias("lines"))
    worded = lines.selectExpr(
        "doc_id", "same", "flatten(lines) as words", "flatten(transform(lines, (x, i) -> array_repeat(i, size(x)))) as line_of"
    )
    blocks = worded.withColumn("blocks", _blocks(prefixes, stride)).selectExpr(
        "doc_id", "same",
        "explode(transform(blocks, x -> struct(line_of[x.at] as line, x.block as block, array_distinct(x.held) as held))) as b",
    )
    sets = blocks.select("doc_id", "same", "b.line", "b.block", "b.held")
    keyed = sets.select("*", F.explode(F.array_intersect("held", F.array(*map(F.lit, prefixes)))).alias("word"))
    met = keyed.join(F.broadcast(table), "word").filter(
        "size(held) >= need and not arrays_overlap(held, earlier)"
    )
    common = F.size(F.array_intersect("held", "tokens"))
    return met.filter(common >= F.col("need")).select(
        "doc_id", "same", "label", "line", "block", (common / F.size("tokens")).alias("containment"),
        F.expr("size(array_except(must, held)) = 0").alias("certain"),
    )


def labelled(found: DataFrame) -> DataFrame:
    """``doc_id, same, more, best``: the labels that ``matches`` give a text, and their largest containment."""
    # A notice that a block cuts stands whole in the one before or after, so each match is known to both.
    near = found.groupBy("doc_id", "same", "block", "label").agg(F.max("containment").alias("c"), F.max("certain").alias("sure")).select(
        "doc_id", "same", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("at"),
        F.struct("label", "c", "sure", "block").alias("m"),
    )
    met = near.groupBy("doc_id", "same", "at").agg(F.collect_list("m").alias("ms"))
    kept = met.selectExpr(
        "doc_id", "same",
        "explode(filter(ms, x -> x.block = at and (x.sure or not exists(ms, y -> y.sure or y.label <> x.label and y.c >= x.c)))) as m",
    )
    return kept.groupBy("doc_id", "same").agg(F.collect_set("m.label").alias("more"), F.max("m.c").alias("best"))


def _places(words: str, text: str, phrase: str) -> Column:
    parts = phrase.split()
    same = " and ".join(f"{words}[i + {k}] = '{part}'" for k, part in enumerate(parts))
    return F.when(
        F.concat(F.lit(" "), F.col(text), F.lit(" ")).contains(f" {phrase} "),
        F.expr(f"filter(sequence(0, size({words}) - {len(parts)}), i -> {same})"),
    ).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: words, base phrases, labels and score."""
    labels = labelled(matches(docs, templates, threshold)).select(F.col("doc_id").alias("_id"), F.col("same").alias("_same"), "more", "best")
    read = docs.select("doc_id", F.xxhash64("text").alias("same"), normal(F.col("text")).alias("norm"))
    read = read.select("doc_id", "same", "norm", words_of(F.col("norm")).alias("words"))
    each = {phrase: f"p{k}" for k, phrase in enumerate(PHRASES)}
    based = read.select(
        "doc_id", "same", F.size("words").cast("long").alias("n_words"), *[_places("words", "norm", x).alias(y) for x, y in each.items()]
    )
    starts = F.concat(*each.values())
    own = F.filter(F.array(*[F.when(F.size(y) > 0, F.lit(PHRASES[x])) for x, y in each.items()]), lambda x: x.isNotNull())
    based = based.select(
        "doc_id", "same", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"), F.array_sort(F.array_distinct(own)).alias("base"),
    )
    joined = based.join(labels, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("same") == F.col("_same")), "left")
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )

"""Substring dedup by sliding sentence spans: every run of consecutive sentences is hashed and joined over all texts.

A sentence ends with a word that ends in ``.``, ``!`` or ``?``, or at a line break. One of more than ``LONGEST`` words is cut where
its words say so: before each word whose hash is the least among its ``AROUND`` neighbours on both sides, so that the cuts of
a passage move with it, whatever stands before it. Only where no word does that for ``LONGEST`` words, as in one word
repeated, is it cut by count. A span is ``RUN`` consecutive sentences of one text, and as many more as it takes to have
``LEAST`` words, compared by its lower-cased words. The first place of a span, by doc_id and then by place in the
text, stays; every sentence that some other place of a repeated span covers is removed. Spans may overlap. What
remains of a text keeps its characters; a removed run takes the white space behind it along.

Spans are hashed to 64 bits; counts and first places are combined before the shuffle, so a span that very many
texts share is one row for each task. A second pass writes down only spans that a presence map of fixed size does not rule
out, and those are joined with the repeated spans exactly.

Null and empty texts have no sentences and stay as they are; a text may become empty and stays as a row. Rows that repeat a
doc_id, or have none, with different texts are different documents: places belong to a doc_id and a hash of the text, no
doc_id comes before all others, and of one doc_id the lesser hash comes first. Of rows that repeat doc_id and text one is the
document, and the others are later copies of it. Extra columns are kept. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import sketch, words as W
from tidemark.scratch import counted, materialize

RUN = 3
LEAST = 8
LONGEST = 16
AROUND = 3
_MORE = W.mix(np.arange(1, LONGEST + 1, dtype=np.uint64)) | np.uint64(1)


def sentences(words: W.Words, data: np.ndarray) -> np.ndarray:
    """Number, within its chunk of texts, of the sentence each word is in."""
    total = len(words.start)
    if not total:
        return np.empty(0, np.int64)
    final = np.isin(words.data[words.end - 1], np.frombuffer(b".!?", np.uint8))
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    new = np.ones(total, bool)
    new[1:] = final[:-1] | (lines[words.start[1:]] > lines[words.end[:-1]]) | (words.doc[1:] != words.doc[:-1])
    begins = np.flatnonzero(new)
    sizes = np.diff(np.append(begins, total))
    # Place from the sentence's begin and from its end.
    place = np.arange(total) - np.repeat(begins, sizes)
    behind = np.repeat(sizes, sizes) - 1 - place
    cut = (np.repeat(sizes, sizes) > LONGEST) & (place > 0)
    for k in range(1, AROUND + 1):
        cut[k:] &= (place[k:] < k) | (words.hash[k:] < words.hash[:-k])
        cut[:-k] &= (behind[:-k] < k) | (words.hash[:-k] <= words.hash[k:])
    new |= cut
    begins = np.flatnonzero(new)
    place = np.arange(total) - np.repeat(begins, np.diff(np.append(begins, total)))
    new |= place % LONGEST == 0
    return np.cumsum(new) - 1


def lengths(begins: np.ndarray, total: int, run: int, least: int) -> np.ndarray:
    """Per sentence: how many sentences, from it on, the span that begins there has."""
    enough = np.searchsorted(np.append(begins, total), begins + least)
    return np.maximum(enough - np.arange(len(begins)), run)


def spans(words: W.Words, data: np.ndarray, run: int = RUN, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """Per span: its hash, its text's number, and the number in that text of its first sentence."""
    number = sentences(words, data)
    if not len(number):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    begins = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
    sizes = np.diff(np.append(begins, len(number)))
    place = np.arange(len(number)) - np.repeat(begins, sizes)
    hashed = W.mix(np.add.reduceat(words.hash * _MORE[place], begins))
    doc = words.doc[begins]
    first = np.searchsorted(doc, doc)
    # Where each sentence's text has its last one.
    last = np.searchsorted(doc, doc, side="right")
    length = lengths(begins, len(number), run, least)
    at = np.flatnonzero(np.arange(len(begins)) + length <= last)
    value = np.zeros(len(at), np.uint64)
    for k in range(int(length[at].max()) if len(at) else 0):
        more = length[at] > k
        value[more] = W.mix(value[more] * np.uint64(31) + hashed[at[more] + k])
    return value, doc[at], at - first[at]


def _spans_of(run: int, least: int, wanted=None):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in W.chunks(batch, "text"):
                value, doc, place = spans(W.split(texts, W.BLANKS), W.raw(texts)[0], run, least)
                value = W.signed(value)
                if wanted is not None:
                    some = sketch.maybe_present(wanted.value, value)
                    value, doc, place = value[some], doc[some], place[some]
                doc = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value), part.column("doc_id").take(doc), part.column("same").take(doc), pa.array(place)],
                    names=["span", "doc_id", "same", "place"],
                )

    return job


def repeated(docs: DataFrame, run: int = RUN, least: int = LEAST) -> DataFrame:
    """``doc_id, same, places``: where spans begin that have an earlier place; ``same`` is the text's hash."""
    fields, texts = "span long, doc_id long, same long, place long", docs.select("doc_id", F.xxhash64("text").alias("same"), "text")
    first = texts.mapInArrow(_spans_of(run, least), fields).groupBy("span").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "same", "place")).alias("first")
    ).filter("times > 1").select("span", "first")
    first = materialize(first, "repeated")
    wanted = docs.sparkSession.sparkContext.broadcast(sketch.presence(first.select("span")))
    found = texts.mapInArrow(_spans_of(run, least, wanted), fields).join(first, "span")
    later = found.filter(~F.struct("doc_id", "same", "place").eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "same").agg(F.collect_set("place").alias("places"))


def _with_copies(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with ``_same``, the text's hash, and ``_copy``: whether another row with this doc_id and text is the document."""
    hashed = docs.withColumn("_same", F.xxhash64(text))
    often, some = counted(
        hashed.filter(F.octet_length(text) > 0).groupBy(F.col(doc_id).alias("_of"), F.col("_same").alias("_text")).count()
        .filter("count > 1").select("_of", "_text"), "often"
    )
    if not some:
        return hashed.withColumn("_copy", F.lit(False))
    met = F.col(doc_id).eqNullSafe(F.col("_of")) & (F.col("_same") == F.col("_text"))
    # Only rows that repeat are written, and so get numbers that stay.
    rows = materialize(hashed.join(often, met, "left_semi").withColumn("_row", F.monotonically_increasing_id()), "copies")
    least = rows.groupBy(doc_id, "_same").agg(F.min("_row").alias("_row")).select("_row", F.lit(False).alias("_copy"))
    copies = rows.join(least, "_row", "left").withColumn("_copy", F.coalesce("_copy", F.lit(True))).drop("_row")
    return hashed.join(often, met, "left_anti").withColumn("_copy", F.lit(False)).unionByName(copies)


def dedup(docs: DataFrame, run: int = RUN, least: int = LEAST, report: bool = False) -> DataFrame:
    """``docs`` with repeated sentences removed from ``text``; ``n_chars``, if there, follows.

    ``report`` adds ``n_words`` of the text before and ``n_removed`` of them.
    """
    cut = materialize(repeated(docs, run, least), "cuts").withColumnsRenamed({"doc_id": "_of", "same": "_text"})
    named = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    where = {name: f"c{k}" for k, name in enumerate(docs.columns)}
    text, chars = where["text"], where.get("n_chars")
    joined = _with_copies(named, where["doc_id"], text).join(
        cut, F.col(where["doc_id"]).eqNullSafe(F.col("_of")) & (F.col("_same") == F.col("_text")), "left"
    ).drop("_of", "_text", "_same")
    schema = named.schema
    if report:
        schema = schema.add("n_words", "long").add("n_removed", "long")

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in W.chunks(batch, text):
                data, offsets = W.raw(texts)
                changed, sizes = part.column(text).to_pylist(), part.column(chars).to_pylist() if chars else None
                places, copies = part.column("places").to_pylist(), part.column("_copy").to_pylist()
                touched = [i for i, own in enumerate(places) if own or copies[i]]
                removed = np.zeros(len(changed), np.int64)
                words = W.split(texts, W.BLANKS) if touched or report else None
                number = sentences(words, data) if touched else None
                if touched:
                    begins = np.flatnonzero(np.append(True, number[1:] != number[:-1])) if len(number) else number
                    length = lengths(begins, len(number), run, least)
                if any(copies):
                    _, doc, place = spans(words, data, run, least)
                    for i in np.flatnonzero(copies):
                        places[i] = place[doc == i]
                for i in touched:
                    if not len(places[i]):
                        continue
                    a, b = words.first[i], words.first[i + 1]
                    own = np.asarray(places[i])
                    steps = np.zeros(int(number[b - 1] - number[a]) + 2, np.int64)
                    np.add.at(steps, own, 1)
                    np.subtract.at(steps, own + length[number[a] + own], 1)
                    flags = (np.cumsum(steps) > 0)[number[a:b] - number[a]]
                    removed[i] = np.count_nonzero(flags)
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))).reshape(-1, 2)
                    at, kept = offsets[i], []
                    for x, y in edges:
                        kept.append(data[at:words.start[a + x]].tobytes())
                        at = words.start[a + y] if a + y < b else offsets[i + 1]
                    kept.append(data[at:offsets[i + 1]].tobytes())
                    changed[i] = b"".join(kept).decode()
                    if chars:
                        sizes[i] = len(changed[i])
                out = part.drop_columns(["places", "_copy"])
                out = out.set_column(out.schema.get_field_index(text), text, pa.array(changed, out.schema.field(text).type))
                if chars:
                    out = out.set_column(out.schema.get_field_index(chars), chars, pa.array(sizes, out.schema.field(chars).type))
                if report:
                    out = out.append_column("n_words", pa.array(words.counts)).append_column("n_removed", pa.array(removed))
                yield out

    return joined.mapInArrow(job, schema).toDF(*docs.columns, *(["n_words", "n_removed"] if report else []))

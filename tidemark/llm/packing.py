"""Packing by power-of-two decomposition: every document is cut into pieces of binary lengths, equal lengths go together.

A document of n ids (its tokens, then one end id) is cut into as many whole sequences as fit, then into the powers of two
of what is left, largest first. Each piece is a sequence of its own, so no sequence crosses documents and none is
padded. ``bucket`` is the power; a batch is drawn from one bucket, and has a fixed number of ids whatever the bucket.

Tokens are found once for each distinct word of a chunk of texts: a tokenizer that drops white space, lower-cases, and never
merges across white space or between a letter and a mark gives a text the ids of its parts in order (tests
compare with whole texts). Other tokenizer files work too, see ``tokens``.

A document is worked on where it is read; there is no shuffle, and numbers of sequences are those of the place in
the input, so that a lost task makes the same ones again. Null and empty texts have the end id alone. Very long texts are
cut like any other. Repeated rows are packed each for themselves. Extra columns are not touched; empty tables give empty
results.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import words as W
from tidemark.llm.tokens import CHUNK_BYTES, ByteLevel, Memory, kept, packed_ids, quiet

LENGTH = 2048
END = 1
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket int"
#: Latin letters that the tokenizer's normalizer only lower-cases, and marks that it never joins with a letter before them.
_LETTERS, _MARKS = "a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", r"!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~"


class WordEnds:
    """A lower-casing tokenizer with ends of words: words of plain letters and runs of marks go straight to its model."""

    def __init__(self, path: str):
        quiet()
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.memory = Tokenizer.from_file(path), Memory()
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._model = self.tokenizer.model
        self._spelled = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0x21, 0x100)) if c.isprintable()})

    def plain(self, words: list[str]) -> list[bytes]:
        """Ids of words of plain letters, or of marks."""
        runs, tokenize, spelled = self.memory.all_of(words), self._model.tokenize, self._spelled
        for k, ids in enumerate(runs):
            if ids is None:
                runs[k] = packed_ids([x.id for x in tokenize(words[k].translate(spelled))])
                self.memory.add(words[k], runs[k])
        return runs


def has_word_ends(path: str) -> bool:
    """Whether a tokenizer file is of the kind that ``WordEnds`` takes apart: lower case, white space dropped, letters apart from marks."""
    spec = json.loads(Path(path).read_text())
    steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    before = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = before[0] if before else {}
    return (
        "Lowercase" in steps and bool(spec["model"].get("end_of_word_suffix")) and [x.get("type") for x in before] == ["Split", "ByteLevel"]
        and r"[\p{L}]+" in split.get("pattern", {}).get("Regex", "") and split["pattern"]["Regex"].endswith(r"[^\s\p{L}\p{N}]+")
    )


def _expand(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` that ``chosen`` names, one after the other, and where each begins."""
    lengths = sizes[chosen]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(begins[chosen] - (ends - lengths), lengths)
    return flat[at], np.concatenate([[0], ends])


def _ids_of(words: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of distinct words without blanks, as runs of one array: the array, where runs begin, their lengths."""
    own = kept(("word ends", path), lambda: WordEnds(path))
    simple = pc.match_substring_regex(words, f"^(?:[{_LETTERS}]+|[{_MARKS}]+)$").to_numpy(zero_copy_only=False)
    runs = own.plain(pc.utf8_lower(words.filter(pa.array(simple))).to_pylist())
    ids = [np.frombuffer(b"".join(runs), np.uint32)]
    sizes = np.zeros(len(words), np.int64)
    sizes[simple] = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
    hard = words.filter(pa.array(~simple)).to_pylist()
    found = [x.ids for x in own.tokenizer.encode_batch_fast(hard, add_special_tokens=False)] if hard else []
    sizes[~simple] = [len(x) for x in found]
    ids.append(np.fromiter((i for x in found for i in x), np.uint32))
    begins = np.zeros(len(words), np.int64)
    begins[simple] = np.cumsum(sizes[simple]) - sizes[simple]
    begins[~simple] = len(ids[0]) + np.cumsum(sizes[~simple]) - sizes[~simple]
    return np.concatenate(ids), begins, sizes


def _parts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct blank-separated parts, their number in order of appearance, and where each text's begin."""
    listed = pc.ascii_split_whitespace(texts)
    coded = listed.flatten().dictionary_encode()
    offsets = listed.offsets.to_numpy().astype(np.int64)
    # Leading and trailing blanks leave empty parts, which have no ids.
    return coded.dictionary, coded.indices.to_numpy(), offsets - offsets[0]


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts (no nulls) one after the other, and where each text's begin."""
    if not kept(("has word ends", path), lambda: has_word_ends(path)):
        return ByteLevel.of(path).ids(texts)
    words, order, first = _parts(pc.ascii_lower(texts))
    # Marks behind a letter are a token of their own: cutting them off leaves far fewer distinct words.
    cut = pc.replace_substring_regex(words, f"^(.*[{_LETTERS}])([{_MARKS}]+)$", r"\1 \2")
    parts, places, begins = _parts(cut)
    ids, at, sizes = _ids_of(parts, path)
    runs, run_first = _expand(ids, at, sizes, places)
    flat, word_first = _expand(runs, run_first[begins[:-1]], run_first[begins[1:]] - run_first[begins[:-1]], order)
    return flat, word_first[first]


def cuts(n: int, length: int = LENGTH) -> list[int]:
    """Lengths of the pieces of ``n`` ids: whole sequences, then the binary digits of the rest."""
    rest = n % length
    return [length] * (n // length) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, with_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``; each is a sequence. ``with_ids`` adds the ids themselves.

    ``length`` is a power of two.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in W.chunks(batch, "text", CHUNK_BYTES):
                ids, first = token_ids(texts, path)
                rows: list[tuple] = []
                for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    own = np.append(ids[first[i]:first[i + 1]], np.uint32(end)).astype("<u4")
                    at = 0
                    for size in cuts(len(own), length):
                        piece = own[at:at + size]
                        row = (doc_id, at, size, crc32(piece.tobytes()), len(own), size.bit_length() - 1)
                        rows.append((*row, piece.tolist()) if with_ids else row)
                        at += size
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64()] * 5 + [pa.int32()] + [pa.list_(pa.int64())] * with_ids
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket"] + ["ids"] * with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    found = docs.select("doc_id", "text").mapInArrow(job, PIECES + ", ids array<long>" * with_ids)
    return found.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def buckets(packed: DataFrame, batch_ids: int) -> DataFrame:
    """Per bucket: sequences, ids, and batches of ``batch_ids`` ids; combined before the shuffle, one row per power."""
    return packed.groupBy("bucket").agg(F.count(F.lit(1)).alias("sequences"), F.sum("length").alias("ids")).withColumn(
        "batches", F.ceil(F.col("ids") / F.lit(batch_ids))
    )

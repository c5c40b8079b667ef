"""Benchmark decontamination: a generalised suffix automaton of the test items reads the training texts.

The automaton holds all runs of words of all items. Reading a text word by word, it knows at every word the longest run
of words up to here that some item holds. Where that length reaches a window's, the window occurs and its words are hit.
An item with fewer words than a window, but not none, is a window as a whole.

The items are a small table by nature: they are gathered only if their texts together have at most ``ITEM_BYTES``, else
``ValueError``. The automaton has at most two states for each item word and is built once in each task.

Most words of a text can't be part of an occurrence. Two bitmaps of fixed size, of hashed item words and of hashed pairs
of neighbouring item words, pass over them; the automaton reads what is left, with whole words, so the result is exact.

Null and empty texts have no words and are never hit. Items without words never occur. Repeated rows are each treated
like any other; repeated item_ids count once. Extra columns are kept by ``clean``. Empty tables give empty results, and
without items nothing is hit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import words as W

WINDOW = 10
#: Bound of what is gathered and sent to every task.
ITEM_BYTES = 64 << 20
_MAP = 1 << 22


class Automaton:
    """Generalised suffix automaton of word sequences."""

    def __init__(self, items: list[list[bytes]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[int]] = [set()]
        self.short = [0]
        for number, item in enumerate(items):
            at = 0
            for word in item:
                at = self._extend(at, word)
                while len(ends) < len(self.next):
                    ends.append(set())
                    self.short.append(0)
                ends[at].add(number)
            if 0 < len(item) < window:
                self.short[at] = len(item)
        # Longer states first: what ends in a state ends in those it links to; short items are noticed from below.
        order = sorted(range(len(self.next)), key=lambda s: self.length[s])
        for s in reversed(order[1:]):
            if self.length[self.link[s]] >= window:
                ends[self.link[s]] |= ends[s]
        #: Per state: the nearest state at or below it that is a short item as a whole.
        self.item_below = [0] * len(self.next)
        for s in order[1:]:
            self.item_below[s] = s if self.short[s] else self.item_below[self.link[s]]
        self.ends = ends
        self.whole = {}
        for number, item in enumerate(items):
            if 0 < len(item) < window:
                self.whole.setdefault(tuple(item), set()).add(number)

    def _state(self, length: int, link: int, following: dict[bytes, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            copy = self._split(last, known, word)
            return copy
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at != -1:
            known = self.next[at][word]
            self.link[new] = known if self.length[known] == self.length[at] + 1 else self._split(at, known, word)
        return new

    def _split(self, at: int, known: int, word: bytes) -> int:
        copy = self._state(self.length[at] + 1, self.link[known], dict(self.next[known]))
        self.link[known] = copy
        while at != -1 and self.next[at].get(word) == known:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def read(self, words: list[bytes], found: set[int]) -> Iterator[tuple[int, int, int]]:
        """``end, begin, longest`` of every window that occurs in ``words``; ``found`` gets the items that hold it."""
        state = length = 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(word, 0)
            length = length + 1 if state else 0
            if length >= self.window:
                at = state
                while self.length[self.link[at]] >= self.window:
                    at = self.link[at]
                found |= self.ends[at]
                yield i + 1, i + 1 - self.window, length
            # Short items that end here are suffixes of what has been matched.
            at = self.item_below[state] if length >= self.length[state] else self._within(state, length)
            while at:
                found |= self.whole[tuple(words[i + 1 - self.short[at]:i + 1])]
                yield i + 1, i + 1 - self.short[at], length
                at = self.item_below[self.link[at]]

    def _within(self, state: int, length: int) -> int:
        """The nearest short item that is a suffix of ``length`` matched words in this state."""
        if self.short[state] and self.short[state] <= length:
            return state
        return self.item_below[self.link[state]] if state else 0


def item_words(text: str | None) -> list[bytes]:
    words = W.split(pa.array([text or ""]), W.ALNUM)
    return [words.data[a:b].tobytes() for a, b in zip(words.start, words.end, strict=True)]


def _scan(items: list[tuple[int, str]], window: int, column: str):
    """For a batch: per text the number of words, hit words' places in bytes, items found and longest match."""
    sequences = [item_words(text) for _, text in items]
    least = min([window, *(len(x) for x in sequences if x)])
    joined = W.split(pa.array([text or "" for _, text in items], pa.string()), W.ALNUM)
    single, pairs = np.zeros(_MAP, bool), np.zeros(_MAP, bool)
    mask = np.uint64(_MAP - 1)
    single[(joined.hash & mask).astype(np.int64)] = True

    def pair_places(words: W.Words) -> np.ndarray:
        return ((words.hash[:-1] * np.uint64(3) + words.hash[1:] >> np.uint64(20)) & mask).astype(np.int64)

    if len(joined.hash) > 1:
        pairs[pair_places(joined)[joined.doc[1:] == joined.doc[:-1]]] = True
    automaton = Automaton(sequences, window)

    def scan(batch: pa.RecordBatch):
        for part, texts in W.chunks(batch, column):
            words = W.split(texts, W.ALNUM)
            total = len(words.hash)
            hit, longest, found = np.zeros(total, bool), np.zeros(len(texts), np.int64), {}
            if total and len(items):
                near = single[(words.hash & mask).astype(np.int64)]
                if least > 1 and total > 1:
                    linked = pairs[pair_places(words)] & (words.doc[1:] == words.doc[:-1]) & near[1:] & near[:-1]
                    near = np.zeros(total, bool)
                    near[1:] |= linked
                    near[:-1] |= linked
                    breaks = np.ones(total, bool)
                    breaks[1:] = ~linked
                else:
                    breaks = np.ones(total, bool)
                    breaks[1:] = (words.doc[1:] != words.doc[:-1]) | ~near[1:] | ~near[:-1]
                starts = np.flatnonzero(near & breaks)
                stops = np.flatnonzero(near & np.append(breaks[1:], True)) + 1
                for a, b in zip(starts, stops, strict=True):
                    if b - a < least:
                        continue
                    own = [words.data[x:y].tobytes() for x, y in zip(words.start[a:b], words.end[a:b], strict=True)]
                    items_here: set[int] = set()
                    for end, begin, length in automaton.read(own, items_here):
                        hit[a + begin:a + end] = True
                        i = words.doc[a]
                        longest[i] = max(longest[i], length)
                    if items_here:
                        found.setdefault(int(words.doc[a]), set()).update(items_here)
            yield part, texts, words, hit, found, longest

    return scan


def _items(items: DataFrame, limit: int) -> list[tuple[int, str]]:
    """The items, gathered behind a check of their size."""
    size = items.agg(F.sum(F.octet_length("text") + 16).alias("size")).first()["size"] or 0
    if size > limit:
        raise ValueError(f"the items have {size} bytes; an automaton in every task may have {limit}")
    return [(row["item_id"], row["text"]) for row in items.select("item_id", "text").collect()]


REPORT = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long"
)


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW, limit: int = ITEM_BYTES) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: words, hit words, items with occurring windows."""
    held = docs.sparkSession.sparkContext.broadcast(_items(items, limit))

    def job(batches):
        scan = None
        for batch in batches:
            scan = scan or _scan(held.value, window, "text")
            for part, texts, words, hit, found, longest in scan(batch):
                sums = np.concatenate([[0], np.cumsum(hit)])
                ids = [{held.value[k][0] for k in found.get(i, ())} for i in range(len(texts))]
                n_hit = sums[words.first[1:]] - sums[words.first[:-1]]
                digest = [hashlib.sha256(",".join(sorted(str(x) for x in own)).encode()).hexdigest() for own in ids]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "n_words": words.counts, "n_hit": n_hit,
                    "n_items": [len(own) for own in ids], "items_sha256": digest, "contaminated": n_hit > 0,
                    "longest_match": longest,
                })

    return docs.select("doc_id", "text").mapInArrow(job, REPORT)


def clean(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, max_length: int = WINDOW, max_coverage: float = 0.5,
    limit: int = ITEM_BYTES,
) -> DataFrame:
    """``docs`` without benchmark passages, all columns kept.

    A run of hit words goes from a text if it has ``max_length`` words or more, or if it is a whole short item; white
    space around it stays as one character. If hit words are more than ``max_coverage`` of all, the whole text goes
    and the row with it. ``n_chars``, if there, follows the text. Clean rows are untouched.
    """
    held = docs.sparkSession.sparkContext.broadcast(_items(items, limit))
    has_length = "n_chars" in docs.columns

    def job(batches):
        scan = None
        for batch in batches:
            scan = scan or _scan(held.value, window, "text")
            for part, texts, words, hit, _, _ in scan(batch):
                if not hit.any():
                    yield part
                    continue
                sums = np.concatenate([[0], np.cumsum(hit)])
                n_hit = sums[words.first[1:]] - sums[words.first[:-1]]
                keep = n_hit <= max_coverage * words.counts
                changed, sizes = part.column("text").to_pylist(), part.column("n_chars").to_pylist() if has_length else None
                data, offsets = W.raw(texts)
                for i in np.flatnonzero((n_hit > 0) & keep):
                    a, b = words.first[i], words.first[i + 1]
                    own = np.concatenate([[False], hit[a:b], [False]])
                    edges = np.flatnonzero(own[1:] != own[:-1]).reshape(-1, 2)
                    at, pieces = offsets[i], []
                    for x, y in edges:
                        pieces.append(data[at:words.start[a + x]].tobytes())
                        at = words.end[a + y - 1]
                    pieces.append(data[at:offsets[i + 1]].tobytes())
                    changed[i] = b"".join(pieces).decode()
                    if has_length:
                        sizes[i] = len(changed[i])
                out = part.set_column(part.schema.get_field_index("text"), "text", pa.array(changed, part.schema.field("text").type))
                if has_length:
                    out = out.set_column(out.schema.get_field_index("n_chars"), "n_chars", pa.array(sizes, out.schema.field("n_chars").type))
                yield out.filter(pa.array(keep))

    return docs.mapInArrow(job, docs.schema)

"""Token ids of many texts at once: each distinct unit of a chunk of texts is given to the tokenizer a single time.

A byte-level tokenizer first cuts a text into words (with the one space before them), marks and runs of white space, and
never merges across such cuts. Here texts are cut at those of these places that can be told from bytes: at ASCII white space, and
where letters (ASCII and Latin-1), digits and ASCII marks meet. What lies between two cuts (a unit) is tokenized alone and has the
ids that it has in its text. Texts in which that need not hold (other white space, the tokenizer's special tokens) and texts for
tokenizers of another kind are one unit each.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm import words as W

#: Bytes of text whose distinct units are looked up together.
CHUNK_BYTES = 2 << 20
#: Bytes that a worker process spends on units it remembers; ids don't depend on it.
REMEMBERED_BYTES = 64 << 20
#: Only units of so few characters are remembered.
SHORT = 48
_ENTRY_BYTES = 180
_NATIVE = sys.byteorder == "little" and array("I").itemsize == 4
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Letters, digits and marks of ASCII; 0 for all else.
_LETTER, _DIGIT, _MARK = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_PLAIN = re.compile("(?: ?(?:[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[0-9]+))").fullmatch
#: Characters that some expression may take for white space, beside those of ASCII.
_ODD_BLANKS = r"\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{2064}\x{3000}\x{feff}"


def kept(key: tuple, make):
    """What ``make`` gives, made once in a worker process.

    This subpackage travels to tasks by value, so a module of its own would be new in every task; an attribute of an
    installed module stays as long as the process.
    """
    import tokenizers

    held = tokenizers.__dict__.setdefault("_kept_by_tasks", {})
    if key not in held:
        held[key] = make()
    return held[key]


def quiet():
    """One thread a task: Spark already runs a task on every core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


class Memory:
    """Ids of short units in two generations: when the younger one takes too many bytes it becomes the older, which is forgotten."""

    def __init__(self, limit: int = REMEMBERED_BYTES):
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._limit, self._bytes = limit // 2, 0

    def all_of(self, units: list[str]) -> list[bytes | None]:
        """What is known of each unit."""
        found = list(map(self._young.get, units))
        for k, ids in enumerate(found):
            if ids is None and units[k] in self._old:
                found[k] = self._old[units[k]]
                self.add(units[k], found[k])
        return found

    def add(self, unit: str, ids: bytes) -> None:
        if len(unit) > SHORT:
            return
        self._bytes += _ENTRY_BYTES + len(unit) + len(ids)
        if self._bytes > self._limit:
            self._old, self._young, self._bytes = self._young, {}, 0
        self._young[unit] = ids


def packed_ids(ids: list[int]) -> bytes:
    """As unsigned 32-bit numbers, little-endian."""
    return array("I", ids).tobytes() if _NATIVE else np.array(ids, "<u4").tobytes()


class ByteLevel:
    """A tokenizer file, and the units its ids follow from."""

    def __init__(self, path: str):
        quiet()
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(Path(path).read_text())
        before = spec.get("pre_tokenizer") or {}
        self.by_units = (
            spec.get("normalizer") is None and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before.get("add_prefix_space", True)
        )
        special = [re.escape(x["content"]) for x in spec.get("added_tokens", [])]
        self.whole = "|".join([f"[{_ODD_BLANKS}]", *special])
        self.memory = Memory()
        # A unit of letters or digits alone is one word of the tokenizer; the model takes it without going through all steps.
        self._model, level = self.tokenizer.model, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._spelled = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0x20, 0x100)) if c == " " or c.isalnum()})

    @staticmethod
    def of(path: str) -> ByteLevel:
        return kept(("byte level", path), lambda: ByteLevel(path))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (no nulls) one after the other, and where each text's begin."""
        parts, first = self._units(texts)
        coded = parts.dictionary_encode()
        flat, begins, sizes = self._of_distinct(coded.dictionary.to_pylist())
        chosen = coded.indices.to_numpy()
        lengths = sizes[chosen]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(ends[-1]) + np.repeat(begins[chosen] - ends[:-1], lengths)
        return flat[at], ends[first]

    def _units(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The units, and the first one of each text."""
        data, offsets = W.raw(texts)
        some = np.diff(offsets) > 0
        starts, ends = offsets[:-1][some], offsets[1:][some]
        cut = np.zeros(len(data), bool)
        if self.by_units:
            blank = _BLANK[data]
            before = np.concatenate([[False], blank[:-1]]) if len(data) else blank
            after = np.concatenate([blank[1:], [True]]) if len(data) else blank
            before[starts] = False
            after[ends - 1] = True
            lone = blank & ~after
            # A run of white space begins; its last one stands alone, or is the space that the next word takes along.
            cut = (blank & ~before) | lone
            cut[1:] |= (lone & (data != 0x20))[:-1]
            kind = _KIND[data]
            # The second byte of a Latin-1 letter behind its first, 0xC3; two of these characters are no letters.
            second = np.flatnonzero(data[:-1] == 0xC3) + 1
            second = second[(data[second] != 0x97) & (data[second] != 0xB7)]
            kind[second - 1] = kind[second] = _LETTER
            # An apostrophe may belong to the letters behind it ("'s").
            cut[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0) & ((data[:-1] != 0x27) | (kind[1:] != _LETTER))
            for i in np.flatnonzero(pc.match_substring_regex(texts, self.whole).to_numpy(zero_copy_only=False)):
                cut[offsets[i]:offsets[i + 1]] = False
        cut[starts] = True
        places = np.append(np.flatnonzero(cut), len(data)).astype(np.int64)
        parts = pa.Array.from_buffers(
            pa.large_string(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data))]
        )
        return parts, np.searchsorted(places[:-1], offsets)

    def _of_distinct(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct units as runs of one array: the array, where runs begin, their lengths."""
        memory, model, spelled = self.memory, self._model, self._spelled
        runs = memory.all_of(units)
        rest = []
        for k, run in enumerate(runs):
            if run is not None:
                continue
            unit = units[k]
            if self.by_units and len(unit) <= SHORT and _PLAIN(unit):
                runs[k] = packed_ids([x.id for x in model.tokenize(unit.translate(spelled))])
                memory.add(unit, runs[k])
            else:
                rest.append(k)
        for at in range(0, len(rest), 4096):
            some = rest[at:at + 4096]
            found = self.tokenizer.encode_batch_fast([units[k] for k in some], add_special_tokens=False)
            for k, one in zip(some, found, strict=True):
                runs[k] = packed_ids(one.ids)
                memory.add(units[k], runs[k])
        sizes = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        return np.frombuffer(b"".join(runs), "<u4"), np.cumsum(sizes) - sizes, sizes

"""Quality rules as a ledger: every rule is evaluated once, its failures are bits, and policies are masks over them.

``measures`` reads each text once and writes down what rules ask about. ``ledger`` adds ``failures``, a bigint with one bit
for each rule that a row fails. A policy is a version and the rules it applies; a row is kept under it if none of
their bits is set, so another policy or an ablation reads the ledger and never the texts. ``ablation`` counts by bitwise
aggregation: rows first combine to at most as many groups as bit patterns occur, then every rule's own share follows.

Null and empty texts have no words, measure 0 everywhere and fail ``few_words``. Very long texts are measured whole. Rows
that repeat are each measured. Extra columns stay, but for those named like a measure, which the new ones replace.
Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import words as W

#: Words of abuse.
ABUSE = ["idiot", "moron", "stupid", "pathetic", "worthless", "disgusting", "scum", "trash", "loser", "clown"]
SYMBOLS = "#*$%&|<>"
REPEAT_WIDTH = 8
#: Rule names in bit order, the condition under which a row fails.
RULES = {
    "few_words": "n_words < 20",
    "repeated_runs": "100 * n_repeat_words > 30 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "capitals": "2 * n_capitals > n_letters",
    "exclamations": "5 * n_exclamations > n_words",
    "stutters": "4 * n_stutters > n_words",
    "word_length": "n_words > 0 and (word_chars > 15 * n_words or word_chars < 2 * n_words)",
    "abuse": "n_abuse >= 2 and 200 * n_abuse >= n_words",
}
BASE = ["few_words", "repeated_runs"]
#: Versions of what is applied; old ones stay so that earlier decisions can be repeated.
POLICIES = {"base": BASE, "v1": [name for name in RULES if name != "abuse"], "v2": list(RULES)}
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_letters",
    "n_exclamations", "n_stutters", "n_abuse",
]

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(SYMBOLS.encode())] = 1
_ABUSE = rf"(?i)\b(?:{'|'.join(ABUSE)})\b"
_BLANK = " \t\n\v\f\r"


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeated_words(words: W.Words, width: int) -> np.ndarray:
    values, first = W.windows(words, width, short=False)
    out = np.zeros(len(words.first) - 1, np.int64)
    for i in np.flatnonzero(np.diff(first) > 1):
        own = values[first[i]:first[i + 1]]
        ordered = np.sort(own)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(twice):
            starts = np.flatnonzero(np.isin(own, twice))
            steps = np.zeros(words.first[i + 1] - words.first[i] + 1, np.int64)
            steps[starts] += 1
            np.subtract.at(steps, starts + width, 1)
            out[i] = np.count_nonzero(np.cumsum(steps[:-1]))
    return out


def _measured(texts: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = W.raw(texts)
    words = W.split(texts, W.BLANKS_CASED)
    solid = W.BLANKS[data] != 0
    capital = (data >= 65) & (data <= 90)
    n = len(texts)
    n_lines, n_dup_lines = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, text in enumerate(texts.to_pylist()):
        lines = [line for line in text.split("\n") if line.strip(_BLANK)]
        n_lines[i], n_dup_lines[i] = len(lines), len(lines) - len(set(lines))
    again = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    return {
        "n_words": words.counts, "word_chars": _per_text(solid & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets), "n_lines": n_lines, "n_dup_lines": n_dup_lines,
        "n_repeat_words": _repeated_words(words, REPEAT_WIDTH), "n_capitals": _per_text(capital, offsets),
        "n_letters": _per_text(capital | ((data >= 97) & (data <= 122)), offsets), "n_exclamations": _per_text(data == 33, offsets),
        "n_stutters": np.bincount(words.doc[1:][again], minlength=n), "n_abuse": pc.count_substring_regex(texts, _ABUSE).to_numpy(),
    }


def measures(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and one bigint for each of ``MEASURES``; ``text`` is read once."""
    kept = [name for name in keep if name not in MEASURES]
    schema = docs.select(*kept).schema
    for name in MEASURES:
        schema = schema.add(name, "long")
    source = docs.select(*dict.fromkeys([*kept, "text"]))

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in W.chunks(batch, "text"):
                found = _measured(texts)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(name) for name in kept), *(pa.array(found[name].astype(np.int64)) for name in MEASURES)],
                    names=[*kept, *MEASURES],
                )

    return source.mapInArrow(job, schema)


def mask(rules: list[str]) -> int:
    return reduce(or_, (1 << list(RULES).index(name) for name in rules), 0)


def failing() -> Column:
    """The bits of the failed rules; a comparison with null fails nothing."""
    bits = (F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, rule in enumerate(RULES.values()))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def passes(policy: str, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def ledger(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the measures, and ``failures``."""
    return measures(docs, keep).withColumn("failures", failing())


def ablation(kept_ledger: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: rows failing it, rows only it rejects, and rows kept if it were dropped."""
    bits = mask(POLICIES[policy])
    patterns = kept_ledger.select(F.col("failures").bitwiseAND(F.lit(bits).cast("long")).alias("f")).groupBy("f").agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(mask([name])).cast("long").alias("bit")) for name in POLICIES[policy]
    ])).alias("r")
    return patterns.select("f", "n", rules).groupBy("r.rule").agg(
        F.sum(F.expr("if(f & r.bit <> 0, n, 0)")).alias("failing"),
        F.sum(F.expr("if(f = r.bit, n, 0)")).alias("only_this"),
        F.sum(F.expr("if(f & ~r.bit = 0, n, 0)")).alias("kept_without"),
    )


def accepted(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The rows of ``docs`` kept under a policy, with their own columns only."""
    named = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    text = f"c{docs.columns.index('text')}"
    judged = ledger(named.withColumnRenamed(text, "text"), [*named.columns[:0], *(x if x != text else "text" for x in named.columns)])
    return judged.filter(passes(policy)).drop(*MEASURES, "failures").toDF(*docs.columns)

"""Quality rules with a ledger: each rule runs once, policies are applied to the stored bits.

`ledger` measures every text and stores, next to the measurements, one bit per failed rule.
A policy is a named, versioned set of rules; `apply_policy` compares its mask with the stored
bits, and `ablations` tells, for each rule of a policy, what the policy would keep without it.
Neither looks at a text again.

Defined results: null text has no words, so it fails `few_words`; equal rows are judged alike and
each keeps its row; an empty table gives an empty ledger; only the id and text columns are read,
and the other columns of the input are carried along only if named in `keep`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import NON_SPACE, Chunk, chunks, gram_hash, mix, segment_hash, split_words, whole_grams

WINDOW = 5
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = _LETTERS[0x80:] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters")


@dataclass(frozen=True)
class Rule:
    """Fails where `fails` is true; the place in RULES is its bit, so rules are only ever appended."""

    name: str
    fails: str


#: Bit i belongs to rule i.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("many_symbols", "n_symbols > n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 5 * n_lines"),
    Rule("few_letters", "2 * n_letters < word_chars"),
)

#: Versioned policies: the rules whose failure rejects a text.
POLICIES = {
    "base-1": ("few_words", "repeated_words"),
    "web-1": ("few_words", "repeated_words", "many_symbols", "long_words", "duplicate_lines", "few_letters"),
}


def mask(policy: str) -> int:
    """The bits of a policy's rules."""
    names = [r.name for r in RULES]
    return sum(1 << names.index(x) for x in POLICIES[policy])


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i + 1]] for each i."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _seen_before(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each element, whether an equal one of the same text comes before; whether any equal one exists."""
    order = np.argsort(mix(key ^ mix(doc.astype(np.uint64) + np.uint64(1))), kind="stable")
    d, k = doc[order], key[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (d[1:] == d[:-1]) & (k[1:] == k[:-1])
    earlier, twice = np.zeros(len(order), bool), np.zeros(len(order), bool)
    earlier[order] = same[:-1]
    twice[order] = same[:-1] | same[1:]
    return earlier, twice


def measure(chunk: Chunk) -> dict[str, np.ndarray]:
    """All measurements of a chunk's texts."""
    data, offsets = chunk.data, chunk.offsets
    words = split_words(chunk, NON_SPACE, lower=False)
    inside = NON_SPACE[data]
    out = {
        "n_words": np.diff(words.bounds),
        "word_chars": _per_text(inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(_SYMBOLS[data], offsets),
        "n_letters": _per_text(_LETTERS[data] & ((data & 0xC0) != 0x80), offsets),
    }
    # lines with a word
    cuts = np.unique(np.concatenate((offsets, np.flatnonzero(data == 0x0A), np.flatnonzero(data == 0x0A) + 1)))
    start, end = cuts[:-1], cuts[1:]
    has_word = np.diff(np.concatenate(([0], np.cumsum(inside)))[cuts]) > 0 if len(start) else np.zeros(0, bool)
    start, end = start[has_word], end[has_word]
    line_doc = np.searchsorted(offsets, start, "right") - 1
    earlier, _ = _seen_before(line_doc, segment_hash(data, start, end))
    bounds = np.searchsorted(line_doc, np.arange(len(offsets)))
    out["n_lines"], out["n_dup_lines"] = np.diff(bounds), _per_text(earlier, bounds)
    # words in windows that the text holds twice or more
    at = whole_grams(words, WINDOW)
    _, twice = _seen_before(words.doc[at], gram_hash(words.hash, WINDOW)[at])
    edge = np.zeros(len(words.doc) + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + WINDOW, -1)
    out["n_repeat_words"] = _per_text(np.cumsum(edge[:-1]) > 0, words.bounds)
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text")
        others = [n for n in batch.schema.names if n != "text"]
        for chunk in chunks(text):
            found = measure(chunk)
            part = batch.slice(chunk.first, chunk.last - chunk.first)
            arrays = [part.column(n) for n in others] + [pa.array(found[m].astype(np.int64)) for m in MEASURES]
            yield pa.RecordBatch.from_arrays(arrays, [*others, *MEASURES])


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per text: its id, the kept columns, all measurements and `failed`, the bits of failed rules."""
    narrow = df.select(df[id_col].alias("doc_id"), *(df[c] for c in keep), df[text_col].alias("text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if f.name != "text"]
    measured = narrow.mapInArrow(_measured, ", ".join([*fields, *(f"{m} long" for m in MEASURES)]))
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failed", bits)


def passes(policy: str) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0


def apply_policy(entries: DataFrame, policy: str) -> DataFrame:
    """The ledger with `kept` under a policy."""
    return entries.withColumn("kept", passes(policy))


def ablations(entries: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: texts that fail it, that only it rejects, and that the policy keeps without it."""
    chosen = mask(policy)
    names = [r.name for r in RULES]
    rules = F.array(
        *(
            F.struct(F.lit(n).alias("rule"), F.lit(1 << names.index(n)).cast("long").alias("bit"))
            for n in POLICIES[policy]
        )
    )
    # few combinations of bits exist, whatever the number of texts
    by_bits = entries.groupBy(F.col("failed").bitwiseAND(F.lit(chosen)).alias("bits")).agg(F.count("*").alias("n"))
    each = by_bits.select("bits", "n", F.inline(rules))
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))), F.lit(0)).alias("n_only"),
        F.coalesce(F.sum(F.when((F.col("bits") == 0) | (F.col("bits") == F.col("bit")), F.col("n"))), F.lit(0)).alias(
            "n_kept_without"
        ),
    )

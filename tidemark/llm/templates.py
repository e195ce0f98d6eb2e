"""Line deduplication by equal lines and a tree of log templates.

A line is what its tokens are: the runs between white space of any kind. Recurrence is counted in
distinct texts: documents of equal tokens count once. A line is boilerplate, and dropped, if

- the equal line stands in at least `min_docs` texts, whatever its number of tokens;
- it is long (LONG_TOKENS tokens or LONG_BYTES bytes) and stands in at least `long_docs` texts of which at
  least OWN of the bytes are in lines of no other text, so that copies with edits do not count; or
- its template recurs. Lines are parsed to a fixed depth: their number of tokens, then their leading
  tokens, with tokens that hold a digit taken as variable. Lines of one leaf are generalised
  together: a token stays in the template where at least `min_docs` texts have it at that place, and
  becomes a variable where it does not. The template counts if at least `min_docs` texts share it
  and at least half of its tokens stay. It needs `min_tokens` tokens.

Lines that differ in variables only, and keep half of their tokens, are equal in all three.

A document stays whole, for the stage that removes copies, only if nothing but such lines would be
left of it, or if it is shown to be a copy: at least `copy_share` of its bytes are in such lines, and
another document like that has the same sequence of them.

Sets of leaves and lines are broadcast up to BROADCAST_ROWS hashes, and joined by a shuffle beyond.

Defined results: null text stays null; lines without a letter or digit are never dropped and are
not something left; equal rows are cleaned each; an empty table gives an empty result; of other
columns only those in `keep` are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import checkpointed, stored
from tidemark.llm.words import ALNUM, Chunk, chunks, mix, powers, runs, segment_hash, signed

#: Hashes in a broadcast set, at most (16 bytes each).
BROADCAST_ROWS = 100_000
#: Leading tokens in the key of a leaf.
DEPTH = 3
VARIABLE = "<*>"
#: A line of so many tokens, or bytes where a script has no spaces, is long.
LONG_TOKENS, LONG_BYTES = 50, 300
#: Share of its own that a text needs to count for a long line; with less, it is a near copy of another.
OWN = 0.2
SPACE = r"[\s\x{85}\p{Z}]+"
WORD = r"[\p{L}\p{N}]"
ANY_WORD = regex.compile(WORD)


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _masked(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), F.lit(VARIABLE)).otherwise(t))


def blanks(data: np.ndarray) -> np.ndarray:
    """The bytes of white space of any kind in UTF-8: what SPACE matches."""
    out = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if not len(lead):
        return out
    padded = np.concatenate((data, np.zeros(2, np.uint8)))
    a, b, c = padded[lead], padded[lead + 1], padded[lead + 2]
    two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    narrow = (b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    three = (a == 0xE2) & (narrow | ((b == 0x81) & (c == 0x9F)))
    three |= ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    for at in (lead[two | three], lead[two | three] + 1, lead[three] + 2):
        out[at] = True
    return out


def _in_order(hashes: np.ndarray, bounds: np.ndarray, base: int) -> np.ndarray:
    """A hash of each group's hashes in their order; zero for an empty group."""
    sizes = np.diff(bounds)
    out = np.zeros(len(sizes), np.uint64)
    has = sizes > 0
    if has.any():
        within = np.arange(len(hashes)) - np.repeat(bounds[:-1], sizes)
        out[has] = mix(np.add.reduceat(hashes * powers(int(sizes.max()), base)[within], bounds[:-1][has]))
    return out


def _parsed(min_tokens: int, constant: float, raw: bool):
    """Lines of texts, see `_lines`; raw: with each line itself."""

    def of_chunk(chunk: Chunk, keys: pa.Array) -> pa.RecordBatch:
        data, offsets = chunk.data, chunk.offsets
        n_texts = len(offsets) - 1
        breaks = np.flatnonzero(data == 0x0A)
        per_text = 1 + np.bincount(np.searchsorted(offsets, breaks, "right") - 1, minlength=n_texts)
        first = np.concatenate(([0], np.cumsum(per_text)))
        n_lines = int(first[-1])
        start, end = np.empty(n_lines, np.int64), np.empty(n_lines, np.int64)
        inner = np.ones(n_lines, bool)
        inner[first[:-1]] = False
        start[first[:-1]], start[inner] = offsets[:-1], breaks + 1
        inner[:] = True
        inner[first[1:] - 1] = False
        end[first[1:] - 1], end[inner] = offsets[1:], breaks
        text = np.repeat(np.arange(n_texts), per_text)

        t_start, t_end = runs(~blanks(data), offsets)
        plain = segment_hash(data, t_start, t_end)
        digits = np.concatenate(([0], np.cumsum((data >= 0x30) & (data <= 0x39))))
        variable = digits[t_end] > digits[t_start]
        masked = np.where(variable, np.uint64(1), plain)
        t_text = np.searchsorted(offsets, t_start, "right") - 1
        line = t_text + np.searchsorted(breaks, t_start)
        n = np.bincount(line, minlength=n_lines)
        bounds = np.concatenate(([0], np.cumsum(n)))
        stay = n - np.bincount(line[variable], minlength=n_lines)
        of_text = np.concatenate(([0], np.cumsum(np.bincount(t_text, minlength=n_texts))))
        content = _in_order(plain, of_text, 0x9FB21C651E98DF25)
        whole = (n >= min_tokens) & (stay >= n * constant)
        base = 0xD1B54A32D192ED03
        hashed = np.where(whole, _in_order(masked, bounds, base), _in_order(plain, bounds, base))
        padded = np.concatenate((masked, np.zeros(DEPTH, np.uint64)))
        leaf = n.astype(np.uint64)
        for depth in range(DEPTH):
            token = np.where(n > depth, padded[bounds[:-1] + depth], np.uint64(0))
            leaf = mix(leaf * np.uint64(0x9E3779B97F4A7C15) + token)

        ascii_word = ALNUM.copy()
        ascii_word[0x80:], ascii_word[0x41:0x5B] = False, True
        words = np.concatenate(([0], np.cumsum(ascii_word[data])))
        keep = words[end] > words[start]
        for i in np.flatnonzero(~keep & (n > 0)).tolist():
            keep[i] = ANY_WORD.search(data[start[i] : end[i]].tobytes().decode()) is not None
        kept = pa.array(keep)
        columns = {
            "row_key": keys.take(pa.array(text)),
            "content": signed(content[text]),
            "all": pa.array(np.diff(offsets)[text]),
            "pos": pa.array((np.arange(n_lines) - first[text]).astype(np.int32)),
            "n": pa.array(n.astype(np.int32)),
            "size": pa.array((end - start).astype(np.int32)),
            "leaf": pa.array(leaf.view(np.int64), mask=n < min_tokens),
            "line": signed(hashed),
        }
        if raw:
            lengths = pa.py_buffer(np.append(start, len(data)).astype(np.int32).tobytes())
            columns["raw"] = pa.StringArray.from_buffers(n_lines, lengths, pa.py_buffer(data.tobytes()))
        return pa.RecordBatch.from_arrays([c.filter(kept) for c in columns.values()], list(columns))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                yield of_chunk(chunk, batch.column("row_key").slice(chunk.first, chunk.last - chunk.first))

    return rows


def _lines(docs: DataFrame, min_tokens: int, constant: float, raw: bool = False) -> DataFrame:
    """(row_key, content, all, pos, n, size, leaf, line) of every line with a letter or digit.

    content is the hash of the tokens of the whole text, all its bytes; line that of the masked tokens, or of the
    tokens as they are if too few stay; leaf is null for lines that no template is made of. raw: the line too.
    """
    schema = "row_key long, content long, all long, pos int, n int, size int, leaf long, line long"
    schema += ", raw string" if raw else ""
    return docs.mapInArrow(_parsed(min_tokens, constant, raw), schema)


def _small(df: DataFrame) -> DataFrame:
    """The set, computed once; broadcast if it is small enough."""
    df = checkpointed(df)
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _recurring_leaves(seen: DataFrame, min_docs: int) -> DataFrame:
    once = seen.where(F.col("leaf").isNotNull()).groupBy("leaf", "content").agg(F.lit(1).alias("one"))
    return once.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("leaf")


def long_lines(seen: DataFrame, shared: DataFrame, min_docs: int, long_docs: int) -> DataFrame:
    """(line) of the long lines of `long_docs` to `min_docs` texts of which enough have a part of their own.

    seen: (content, line, size) once each; shared: (line, n, size, n_docs) of the lines of two or more texts.
    """
    is_long = (F.col("n") >= LONG_TOKENS) | (F.col("size") >= LONG_BYTES)
    likely = shared.where(is_long & F.col("n_docs").between(long_docs, min_docs - 1)).select("line")
    bearing = checkpointed(seen.select("content", "line").join(likely, "line"))
    texts = seen.join(bearing.select("content").distinct(), "content")
    own = F.when(F.col("n_docs").isNull(), F.col("size")).otherwise(0)
    texts = texts.join(shared.select("line", "n_docs"), "line", "left").groupBy("content").agg(
        F.sum(own).alias("own"), F.sum("size").alias("all")
    )
    counted = bearing.join(texts.where(F.col("own") >= F.col("all") * OWN), "content")
    return counted.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= long_docs).select("line")


def recurring_lines(distinct: DataFrame, min_docs: int, constant: float) -> DataFrame:
    """(line, leaf, template, in_docs) of the lines whose template recurs.

    distinct: (leaf, line, n_docs, tokens) of recurring leaves; line is the hash of the masked tokens.
    """
    votes = (
        distinct.select("leaf", "n_docs", F.posexplode("tokens").alias("i", "token"))
        .groupBy("leaf", "i", "token")
        .agg(F.sum("n_docs").alias("votes"))
        .where((F.col("votes") >= min_docs) & (F.col("token") != VARIABLE))
    )
    placed = distinct.select("leaf", "line", "n_docs", F.size("tokens").alias("n"), F.posexplode("tokens").alias("i", "token"))
    kept = placed.join(votes.select("leaf", "i", "token", F.lit(True).alias("stays")), ["leaf", "i", "token"], "left")
    templates = kept.groupBy("leaf", "line").agg(
        F.first("n").alias("n"),
        F.first("n_docs").alias("n_docs"),
        F.count("stays").alias("n_constant"),
        F.array_sort(F.collect_list(F.struct("i", F.when(F.col("stays"), F.col("token")).otherwise(VARIABLE).alias("t")))).alias("ts"),
    )
    templates = templates.where(F.col("n_constant") >= F.col("n") * constant).select(
        "leaf", "line", "n_docs", F.array_join(F.col("ts.t"), " ").alias("template")
    )
    shared = templates.groupBy("leaf", "template").agg(F.sum("n_docs").alias("in_docs")).where(F.col("in_docs") >= min_docs)
    return templates.join(shared, ["leaf", "template"]).select("leaf", "line", "template", "in_docs")


def drop_recurring(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    min_docs: int = 10,
    min_tokens: int = 3,
    constant: float = 0.5,
    long_docs: int = 3,
    copy_share: float = 0.9,
) -> DataFrame:
    """One row per document: doc_id, the kept columns, text without boilerplate lines, n_lines, n_dropped."""
    docs = df.select(
        F.monotonically_increasing_id().alias("row_key"),
        df[id_col].alias("doc_id"),
        *(df[c].alias(f"keep_{c}") for c in keep),
        df[text_col].alias("text"),
    )
    texts = docs.select("row_key", "text")
    # parsed once for all lines' hashes, and once more for the lines of recurring leaves themselves
    lines = stored(_lines(texts, min_tokens, constant))
    seen = lines.groupBy("line", "content").agg(F.first("leaf").alias("leaf"), F.first("n").alias("n"), F.first("size").alias("size"))
    seen = checkpointed(seen)
    counts = seen.groupBy("line").agg(
        F.first("leaf").alias("leaf"), F.first("n").alias("n"), F.max("size").alias("size"), F.count("*").alias("n_docs")
    )
    shared = checkpointed(counts.where(F.col("n_docs") >= 2))
    leaves = _small(_recurring_leaves(seen, min_docs))
    tokens = _lines(texts, min_tokens, constant, raw=True).join(leaves, "leaf").groupBy("line").agg(F.first("raw").alias("raw"))
    tokens = tokens.select("line", _masked(_tokens(F.col("raw"))).alias("tokens"))
    distinct = checkpointed(counts.join(leaves, "leaf").select("leaf", "line", "n_docs").join(tokens, "line"))
    equal = shared.where(F.col("n_docs") >= min_docs).select("line")
    few = long_lines(seen, shared, min_docs, long_docs)
    found = _small(equal.union(few).union(recurring_lines(distinct, min_docs, constant).select("line")).distinct())
    drops = lines.select("row_key", "all", "pos", "size", "line").join(found, "line").groupBy("row_key").agg(
        F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("places"),
        (F.sum("size") >= F.first("all") * copy_share).alias("likely"),
    )
    drops = checkpointed(
        drops.select("row_key", "likely", F.col("places.pos").alias("drop"), F.xxhash64("places.line").alias("sequence"))
    )
    twins = drops.where("likely").groupBy("sequence").agg(F.count("*").alias("n")).where(F.col("n") >= 2)
    twins = _small(twins.select("sequence", F.lit(True).alias("likely"), F.lit(True).alias("copy")))
    drops = drops.join(twins, ["sequence", "likely"], "left").select("row_key", "drop", "copy")
    parts = F.split("text", "\n")
    rest = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col("drop"), i)), "\n")
    cleaned = docs.join(drops, "row_key", "left").withColumn("rest", rest)
    is_bearer = F.col("copy").isNull() & F.col("rest").rlike(WORD) & F.col("drop").isNotNull()
    cleaned = cleaned.withColumn("bearer", F.coalesce(is_bearer, F.lit(False)))
    return cleaned.select(
        "doc_id",
        *(F.col(f"keep_{c}").alias(c) for c in keep),
        F.when(F.col("bearer"), F.col("rest")).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("bearer"), F.size("drop")).otherwise(F.lit(0)).cast("long").alias("n_dropped"),
    )

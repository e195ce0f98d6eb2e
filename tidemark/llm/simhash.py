"""Near-duplicate documents by SimHash: pigeonhole blocks, verified by Hamming distance.

A fingerprint has 64 bits; each is the majority of that bit in the hashes of a text's word shingles.
Equal fingerprints are one. The bits are split into six blocks. Two fingerprints that differ in at
most three bits agree in at least three blocks, so each fingerprint goes to the 20 buckets of its
choices of three blocks, some 32 bits each, and only those that meet in a bucket are compared.

A bucket of more than `LIMIT` fingerprints is split again by the same principle: the bits that its
members need not share are cut into four pieces, of which a close pair agrees in one at least. As
fingerprints are distinct, a bucket that shares all but b bits has at most 2^b, so after a few splits every
bucket is small enough. Its members are compared in one task, and only a forest is returned that
joins what is linked there, never all its pairs. Classes are the connected components of the links.

Defined results: a text without a word (null, empty) has fingerprint zero, which is linked like any
other; a text of fewer words than a shingle is one shingle; equal rows each get a row; rows without
an id get the class of their fingerprint, whose id is null only if no member has one; an empty table
gives an empty result. Other columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components, stored

SHINGLE, SEED, BITS = 3, 42, 64
#: Fingerprints are linked at so many differing bits or fewer.
DISTANCE = 3
#: Blocks of the first split; a bucket shares BLOCKS - DISTANCE of them.
BLOCKS = 6
#: Larger buckets are split further.
LIMIT = 512
#: Shingles counted at once.
COUNTED = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text, as an unsigned number."""
    words = (text or "").encode().lower().split()  # bytes: A-Z alone, and splits at 09-0D and 20
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        return xxhash.xxh64_intdigest(line, SEED)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
    ends = (starts[shingle:] - 1).tolist()
    hashed = xxhash.xxh64_intdigest
    count = np.zeros(BITS, np.int64)
    for low in range(0, n, COUNTED):
        high = min(n, low + COUNTED)
        values = [hashed(line[s:e], SEED) for s, e in zip(starts[low:high].tolist(), ends[low:high], strict=True)]
        bits = np.unpackbits(np.array(values, "<u8").view(np.uint8), bitorder="little")
        count += bits.reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * count > n).tolist()))


def _fingerprints(shingle: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            column = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column], ["doc_id", "fp"])

    return rows


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def pieces(mask: int, n: int) -> list[int]:
    """The bits of a mask in n runs of about equal size."""
    bits = [b for b in range(BITS) if mask >> b & 1]
    edges = [len(bits) * i // n for i in range(n + 1)]
    return [sum(1 << b for b in bits[s:e]) for s, e in zip(edges, edges[1:])]


def first_masks(distance: int = DISTANCE, blocks: int = BLOCKS) -> list[int]:
    """The bits shared in each bucket of the first split."""
    return [sum(c) for c in combinations(pieces((1 << BITS) - 1, blocks), blocks - distance)]


def next_masks(mask: int, distance: int = DISTANCE) -> list[int]:
    """The bits shared in the buckets that a bucket is split into: one more piece of the rest."""
    return [mask | piece for piece in pieces(~mask & ((1 << BITS) - 1), distance + 1)]


def _spread(fingerprints: DataFrame, masks: Column) -> DataFrame:
    """(mask, shared, fp): each fingerprint in the buckets of its masks."""
    return fingerprints.select("fp", F.explode(masks).alias("mask")).select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("shared"), "fp"
    )


def _forest(distance: int):
    """(a, b): for each bucket, links that join all that its links join."""

    def joined(fps: np.ndarray) -> list[tuple[int, int]]:
        left, out = fps, []
        while len(left):
            # grow one class from the first fingerprint that has none yet
            front, left = left[:1], left[1:]
            while len(front) and len(left):
                x, front = front[0], front[1:]
                near = np.bitwise_count(left ^ x) <= distance
                out += [(x, y) for y in left[near]]
                front, left = np.concatenate((front, left[near])), left[~near]
        return out

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("fps")
            links = [pair for i in range(len(lists)) for pair in joined(np.array(lists[i].values, np.int64).view(np.uint64))]
            both = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    return rows


def linked(fingerprints: DataFrame, distance: int = DISTANCE, limit: int = LIMIT) -> DataFrame:
    """(a, b): links among distinct fingerprints `fp`, enough to join all that are at most `distance` apart."""
    # a bucket that shares all but `distance` bits has no more, all linked, and cannot be split
    limit = max(limit, 1 << distance)
    masks = first_masks(distance, distance + 3)
    found = []
    rows = _spread(fingerprints.select("fp"), F.array(*(F.lit(signed(m)).cast("long") for m in masks)))
    while True:
        sizes = rows.groupBy("mask", "shared").agg(
            F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
        )
        sizes = stored(sizes.where("n > 1"))
        differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
        found.append(sizes.where((F.col("n") == 2) & (differ <= distance)).select("a", "b"))
        some = sizes.where((F.col("n") > 2) & (F.col("n") <= limit)).select("mask", "shared")
        buckets = rows.join(some, ["mask", "shared"], "left_semi").groupBy("mask", "shared")
        lists = buckets.agg(F.collect_list("fp").alias("fps")).select("fps")
        found.append(lists.mapInArrow(_forest(distance), "a long, b long"))
        hot = sizes.where(F.col("n") > limit).select("mask", "shared")
        if hot.isEmpty():
            break
        # written, so that the next split does not start from the texts again
        rows = stored(rows.join(hot, ["mask", "shared"], "left_semi"))
        # one row for each choice of blocks, however many fingerprints there are: 20, 80, 320, ...
        steps = [(signed(m), [signed(x) for x in next_masks(m, distance)]) for m in masks]
        masks = sorted({x for m in masks for x in next_masks(m, distance)})
        table = rows.sparkSession.createDataFrame(steps, "mask long, next array<long>")
        rows = rows.join(F.broadcast(table), "mask").select("fp", "next")
        rows = _spread(rows, F.col("next")).distinct()
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return stored(links.distinct())


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    distance: int = DISTANCE,
    shingle: int = SHINGLE,
    limit: int = LIMIT,
) -> DataFrame:
    """One row per document: doc_id, fp (the fingerprint as a signed number), component_id.

    component_id: the smallest id of all documents that links reach, itself included.
    limit: fingerprints of a bucket that are compared in one task.
    """
    docs = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    placed = stored(docs.mapInArrow(_fingerprints(shingle), f"doc_id {kind}, fp long"))
    distinct = stored(placed.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(linked(distinct, distance, limit))
    least = distinct.join(roots, F.col("fp") == F.col("node"), "left")
    least = stored(least.select("fp", "least", F.coalesce("root", "fp").alias("root")))
    classes = stored(least.groupBy("root").agg(F.min("least").alias("component_id")))
    # written, so that a fingerprint or class of very many rows can be split in the joins
    label = stored(least.select("fp", "root").join(classes, "root").select("fp", "component_id"))
    return placed.join(label, "fp").select("doc_id", "fp", "component_id")


def digest(found: DataFrame) -> DataFrame:
    """The fingerprint as 16 hex digits."""
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")

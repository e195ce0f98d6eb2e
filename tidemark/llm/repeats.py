"""Suffix-array deduplication: maximal repeats from the intervals of common prefixes.

A byte is removed if a string of `span` bytes that covers it also starts anywhere else, in the same
text or another. Equal strings of that length have their smallest hashed gram (anchor) at the same
place, so they can only meet at anchors of equal hash. Each text is cut into the runs of string
starts that share an anchor; the bytes of a run's strings are its context.

1. Contexts that are equal as a whole are counted, by the 64-bit hashes of the anchor and of the
   whole. All their strings are repeats. Only one context of each kind goes on, so groups of copies are one row.
2. Contexts that differ but have an anchor in common are brought together, some megabytes at a
   time. The suffixes that start a string are sorted by their first `span` bytes (prefix doubling);
   suffixes with that much in common are sorted on, and a stack scan over the lengths of common
   prefixes yields the intervals. An interval whose occurrences are preceded by different bytes is
   a maximal repeat: it is reported with all its occurrences. Others are part of a longer repeat.
3. An anchor with more than `hot` different contexts is not gathered: the hash of each of its
   strings is a row, counted by a shuffle. This is exact as well, whatever the size of the group.

Defined results: null text is empty; texts shorter than `span` lose nothing; equal texts of that
length lose everything, in each copy; equal rows count as texts of their own; an empty table gives
an empty result; of other columns only those in `keep` are returned. Lengths are bytes of UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import stored
from tidemark.llm.decontam import union_of
from tidemark.llm.words import CHUNK_BYTES, Chunk, chunks, keyed, mix, powers, signed

SPAN, GRAM = 400, 32
#: Different contexts of one anchor that are sorted together, at most; about 600 bytes each, so some 2.5 MB.
HOT = 4000
#: Bytes of contexts that are sorted at once, but for the rest of one anchor's contexts.
SORT_BYTES = 1 << 20

_CODES = [mix(np.arange(256, dtype=np.uint64) + np.uint64(s << 8)) for s in (1, 2)]
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_PLACE = np.uint64((1 << 28) - 1)


class Rolling:
    """Hashes of any byte range of a chunk."""

    def __init__(self, data: np.ndarray, which: int) -> None:
        base = _BASES[which]
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODES[which][data] * powers(len(data), base), out=self.prefix[1:])
        self.inverse = powers(len(data) + 1, pow(base, -1, 1 << 64))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.inverse[start])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` neighbours, from running minima of blocks in both directions."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, values.dtype)
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(chunk: Chunk, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, context hash, first and last string start).

    Places are bytes within the text.
    """
    data, offsets = chunk.data, chunk.offsets
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    lengths = np.diff(offsets)
    counts = np.maximum(0, lengths - span + 1)
    if not counts.sum():
        return none
    rolling = Rolling(data, 0)
    at = np.arange(len(data) - gram + 1)
    hashes = rolling.of(at, at + gram)
    ranked = (hashes & ~_PLACE) | at.astype(np.uint64)
    least = sliding_least(ranked, span - gram + 1)
    text = np.repeat(np.arange(len(lengths)), counts)
    begun = np.concatenate(([0], np.cumsum(counts)))
    start = np.arange(begun[-1]) - begun[text] + offsets[text]
    place = (least[start] & _PLACE).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    low = np.flatnonzero(new)
    high = np.concatenate((low[1:], [len(start)])) - 1
    text, lo, hi, place = text[low], start[low], start[high], place[low]
    shape = mix((place - lo).astype(np.uint64) + (hi - lo).astype(np.uint64) * np.uint64(1 << 20))
    whole = mix(rolling.of(lo, hi + span) + shape)
    base = offsets[text]
    return text, hashes[place], whole, lo - base, hi - base


def _anchored(span: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("row_key").to_numpy()
            for chunk in chunks(batch.column("text"), CHUNK_BYTES // 2):
                text, h, c, lo, hi = anchors(chunk, span, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[chunk.first + text]), signed(h), signed(c),
                     pa.array(lo.astype(np.int64)), pa.array(hi.astype(np.int64))],
                    ["row_key", "h", "c", "lo", "hi"],
                )

    return rows


def _contexts(span: int):
    """(h, n, row_key, lo, hi, bytes) of each wanted context of a text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            size = 0
            for key, text, wanted in zip(
                batch.column("row_key").to_pylist(), batch.column("text"), batch.column("wanted"), strict=True
            ):
                data = text.as_py().encode()
                for w in wanted.as_py():
                    piece = data[w["lo"] : w["hi"] + span]
                    size += len(piece)
                    for column, v in zip(out, (w["h"], w["n"], key, w["lo"], w["hi"], piece), strict=True):
                        column.append(v)
                if size > 4 << 20:
                    yield _context_batch(out)
                    out, size = [[], [], [], [], [], []], 0
            yield _context_batch(out)

    return rows


def _context_batch(columns: list[list]) -> pa.RecordBatch:
    arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["h", "n", "row_key", "lo", "hi", "bytes"])


def suffix_ranks(text: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
    """Ranks of the first `span` bytes from each start: equal strings have equal ranks, in order of the bytes."""
    padded = np.concatenate((text, np.zeros(span + 8, np.uint8))).astype(np.uint64)
    n = len(text)
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = (key << np.uint64(8)) | padded[j : j + n]
    have, rank = 8, np.unique(key, return_inverse=True)[1].astype(np.int64)
    while have < span:
        step = min(have, span - have)
        where = starts if have + step >= span else np.arange(n)
        after = np.concatenate((rank, np.full(span, -1, np.int64)))[where + step] + 1
        rank = np.unique(rank[where] * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        have += step
    return rank if have > 8 else rank[starts]


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings, of which `known` bytes are equal."""
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8, n)[known:], np.frombuffer(b, np.uint8, n)[known:]
    differ = np.flatnonzero(x != y)
    return known + int(differ[0]) if len(differ) else n


def prefix_intervals(lengths: list[int], least: int) -> list[tuple[int, int, int]]:
    """(first, last, length) of the intervals of suffixes that have `length` >= `least` bytes in common.

    lengths[i]: common prefix of sorted suffixes i and i + 1. Each interval is as wide as its length allows.
    """
    out, stack = [], []
    for i, n in enumerate([*lengths, -1]):
        begin = i
        while stack and stack[-1][0] > n:
            size, begin = stack.pop()
            if size >= least:
                out.append((begin, i, size))
        if n >= 0 and (not stack or stack[-1][0] < n):
            stack.append((n, begin))
    return out


def maximal_repeats(contexts: list[bytes], counts: list[int], span: int) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of maximal repeats within contexts; an occurrence is (context, start, length).

    counts: for each context the strings that start in its first bytes.
    """
    text = np.frombuffer(b"".join(contexts), np.uint8)
    begin = np.concatenate(([0], np.cumsum([len(c) for c in contexts])))
    number = np.array(counts)
    context = np.repeat(np.arange(len(contexts)), number)
    within = np.arange(len(context)) - np.repeat(np.concatenate(([0], np.cumsum(number)))[:-1], number)
    starts = begin[context] + within
    rank = suffix_ranks(text, starts, span)
    order = np.argsort(rank, kind="stable")
    cut = np.flatnonzero(np.diff(rank[order])) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(order)]))
    # byte before each suffix; the first of a context has none, which counts as different from all
    before = np.where(within > 0, text[np.maximum(starts - 1, 0)].astype(np.int64), -1)[order]
    if not len(order):
        return
    low, high = np.minimum.reduceat(before, first), np.maximum.reduceat(before, first)
    chosen = np.flatnonzero((last - first > 1) & ((low < 0) | (low < high)))
    for g in chosen.tolist():
        members = order[first[g] : last[g]]
        strings = [contexts[context[m]][within[m] :] for m in members]
        left = before[first[g] : last[g]].tolist()
        by = sorted(range(len(members)), key=strings.__getitem__)
        shared = [common_prefix(strings[a], strings[b], span) for a, b in zip(by, by[1:], strict=False)]
        for i, j, size in prefix_intervals(shared, span):
            inside = by[i : j + 1]
            seen = {left[x] for x in inside}
            if len(seen) > 1 or -1 in seen:
                yield [(int(context[members[x]]), int(within[members[x]]), size) for x in inside]


def _sorted_spans(span: int):
    """(group, row_key, s, e): occurrences of maximal repeats in contexts that occur once, anchor by anchor."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, group = 0, 0

        def solve() -> pa.RecordBatch:
            nonlocal group
            found: dict[tuple[int, int], tuple[int, int]] = {}
            for members in maximal_repeats([x[5] for x in held], [x[4] - x[3] + 1 for x in held], span):
                group += 1
                for i, start, length in members:
                    if held[i][1] == 1 and length > found.get((i, start), (0, 0))[0]:
                        found[i, start] = (length, group)
            columns = [[g, held[i][2], held[i][3] + s, held[i][3] + s + n] for (i, s), (n, g) in found.items()]
            arrays = [pa.array([c[k] for c in columns], pa.int64()) for k in range(4)]
            return pa.RecordBatch.from_arrays(arrays, ["group", "row_key", "s", "e"])

        for batch in batches:
            lists = [batch.column(c).to_pylist() for c in ("h", "n", "row_key", "lo", "hi", "bytes")]
            for row in zip(*lists, strict=True):
                if size > SORT_BYTES and row[0] != held[-1][0]:
                    yield solve()
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield solve()

    return rows


def _string_hashes(span: int):
    """(h, w, n, row_key, s): the hash of each string of a context."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, n, key, lo, hi, data in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                at = np.arange(hi - lo + 1)
                w = Rolling(np.frombuffer(data, np.uint8), 1).of(at, at + span)
                full = lambda v: pa.array(np.full(len(at), v, np.int64))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [full(h), signed(w), full(n), full(key), pa.array(at + lo)], ["h", "w", "n", "row_key", "s"]
                )

    return rows


_CONTEXT = "h long, n long, row_key long, lo long, hi long, bytes binary"


def repeated_spans(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(row_key, s, e) of byte ranges of repeats; docs: (row_key, text). Ranges of a text may overlap."""
    schema = "row_key long, h long, c long, lo long, hi long"
    found = stored(docs.select("row_key", "text").mapInArrow(_anchored(span, gram), schema))
    kinds = stored(
        found.groupBy("h", "c").agg(
            F.count("*").alias("n"), F.min(F.struct("row_key", "lo", "hi")).alias("place")
        )
    )
    whole = found.join(kinds.where("n > 1").select("h", "c"), ["h", "c"]).select(
        "row_key", F.col("lo").alias("s"), (F.col("hi") + span).alias("e")
    )
    shared = kinds.groupBy("h").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    shared = shared.where("kinds > 1 and least = 1").select("h", "kinds")
    wanted = kinds.join(shared, "h").select("h", "n", "kinds", "place.*")

    def contexts(part: DataFrame) -> DataFrame:
        lists = part.groupBy("row_key").agg(F.collect_list(F.struct("h", "n", "lo", "hi")).alias("wanted"))
        loaded = docs.select("row_key", "text").join(lists, "row_key")
        return loaded.mapInArrow(_contexts(span), _CONTEXT)

    usual = contexts(wanted.where(F.col("kinds") <= hot)).repartition("h").sortWithinPartitions("h")
    sorted_spans = usual.mapInArrow(_sorted_spans(span), "group long, row_key long, s long, e long")
    strings = contexts(wanted.where(F.col("kinds") > hot)).mapInArrow(
        _string_hashes(span), "h long, w long, n long, row_key long, s long"
    )
    twice = strings.groupBy("h", "w").agg(F.count("*").alias("times")).where("times > 1").select("h", "w")
    counted = strings.where("n = 1").join(twice, ["h", "w"]).select("row_key", "s", (F.col("s") + span).alias("e"))
    return whole.union(sorted_spans.select("row_key", "s", "e")).union(counted)


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    span: int = SPAN,
    gram: int = GRAM,
    hot: int = HOT,
) -> DataFrame:
    """One row per text: doc_id, kept columns, n_bytes, spans (removed, disjoint) and `rest`, the other bytes."""
    if not 8 <= gram <= span:
        raise ValueError("gram must be from 8 to span")
    docs = keyed(df, id_col, text_col)
    ranges = repeated_spans(docs, span, gram, hot)
    kind = "array<struct<s:bigint,e:bigint>>"
    spans = ranges.groupBy("row_key").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("spans"))
    spans = spans.select("row_key", union_of("spans").alias("spans"))
    joined = docs.join(spans, "row_key", "left").select(
        "row_key",
        "doc_id",
        F.encode("text", "UTF-8").alias("data"),
        F.coalesce("spans", F.array().cast(kind)).alias("spans"),
    )
    # what lies between the removed ranges
    ends = F.concat(F.array(F.lit(0).cast("long")), F.col("spans.e"))
    starts = F.concat(F.col("spans.s"), F.array(F.length("data").cast("long")))
    pieces = F.zip_with(
        ends, starts, lambda e, s: F.substring(F.col("data"), (e + 1).cast("int"), (s - e).cast("int"))
    )
    rest = F.when(F.size("spans") > 0, F.aggregate(pieces, F.unhex(F.lit("")), lambda a, p: F.concat(a, p)))
    result = joined.select(
        "row_key", "doc_id", F.length("data").cast("long").alias("n_bytes"), "spans", F.coalesce(rest, "data").alias("rest")
    )
    if keep:
        others = df.select(F.monotonically_increasing_id().alias("row_key"), *(df[c].alias(f"keep_{c}") for c in keep))
        result = result.join(others, "row_key")
    return result.select(
        "doc_id", *(F.col(f"keep_{c}").alias(c) for c in keep), "n_bytes", "spans", "rest"
    )


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("rest")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("rest", 256).alias("kept_sha256"),
    )

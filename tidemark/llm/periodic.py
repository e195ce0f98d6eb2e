"""Periodic runs of words by a dictionary of basic factors.

For each power of two, the factors of so many words get numbers, equal ones the same: those of 2k
words from the numbers of their two halves. A factor that its text holds once needs no number, nor
does any longer one around it, so in prose few are left beyond the shortest.

Where a factor of 2^k words is followed by itself p words later, p at most 2^k, its text has period
p there, and successors p apart at neighbouring places form a progression that proposes a run from
its first place to the end of its last factor. Each period is looked for at the one length with
p <= 2^k < 2p: four periods hold a progression of it, and a smaller period would show in a nearer
successor, so the smallest is found, and once. Proposals of four periods or more are extended as long
as the words on both sides keep the period, and equal ones become one.

Texts may be rewritten first (`rewrite`), so that known runs can be planted.

Defined results: a null text is empty, and has no words and no runs; the columns of the longest run
are null then. A row without an id is not rewritten. Equal rows, ids included, each get their row;
ties of the exponent go to the smallest start, then period; an empty table gives an empty result.
Other columns, whatever their names, are left out. A task holds one chunk of texts at once, or one
text that is longer.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of texts handled at once; a longer text is handled by itself.
CHUNK_WORDS = 1 << 18
#: A run has this many words at least, and this many times its period.
MIN_WORDS, MIN_PERIODS = 6, 4


class Runs(NamedTuple):
    """Runs by text, start and period; starts are places in the joined words."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document (by the CRC of its id), periodic from some word on."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def successors(names: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, ranks, next place or -1) of those places whose name another place has too.

    names: a number for each of the ascending places `at`.
    """
    order = np.argsort(names, kind="stable")
    same = names[order][1:] == names[order][:-1]
    follows = np.full(len(at), -1, np.int64)
    follows[:-1][same] = at[order][1:][same]
    twin = follows >= 0
    twin[1:] |= same
    rank, after, shared = np.empty(len(at), np.int64), np.empty(len(at), np.int64), np.empty(len(at), bool)
    rank[order] = np.concatenate(([0], np.cumsum(~same)))[: len(at)]
    after[order], shared[order] = follows, twin
    return at[shared], rank[shared], after[shared]


def extended(names: np.ndarray, bounds: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray):
    """Proposals grown on both sides, a word at a time, as long as the period holds within the text."""
    text = np.searchsorted(bounds, start, "right") - 1
    low, high = bounds[text], bounds[text + 1]
    start, end = start.copy(), end.copy()
    for side in (start, end):
        open_ = np.arange(len(start))
        while len(open_):
            s, p = side[open_], period[open_]
            if side is start:
                ok = s > low[open_]
                ok[ok] = names[s[ok] - 1] == names[s[ok] - 1 + p[ok]]
            else:
                ok = s < high[open_]
                ok[ok] = names[s[ok]] == names[s[ok] - p[ok]]
            open_ = open_[ok]
            side[open_] += -1 if side is start else 1
    return start, end


def find_runs(names: np.ndarray, bounds: np.ndarray) -> Runs:
    """All runs of texts whose words are numbered; text i has words bounds[i]:bounds[i + 1], and no
    number is shared between texts."""
    longest = int(np.diff(bounds).max(initial=0))
    at, rank, after = successors(names, np.arange(len(names)))
    found, k = [], 0
    while len(at):
        size = 1 << k
        gap = after - at
        linked = (after >= 0) & (gap <= size) & (2 * gap > size)
        places, gaps = at[linked], gap[linked]
        if len(places):
            # a progression: neighbouring places whose successors are equally far
            new = np.ones(len(places), bool)
            new[1:] = (np.diff(places) != 1) | (np.diff(gaps) != 0)
            first = np.flatnonzero(new)
            last = np.concatenate((first[1:], [len(places)])) - 1
            start, end, period = places[first], places[last] + gaps[first] + size, gaps[first]
            long = end - start >= np.maximum(MIN_WORDS, MIN_PERIODS * period)
            found.append((start[long], end[long], period[long]))
        if MIN_PERIODS * size > longest:  # longer periods do not fit four times
            break
        # factors of twice the length, both halves of which are shared
        rank_of = np.full(len(names) + size, -1, np.int64)
        rank_of[at] = rank
        second = rank_of[at + size]
        both = second >= 0
        at, rank, after = successors(rank[both] * len(names) + second[both], at[both])
        k += 1
    if not found:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none)
    start, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    start, end = extended(names, bounds, start, end, period)
    each = np.unique(np.stack((start, period, end - start), 1), axis=0)
    return Runs(each[:, 0], each[:, 2], each[:, 1])


def best(start: list[int], length: list[int], period: list[int]) -> int:
    """Number of the run with the greatest length / period, exactly; runs are by start, then period."""
    top = 0
    for i in range(1, len(start)):
        if length[i] * period[top] > length[top] * period[i]:
            top = i
    return top


def _chunks(ids: list, texts: list, rewrite) -> Iterator[tuple[list[list[bytes]], np.ndarray, np.ndarray]]:
    """(words of each text, names of all words, bounds) of some texts at a time."""
    held: list[list[bytes]] = []
    names: list[np.ndarray] = []
    bounds, named = [0], 0
    for doc_id, text in zip(ids, texts, strict=True):
        words = (text or "").encode().split()  # at exactly the bytes 09-0D and 20
        if rewrite:
            words = rewrite(doc_id, words)
        if held and bounds[-1] + len(words) > CHUNK_WORDS:
            yield held, np.concatenate(names), np.array(bounds)
            held, names, bounds, named = [], [], [0], 0
        number: dict[bytes, int] = {}
        own = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        held.append(words)
        names.append(own + named)
        bounds.append(bounds[-1] + len(words))
        named += len(number)
    if held:
        yield held, np.concatenate(names), np.array(bounds)


def _scanned(rewrite):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, done = batch.column("doc_id"), 0
            for held, names, bounds in _chunks(ids.to_pylist(), batch.column("text").to_pylist(), rewrite):
                yield _described(ids.slice(done, len(held)), held, names, bounds)
                done += len(held)

    return rows


def _described(ids: pa.Array, held: list[list[bytes]], names: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    runs = find_runs(names, bounds)
    edges = np.searchsorted(runs.start, bounds)
    # words after the first period of any run go
    change = np.zeros(len(names) + 1, np.int64)
    np.add.at(change, runs.start + runs.period, 1)
    np.add.at(change, runs.start + runs.length, -1)
    kept = np.cumsum(change[:-1]) == 0
    columns: dict[str, list] = {name: [] for name in SCHEMA}
    for i, words in enumerate(held):
        low, high = bounds[i], bounds[i + 1]
        some = slice(edges[i], edges[i + 1])
        start, length, period = ((runs.start[some] - low).tolist(), runs.length[some].tolist(), runs.period[some].tolist())
        top = best(start, length, period) if start else None
        if start:
            words = [w for w, k in zip(words, kept[low:high].tolist(), strict=True) if k]
        columns["n_words"].append(int(high - low))
        columns["n_kept"].append(len(words))
        columns["n_runs"].append(len(start))
        columns["start"].append(None if top is None else start[top])
        columns["length"].append(None if top is None else length[top])
        columns["period"].append(None if top is None else period[top])
        columns["exponent_milli"].append(None if top is None else 1000 * length[top] // period[top])
        columns["runs"].append(
            [{"start": s, "length": n, "period": p} for s, n, p in zip(start, length, period, strict=True)]
        )
        columns["collapsed"].append(b" ".join(words).decode())
    arrays = [pa.array(columns[name], kind) for name, kind in SCHEMA.items()]
    return pa.RecordBatch.from_arrays([ids, *arrays], ["doc_id", *SCHEMA])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = {
    **dict.fromkeys(("n_words", "n_kept", "n_runs", "start", "length", "period", "exponent_milli"), pa.int64()),
    "runs": pa.list_(_RUN),
    "collapsed": pa.string(),
}


def periodic_runs(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """One row per document: its runs, the one of the greatest exponent, and the text without repetitions.

    start, length and period count words `[^\\x20\\x09-\\x0D]+`. collapsed: the words left when of each run
    only the first period is kept, with single spaces between. rewrite: changes the words of a document
    before, given its id.
    """
    docs = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_words long, n_kept long, n_runs long, start long, length long, period long,"
        " exponent_milli long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
    return docs.mapInArrow(_scanned(rewrite), schema)


def digest(found: DataFrame) -> DataFrame:
    """Runs and collapsed text as SHA-256."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    runs = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        "doc_id", "n_words", "n_kept", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(runs, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

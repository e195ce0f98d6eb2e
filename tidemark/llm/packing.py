"""Packing of tokenised texts into training sequences: vector bin packing by dot product.

A sequence has three capacities: tokens, segments (texts or parts of them) and loss-bearing
tokens. Each task packs the texts of its own partition, so nothing is shuffled: it keeps a pool
of waiting pieces and, for the open sequence, takes the piece that fits whole and whose demands,
weighted by how scarce each resource is in the pool, have the largest dot product with what the
sequence has left. If none fits whole, a waiting piece is cut to the space that is left; a gap of
fewer than `min_piece` tokens is left as padding. What remains at the end of a partition goes
into sequences whose lengths are powers of two, which need no padding.

Defined results: null text is empty and holds only the end token; equal rows are packed each;
an empty table gives no piece; a text of any length is cut; columns other than the named ones
are left out.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = "doc_id {id}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_ROWS = 2000
#: Runs of white space (of the pattern's kind) so long that matching them would exhaust the pattern's stack.
_BLANKS = re.compile(r"[\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
#: Patterns that split every text alike with less backtracking, as the faster library spells them.
_FASTER = {
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""":
    r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
}


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str, specials: tuple[tuple[str, int], ...]) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    pattern = _FASTER.get(pattern, pattern)
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=table, special_tokens=dict(specials))


@dataclass(frozen=True)
class Vocabulary:
    """A byte-pair vocabulary as ranks, read once on the driver; its size is fixed. `end` closes each text.

    The strings of `specials` in a text become their ids, as a tokenizer does by default.
    """

    ranks: bytes
    pattern: str
    specials: tuple[tuple[str, int], ...] = ()
    end: int = 1

    @classmethod
    def read(cls, path: str, pattern: str, specials: dict[str, int] | None = None, end: int = 1) -> Vocabulary:
        with open(path, "rb") as f:
            return cls(f.read(), pattern, tuple((specials or {}).items()), end)

    def encode(self, text: str) -> np.ndarray:
        coder = _encoding(self.ranks, self.pattern, self.specials)
        ids: list[np.ndarray] = []
        at = 0
        for run in _BLANKS.finditer(text):
            # the pattern takes a run as one piece, but leaves its last character to a text that follows
            last = run.end() == len(text) or any(text.startswith(s, run.end()) for s, _ in self.specials)
            cut = run.end() if last else run.end() - 1
            ids.append(self._plain(coder, text[at : run.start()]))
            ids.append(np.array(coder._encode_single_piece(text[run.start() : cut]), np.uint32))
            at = cut
        return np.concatenate((*ids, self._plain(coder, text[at:]), np.array([self.end], np.uint32)))

    def _plain(self, coder: tiktoken.Encoding, text: str) -> np.ndarray:
        # as an array: no Python number is made of an id
        return coder.encode_to_numpy(text, allowed_special="all", disallowed_special=())


@dataclass
class _Piece:
    doc: object
    start: int
    ids: np.ndarray
    total: int
    prompt: int  # tokens at the start of the text without loss

    def loss(self, n: int | None = None) -> int:
        n = len(self.ids) if n is None else n
        return max(0, n - max(0, self.prompt - self.start))

    def cut(self, n: int) -> tuple[_Piece, _Piece]:
        return (
            _Piece(self.doc, self.start, self.ids[:n], self.total, self.prompt),
            _Piece(self.doc, self.start + n, self.ids[n:], self.total, self.prompt),
        )


class Packer:
    """Packs pieces that arrive one after the other; holds at most `pool` of them."""

    def __init__(self, limits: Limits, pool: int, min_piece: int, first_id: int) -> None:
        self.limits, self.pool, self.min_piece, self.next_id = limits, pool, min_piece, first_id
        self.waiting: list[_Piece | None] = []
        self.need = np.zeros((3, 2 * pool))  # by resource; infinite where a piece has been taken
        self.count = 0
        self.done: list[tuple[_Piece, int, int]] = []

    @property
    def capacity(self) -> np.ndarray:
        return np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)

    def add(self, piece: _Piece) -> None:
        """Take a text: its full lengths are sequences of their own, the rest waits."""
        while len(piece.ids) > self.limits.tokens or piece.loss() > self.limits.loss:
            n = self._fit(piece, self.limits.tokens, self.limits.loss)
            head, piece = piece.cut(n)
            self._emit([head])
        if len(piece.ids) == self.limits.tokens:
            self._emit([piece])
        elif len(piece.ids):
            self._wait(piece)
        if self.count >= self.pool:
            while self.count > self.pool // 2:
                self._fill()

    def finish(self) -> None:
        while self.count:
            self._fill()

    def _wait(self, piece: _Piece) -> None:
        if len(self.waiting) == self.need.shape[1]:
            live = [i for i, p in enumerate(self.waiting) if p is not None]
            self.need[:, : len(live)] = self.need[:, live]
            self.waiting = [self.waiting[i] for i in live]
            if len(self.waiting) == self.need.shape[1]:
                self.need = np.concatenate((self.need, np.zeros_like(self.need)), axis=1)
        self.need[:, len(self.waiting)] = len(piece.ids), 1, piece.loss()
        self.waiting.append(piece)
        self.count += 1

    def _take(self, i: int) -> _Piece:
        piece = self.waiting[i]
        self.waiting[i] = None
        self.need[:, i] = np.inf
        self.count -= 1
        return piece

    @staticmethod
    def _fit(piece: _Piece, tokens: int, loss: int) -> int:
        """How many tokens of a piece fit."""
        return min(len(piece.ids), tokens, loss + max(0, piece.prompt - piece.start))

    def _fill(self) -> None:
        """Fill one sequence."""
        need = self.need[:, : len(self.waiting)]
        demand = need[:, np.isfinite(need[0])].sum(axis=1) / self.capacity
        weight = demand / max(demand.max(), 1e-12) / self.capacity**2
        left, chosen = self.capacity.copy(), []
        while left.min() > 0 or (left[0] > 0 and left[1] > 0):
            fits = np.flatnonzero((need[0] <= left[0]) & (need[1] <= left[1]) & (need[2] <= left[2]))
            if len(fits):
                score = (weight * left) @ need[:, fits]
                piece = self._take(int(fits[score.argmax()]))
            elif left[0] >= self.min_piece and left[1] >= 1 and self.count:
                at = int(np.where(np.isfinite(need[0]), need[0], -1).argmax())
                n = self._fit(self.waiting[at], int(left[0]), int(left[2]))
                if n < self.min_piece:
                    break
                piece, rest = self._take(at).cut(n)
                self.waiting[at], self.need[:, at] = rest, (len(rest.ids), 1, rest.loss())
                self.count += 1
            else:
                break
            chosen.append(piece)
            left -= (len(piece.ids), 1, piece.loss())
        if self.count:
            self._emit(chosen)
        else:
            self._emit_powers(chosen)

    def _emit(self, pieces: list[_Piece]) -> None:
        offset = 0
        for p in pieces:
            self.done.append((p, self.next_id, offset))
            offset += len(p.ids)
        self.next_id += 1

    def _emit_powers(self, pieces: list[_Piece]) -> None:
        """The last sequence, in parts whose lengths are powers of two."""
        total = sum(len(p.ids) for p in pieces)
        if total == self.limits.tokens:
            return self._emit(pieces)
        queue = list(reversed(pieces))
        while total:
            room = 1 << (total.bit_length() - 1)
            total -= room
            part = []
            while room:
                piece = queue.pop()
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    queue.append(rest)
                part.append(piece)
                room -= len(piece.ids)
            self._emit(part)
        return None

    def drain(self, schema: pa.Schema) -> pa.RecordBatch:
        rows, self.done = self.done, []
        columns = [
            [p.doc for p, _, _ in rows],
            [p.start for p, _, _ in rows],
            [len(p.ids) for p, _, _ in rows],
            [p.total for p, _, _ in rows],
            [s for _, s, _ in rows],
            [o for _, _, o in rows],
            [p.ids.astype("<u4").tobytes() for p, _, _ in rows],
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )


def pack(
    df: DataFrame,
    vocabulary: Vocabulary,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    limits: Limits = Limits(),  # noqa: B008
    pool: int = 2048,
    min_piece: int = 8,
) -> DataFrame:
    """Pieces with their place: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ids: the piece's token ids as little-endian unsigned 32-bit integers.
    prompt_col: the number of tokens at the start of each text that bear no loss (null: 0), as in
    instruction data; without it all tokens bear loss. sequence_id is unique, not dense. The
    result depends on how the input is partitioned, and is equal again when a task is repeated.
    """
    narrow = df.select(
        df[id_col].alias("doc_id"),
        df[text_col].alias("text"),
        (F.coalesce(df[prompt_col].cast("long"), F.lit(0)) if prompt_col else F.lit(0).cast("long")).alias("prompt"),
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, schema = Packer(limits, pool, min_piece, TaskContext.get().partitionId() << 40), None
        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            longs = [pa.field(n, pa.int64()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")]
            schema = pa.schema([pa.field("doc_id", doc_type), *longs, pa.field("ids", pa.binary())])
            texts, docs, prompts = batch.column("text"), batch.column("doc_id"), batch.column("prompt")
            for i in range(batch.num_rows):
                ids = vocabulary.encode(texts[i].as_py() or "")
                packer.add(_Piece(docs[i].as_py(), 0, ids, len(ids), prompts[i].as_py()))
                if len(packer.done) >= _ROWS:
                    yield packer.drain(schema)
        if schema is not None:
            packer.finish()
            yield packer.drain(schema)

    return narrow.mapInArrow(packed, PIECES.format(id=narrow.schema["doc_id"].dataType.simpleString()))

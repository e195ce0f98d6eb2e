"""Toxicity: fuzzy lexicon matches, weighed by their context.

The lexicon is a trie. Levenshtein automata of its words are intersected with it and made
deterministic once, on the driver; tasks then run all words of a chunk through the resulting
table at the same time, one byte position a step. A word matches a term within 1 edit (terms of
5 bytes and more) or 2 edits (9 and more); a stem, of which many words with any ending were
learned, matches as a prefix.

Each match is weighed by the words around it: quotation marks around it or words of reporting
before it mark a quotation, other matches and words of address mark abuse. A logistic model on
these sums gives the score.

Learning: at most SAMPLE labelled rows, taken in the order of a hash of the id, give the terms (by
how much oftener they stand in toxic texts) and the weights. Labels, language, source and id are
not inputs of a score.

Defined results: null and empty texts have no match and get the score of a text without match;
equal rows are scored each; labels of null are not learned from; without any labelled toxic row
the fixed words are used with fixed weights; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import ALNUM, WORD_PATTERN, Chunk, ascii_lower, chunks, lowered, runs

#: Labelled rows that are learned from, at most.
SAMPLE = 10_000
#: Terms that are learned, at most; toxic sample texts that a term needs, by number and by share. Rarer terms
#: are mostly words of one text and its near copies.
MAX_TERMS, MIN_TOXIC, MIN_SHARE = 50, 8, 0.04
#: How much oftener than in clean texts a term must stand in toxic ones.
MIN_ODDS = 25.0
#: Words on each side of a match that are its context.
CONTEXT = 6

# Common English words of abuse, known before anything is learned.
SEED = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
# Words of reporting and of address.
REPORTING = ("said", "says", "called", "quoted", "quote", "word", "term", "wrote", "dijo", "sagte", "dit")
ADDRESS = ("you", "your", "youre", "u", "tu", "du", "usted", "vous", "ihr")

FEATURES = ("abuse", "quoted", "density", "any")
#: Weights of the features and the constant, where nothing can be learned.
DEFAULT = (2.0, 0.3, 10.0, 1.5, -4.0)


@dataclass(frozen=True)
class Automaton:
    """next[state, class of byte], and for each state the term it accepts (-1: none) and the edits.

    State 0 is dead, 1 is the start.
    """

    byte_class: np.ndarray
    next: np.ndarray
    term: np.ndarray
    edits: np.ndarray


def edits_allowed(term: bytes) -> int:
    return 2 if len(term) >= 9 else 1 if len(term) >= 5 else 0


def automaton(words: list[bytes], stems: list[bytes]) -> Automaton:
    """The deterministic automaton of all words, each within its edits, and of all prefixes."""
    alphabet = sorted({b for t in [*words, *stems] for b in t})
    byte_class = np.zeros(256, np.uint8)
    for i, b in enumerate(alphabet):
        byte_class[b] = i + 1
    children: list[dict[int, int]] = [{}]
    ends: list[tuple[int, int] | None] = [None]  # (term, 1 if a stem)
    depth_left: list[int] = [0]  # the most edits of any term below
    for number, (term, stem) in enumerate([(t, 0) for t in words] + [(t, 1) for t in stems]):
        node, allowed = 0, 0 if stem else edits_allowed(term)
        depth_left[0] = max(depth_left[0], allowed)
        # words of different allowance live in tries of their own below the root, so that no term borrows edits
        for b in (256 + allowed + 10 * stem, *term):
            if b not in children[node]:
                children[node][b] = len(children)
                children.append({})
                ends.append(None)
                depth_left.append(allowed)
            node = children[node][b]
        ends[node] = ends[node] or (number, stem)

    def closure(states: set[tuple[int, int]]) -> frozenset:
        best: dict[int, int] = {}
        todo = deque(states)
        while todo:
            node, left = todo.popleft()
            if best.get(node, -1) >= left:
                continue
            best[node] = left
            if left:
                todo.extend((c, left - 1) for c in children[node].values())
        return frozenset(best.items())

    roots = {(c, depth_left[c]) for c in children[0].values()}
    numbers: dict[object, int] = {"dead": 0}
    table: list[list[int]] = [[0] * (len(alphabet) + 1)]
    term, edits = [-1], [0]

    def accepts(state: frozenset) -> tuple[int, int]:
        found = [(depth_left[n] - left, ends[n][0]) for n, left in state if ends[n] is not None]
        return min(found, default=(0, -1))

    def number(state: frozenset, todo: deque) -> int:
        if not state:
            return 0
        stem = [ends[n][0] for n, _ in state if ends[n] is not None and ends[n][1]]
        key = ("stem", min(stem)) if stem else state
        if key not in numbers:
            numbers[key] = len(table)
            table.append([numbers[key]] * (len(alphabet) + 1) if stem else [0] * (len(alphabet) + 1))
            e, t = (0, min(stem)) if stem else accepts(state)
            term.append(t)
            edits.append(e)
            if not stem:
                todo.append(state)
        return numbers[key]

    todo: deque = deque()
    number(closure(roots), todo)
    while todo:
        state = todo.popleft()
        here = numbers[state]
        for c in range(len(alphabet) + 1):
            reached = set()
            for node, left in state:
                if c and alphabet[c - 1] in children[node]:
                    reached.add((children[node][alphabet[c - 1]], left))
                if left:
                    reached.add((node, left - 1))
                    reached.update((x, left - 1) for x in children[node].values())
            table[here][c] = number(closure(reached), todo)
    return Automaton(byte_class, np.array(table, np.int32), np.array(term), np.array(edits))


def run(auto: Automaton, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the term that it matches (-1: none) and the edits."""
    classes = auto.byte_class[data]
    final = np.zeros(len(start), np.int32)
    alive = np.arange(len(start))
    state = np.ones(len(start), np.int32)
    place = start.copy()
    while len(alive):
        state = auto.next[state, classes[place]]
        place = place + 1
        over = place >= end[alive]
        final[alive[over]] = state[over]
        go = ~over & (state != 0)
        alive, state, place = alive[go], state[go], place[go]
    return auto.term[final], auto.edits[final]


def _hash_set(words: tuple[str, ...]) -> set[bytes]:
    return {w.encode() for w in words}


def features(chunk: Chunk, auto: Automaton) -> dict[str, np.ndarray]:
    """The inputs of the score for each text of a chunk, and the number of matches."""
    data, n = lowered(chunk.data), len(chunk.offsets) - 1
    start, end = runs(ALNUM[data], chunk.offsets)
    doc = np.searchsorted(chunk.offsets, start, "right") - 1
    term, edits = run(auto, data, start, end)
    hit = np.flatnonzero(term >= 0)
    out = {k: np.zeros(n) for k in FEATURES}
    reporting, address, marks = _hash_set(REPORTING), _hash_set(ADDRESS), b"\"'\xab\xbb\x9c\x9d\x9e"
    bounds = np.searchsorted(doc, np.arange(n + 1))
    hits_before = np.searchsorted(hit, np.arange(len(doc) + 1))
    for h in hit.tolist():
        d = int(doc[h])
        low, high = max(h - CONTEXT, int(bounds[d])), min(h + CONTEXT + 1, int(bounds[d + 1]))
        around = [data[start[i] : end[i]].tobytes() for i in range(low, high) if i != h]
        left = data[max(int(chunk.offsets[d]), start[h] - 2) : start[h]].tobytes()
        right = data[end[h] : min(int(chunk.offsets[d + 1]), end[h] + 2)].tobytes()
        in_marks = any(x in marks for x in left) and any(x in marks for x in right)
        told = any(w in reporting for w in around[: h - low])
        near = int(hits_before[high] - hits_before[low]) - 1
        sure = 1.0 if edits[h] == 0 else 0.7
        if in_marks or (told and not near):
            out["quoted"][d] += sure
        else:
            out["abuse"][d] += sure * (1 + 0.25 * min(near, 4) + 0.25 * any(w in address for w in around))
    n_words = np.maximum(1, np.diff(bounds))
    out["density"] = np.minimum(1, out["abuse"] / n_words * 5)
    out["any"] = (out["abuse"] + out["quoted"] > 0).astype(float)
    out["abuse"], out["quoted"] = np.log1p(out["abuse"]), np.log1p(out["quoted"])
    out["n_hits"] = np.bincount(doc[hit], minlength=n) if len(hit) else np.zeros(n)
    return out


@dataclass(frozen=True)
class Model:
    """The lexicon and the weights of the features, the constant last."""

    words: tuple[str, ...] = SEED
    stems: tuple[str, ...] = ()
    weights: tuple[float, ...] = DEFAULT

    def automaton(self) -> Automaton:
        return automaton([w.encode() for w in self.words], [s.encode() for s in self.stems])


def _featured(model: Model, extra: list[str]):
    auto = model.automaton()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                found = features(chunk, auto)
                part = batch.slice(chunk.first, chunk.last - chunk.first)
                arrays = [part.column(n) for n in extra]
                arrays += [pa.array(found[f].astype(float)) for f in (*FEATURES, "n_hits")]
                yield pa.RecordBatch.from_arrays(arrays, [*extra, *FEATURES, "n_hits"])

    return rows


def with_features(df: DataFrame, model: Model) -> DataFrame:
    """All columns but `text`, and the features of `text`."""
    extra = [f for f in df.schema if f.name != "text"]
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in extra]
    schema += [f"{f} double" for f in (*FEATURES, "n_hits")]
    return df.mapInArrow(_featured(model, [f.name for f in extra]), ", ".join(schema))


def held_out(doc_id):
    """Whether a row is never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn_terms(sample: DataFrame) -> tuple[list[str], list[str]]:
    """Words and stems that stand much oftener in toxic texts; sample: (text, toxic), equal texts once."""
    words = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORD_PATTERN), F.lit(0)))
    stems = F.flatten(F.transform(F.sequence(F.lit(4), F.lit(8)), lambda n: F.transform(
        F.filter(F.col("w"), lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, F.lit(1), n), F.lit("*"))
    )))
    terms = sample.select("toxic", words.alias("w")).select(
        "toxic", F.explode(F.array_distinct(F.concat("w", stems))).alias("term")
    )
    seen = terms.groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    )
    n = sample.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).first()
    if not n or not n["t"] or not n["c"]:
        return [], []
    odds = (F.col("toxic") / F.lit(n["t"])) / ((F.col("clean") + 0.5) / F.lit(n["c"] + 1))
    least = max(MIN_TOXIC, MIN_SHARE * n["t"])
    best = (
        seen.where((F.col("toxic") >= least) & (odds >= MIN_ODDS))
        .orderBy(F.desc("toxic"), "term")
        .limit(20 * MAX_TERMS)
        .collect()
    )
    count = {r["term"]: r["toxic"] for r in best}
    words, stems = [], []
    for term, toxic in count.items():
        if not term.endswith("*"):
            # the endings of a learned stem are many rare words; a word of its own stands alone
            if all(toxic > 0.8 * count.get(term[:k] + "*", 0) for k in range(4, len(term))):
                words.append(term)
            continue
        longer = [t for t in count if t != term and t.startswith(term[:-1]) and count[t] >= 0.8 * toxic]
        if not longer:
            stems.append(term[:-1])
    # a stem below another one says nothing more
    stems = [s for s in stems if not any(s != x and s.startswith(x) for x in stems)]
    words = [w for w in words if not any(w.startswith(s) for s in stems)]
    return words[:MAX_TERMS], stems[:MAX_TERMS]


def fit_weights(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> tuple[float, ...]:
    """Logistic regression by Newton's steps on at most SAMPLE rows."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The lexicon and weights from labelled rows that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # the bound of the sample bounds the broadcast
    chosen = known.groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    texts = texts.groupBy("text").agg(F.max("toxic").alias("toxic"))
    words, stems = learn_terms(texts)
    model = Model(tuple(dict.fromkeys([*words, *SEED])), tuple(stems))
    rows = with_features(texts, model).select(*FEATURES, "toxic").collect()
    y = np.array([r["toxic"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return model
    x = np.array([[r[f] for f in FEATURES] for r in rows])
    return Model(model.words, model.stems, fit_weights(x, y))


def score(df: DataFrame, model: Model) -> DataFrame:
    """All columns but `text`, with `score` from 0 to 1 and the number of matches."""
    total = F.lit(model.weights[-1])
    for f, w in zip(FEATURES, model.weights, strict=False):
        total = total + F.col(f) * F.lit(w)
    scored = with_features(df, model)
    return scored.withColumn("score", 1 / (1 + F.exp(-total))).drop(*FEATURES)

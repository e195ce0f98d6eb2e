"""Conversation tries, periodic runs and SimHash classes against brute force."""

from __future__ import annotations

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from tidemark.llm import periodic, prefix_trie, queries, simhash, templates  # noqa: E402

NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
TURNS = "conv_id long, turn long, role string, text string, rep string, n string, conv string, d string"


def conversations(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *[None] * 4) for r in rows], TURNS).repartition(parts)


def nodes(df):
    return sorted((tuple(r[c] for c in NODE) for r in df.collect()), key=str)


def random_turns(rng, n, longest, texts):
    return [(c, t, rng.choice(["user", None]), rng.choice(texts)) for c in range(n) for t in range(rng.randint(1, longest))]


def shared_heads():
    return {"head": F.crc32(F.col("conv").cast("string")) % 6, "origin": F.col("conv") - F.col("conv") % 100}


def head(c):
    return zlib.crc32(str(c).encode()) % 6


@pytest.mark.parametrize(("seed", "local"), [(1, 1), (2, 1000)])
def test_trie_matches_brute_force(spark, seed, local):
    rng = random.Random(seed)
    rows = random_turns(rng, 120, 6, ["a", "", "été"])
    rows = [r for r in rows if r[0] != 100]  # the origin of the second hundred is absent
    rows += [(5, None, "user", "first"), (300, 1, "user", "x"), (301, 1, "user", "y")]
    got = nodes(prefix_trie.prefix_trie(conversations(spark, rows), local=local, long_list=4, **shared_heads()))
    assert got == brute.trie(rows, head, lambda c: c - c % 100)
    assert any(r[1] == 0 and r[-1] != brute.sha("") for r in got), "a conversation without turns ends at the root"


def test_trie_deep(spark):
    """Every conversation is one turn longer than the last, and one is far longer: no round follows the depth."""
    rows = [(c, t, "user", f"t{t}") for c in range(14) for t in range(c + 1)] + [(99, t, "user", f"t{t}") for t in range(150)]
    rounds = []
    kept, prefix_trie.stored = prefix_trie.stored, lambda df: rounds.append(1) or kept(df)
    try:
        got = nodes(prefix_trie.prefix_trie(conversations(spark, rows), local=2))
    finally:
        prefix_trie.stored = kept
    assert got == brute.trie(rows)
    assert len(rounds) < 14 + 5 * 5


def test_trie_odd_rows(spark):
    rows = [(1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (2, 0, None, None), (None, 1, "user", "a")]
    got = nodes(prefix_trie.prefix_trie(conversations(spark, rows)))
    again = nodes(prefix_trie.prefix_trie(conversations(spark, rows[::-1], 1)))
    assert got == again and max(r[1] for r in got) == 3 and got[0][3] == 2
    assert nodes(prefix_trie.prefix_trie(conversations(spark, []))) == []
    wide = conversations(spark, rows).repartition(40)
    assert nodes(prefix_trie.prefix_trie(wide)) == got


def test_trie_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = nodes(queries.QUERIES["op11_prefix_trie"](spark, folder))
    assert got == brute.trie(rows, head, lambda c: c - c % 100)


RUNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def documents(spark, texts, parts=3):
    rows = [(i, t, *[None] * 4) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, fp long, mask string, start string, runs string").repartition(parts)


def odd_texts(rng):
    texts = [None, "", " \t\n\x0b ", "a", "a " * 5, "a " * 6, "a b " * 3 + "a", "x y " * 9, "é " * 4000]
    for _ in range(150):
        words = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 60))]
        p, s = rng.randint(1, 12), rng.randrange(len(words))
        texts.append(rng.choice([" ", "\n"]).join(words[:s] + words[s : s + p] * rng.randint(1, 7) + words))
    return texts + texts[-3:]


def test_periodic_matches_brute_force(spark, monkeypatch):
    texts = odd_texts(random.Random(3))
    for chunk in (1 << 18, 50):
        monkeypatch.setattr(periodic, "CHUNK_WORDS", chunk)
        df = periodic.digest(periodic.periodic_runs(documents(spark, texts), rewrite=periodic.planted))
        assert {r["doc_id"]: tuple(r[c] for c in RUNS) for r in df.collect()} == {
            i: brute.periodic(i, t) for i, t in enumerate(texts)
        }
    assert periodic.periodic_runs(documents(spark, ["a"]).where("false")).collect() == []


def test_periodic_runs_and_text(spark):
    text = "to be " + "or not " * 5 + "that"
    row = periodic.periodic_runs(documents(spark, [text])).first()
    assert row.collapsed == "to be or not that" and row.n_kept == 5
    assert [tuple(r) for r in row.runs] == [(2, 10, 2)]
    unnamed = periodic.periodic_runs(documents(spark, [text]).withColumn("doc_id", F.lit(None).cast("long")), rewrite=periodic.planted)
    assert unnamed.first().n_runs == 1


def test_runs_of_many_words():
    """Random texts over few words, several in a chunk."""
    rng = random.Random(5)
    for _ in range(300):
        texts = [[rng.randrange(rng.choice([1, 2, 4])) for _ in range(rng.choice([0, 1, 7, 40, 90]))] for _ in range(3)]
        bounds = np.cumsum([0, *map(len, texts)])
        names = np.array([w + 9 * i for i, t in enumerate(texts) for w in t], np.int64)
        found = periodic.find_runs(names, bounds)
        got = list(zip(found.start.tolist(), found.length.tolist(), found.period.tolist(), strict=True))
        assert got == [(s + bounds[i], n, q) for i, t in enumerate(texts) for s, n, q in brute.runs(t)]


def test_periodic_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    short = {i for i, t in texts.items() if len(t or "") < 4000}
    got = {r["doc_id"]: tuple(r[c] for c in RUNS) for r in queries.QUERIES["op12_periodic_runs"](spark, folder).collect()}
    assert set(got) == set(texts)
    assert {i: got[i] for i in short} == {i: brute.periodic(i, texts[i]) for i in short}


def test_fingerprints(spark):
    texts = odd_texts(random.Random(4)) + ["The THE the İstanbul É"]
    rows = simhash.digest(simhash.near_duplicates(documents(spark, texts))).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{brute.fingerprint(t):016x}" for i, t in enumerate(texts)}
    label = brute.reachable([brute.fingerprint(t) for t in texts])
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(label))
    assert simhash.near_duplicates(documents(spark, ["a"]).where("false")).collect() == []


@pytest.mark.parametrize("limit", [2, 512])
def test_links_join_all_close_fingerprints(spark, limit):
    """Clusters, chains of close ones, and many that share most of their bits."""
    rng = random.Random(6)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(12):
            values.add(x)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
    base = rng.getrandbits(64) & ~0x3FF
    values |= {base | rng.getrandbits(10) for _ in range(60)} | {rng.getrandbits(64) for _ in range(200)}
    values = sorted(values)
    df = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    links = simhash.linked(df, limit=limit).collect()
    mask = (1 << 64) - 1
    place = {v: i for i, v in enumerate(values)}
    label = list(range(len(values)))
    for a, b in links:
        assert ((a ^ b) & mask).bit_count() <= 3
        x, y = sorted((label[place[a & mask]], label[place[b & mask]]))
        label = [x if v == y else v for v in label]
    assert label == brute.reachable(values)


def test_masks_leave_no_close_pair_apart():
    """However three bits are placed, some bucket of every split still holds both."""
    rng = random.Random(8)
    for _ in range(200):
        differ = sum(1 << b for b in rng.sample(range(64), 3))
        masks = [m for m in simhash.first_masks() if not m & differ]
        while masks and any(64 - m.bit_count() > 8 for m in masks):
            masks = [x for m in masks[:1] for x in simhash.next_masks(m) if not x & differ]
        assert masks


def test_forest_is_bounded():
    """A bucket of mutually close fingerprints gives a link for each, not for each pair."""
    rows = simhash._forest(3)(iter([pa.RecordBatch.from_pydict({"fps": [[0, *(1 << b for b in range(40))]]})]))
    assert sum(b.num_rows for b in rows) == 40


def test_lines_are_parsed_as_told(spark):
    """Tokens, sizes, leaves and equal lines against regular expressions, with white space of every kind."""
    blank = " \t\x0b\x85\xa0       　\r"
    rng = random.Random(9)
    pieces = ["a", "b1", "7", "é", "漢", "<*>", "--", "Ł", *blank, "\n", "\n"]
    texts = [None, "", "\n", "x", "1 2 3", "٣ !", "　\n—\n"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "row_key long, text string").repartition(3)
    rows = templates._lines(docs, 3, 0.5, raw=True).collect()
    want = {}
    for i, t in enumerate(texts):
        for pos, line in enumerate((t or "").split("\n")):
            if regex.search(r"[\p{L}\p{N}]", line):
                tokens = [x for x in regex.split(r"[ \t-\r\x85\p{Z}]+", line) if x]
                want[i, pos] = (line, tokens, ["<*>" if regex.search("[0-9]", x) else x for x in tokens])
    assert {(r.row_key, r.pos) for r in rows} == set(want)
    leaves, lines = {}, {}
    for r in rows:
        line, tokens, masked = want[r.row_key, r.pos]
        assert (r.n, r.size, r.all, r.raw.removesuffix("\n")) == (
            len(tokens), len(line.encode()), len(texts[r.row_key].encode()), line
        )
        assert (r.leaf is None) == (len(tokens) < 3)
        if r.leaf is not None:
            assert leaves.setdefault(r.leaf, (len(tokens), masked[:3])) == (len(tokens), masked[:3])
        whole = len(tokens) >= 3 and 2 * sum(m == t for m, t in zip(masked, tokens) if not regex.search("[0-9]", t)) >= len(tokens)
        # a masked token is told from the text <*>, which no line needs to be
        key = (whole, tuple(("*",) if regex.search("[0-9]", t) and whole else t for t in tokens))
        assert lines.setdefault(r.line, key) == key
    assert len(set(map(str, lines.values()))) == len(lines)

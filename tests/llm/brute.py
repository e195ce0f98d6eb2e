"""The contracts, told in plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def licenses(text):
    """(n_words, n_base, first_word, last_word, base_labels)"""
    w = words(text)
    found = []
    for label, phrase in PHRASES:
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    at = [i for i, _ in found]
    labels = ",".join(sorted({x for _, x in found}))
    return len(w), len(found), min(at, default=None), max(at, default=None), labels


def decontamination(docs, items, span=13):
    """{doc place: (n_words, n_hit, n_items, items_sha256, contaminated)}; docs and items: (id, text)"""
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(span, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add(item)
    sizes = {len(k) for k in windows}
    out = []
    for _, text in docs:
        w = words(text)
        hit, seen = set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if got := windows.get(tuple(w[i : i + m])):
                    hit.update(range(i, i + m))
                    seen |= got
        ids = ",".join(sorted(str(x) for x in seen if x is not None))
        n_items = len({x for x in seen if x is not None})
        out.append((len(w), len(hit), n_items, sha(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return out


ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)


def secrets(text):
    """(n_assign, n_access, n_hex, base_sha256)"""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    n = Counter(k for _, k, _ in found)
    kinds = ("assign", "access", "hex")
    joined = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found))
    return n[0], n[1], n[2], sha(joined), joined


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    n = len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, w)), symbols, dup, len(again), n < 10 or 100 * len(again) > 20 * n


def repeats(texts, size=400):
    """For each text (n_bytes, n_removed, n_spans, kept_sha256)"""
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + size] for b in raw for i in range(len(b) - size + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if count[b[i : i + size]] > 1:
                gone[i : i + size] = b"\x01" * size
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, k=5):
    w = words(text)
    return Counter(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()


def trie(rows, head=lambda c: 0, origin=lambda c: c):
    """Sorted tuples of every node's columns; rows: (conv_id, turn, role, text), without tied turns."""
    turns = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        turns.setdefault(conv, []).append((role or "", text or ""))
    convs = {c: tuple(turns.get(origin(c), [])[: head(c)] + own[head(c) :]) for c, own in turns.items()}
    members = {}
    for c, whole in convs.items():
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
    out = []
    for node, inside in members.items():
        below = [m for m in members if m[: len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(x[: len(m)] == m and len(x) > len(m) for x in below)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m)
        ends = sorted(c for c in inside if convs[c] == node)
        parent = min(members[node[:-1]]) if node else None
        ids = sha(",".join(map(str, ends)))
        out.append((min(inside), len(node), parent, len(inside), len(children), len(leaves), saved, ids))
    return sorted(out, key=str)


def planted(doc_id, text):
    """The words of a text, every tenth text made periodic from some word on."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def runs(w):
    """(start, length, period) of every run of a list of words."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                stretch = w[i : j + q]
                if not any(stretch[r:] == stretch[:-r] for r in range(1, q)):
                    out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(doc_id, text):
    """(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)"""
    w = planted(doc_id, text)
    found = runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    top = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    listed = sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
    kept = sha(" ".join(x for i, x in enumerate(w) if i not in gone))
    return len(found), *top, None if top[0] is None else 1000 * top[1] // top[2], listed, kept


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reachable(fingerprints, distance=3):
    """The smallest place that each place is linked to, by links between all pairs."""
    label = list(range(len(fingerprints)))
    for i, x in enumerate(fingerprints):
        near = [j for j in range(i) if (x ^ fingerprints[j]).bit_count() <= distance]
        groups = {label[j] for j in near} | {i}
        label = [min(groups) if v in groups else v for v in label]
    return label

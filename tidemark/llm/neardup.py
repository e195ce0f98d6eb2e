"""Near-duplicate documents by order MinHash, verified by banded alignment.

Texts are sequences of k-mers of words, each labelled by how often it occurred before in its text.
A sketch takes, for each of `SKETCHES` hash functions, the `MINIMA` smallest labelled k-mers and
hashes them in the order of the text, so texts agree in a sketch if they share these k-mers in the
same order. Two texts of similarity 0.8 agree in about half of all sketches and in at least one
but for about three in a hundred million.

Texts with equal words are one candidate (their copies join its class). Texts that agree in a
sketch form a bucket. No bucket is expanded into all its pairs: first all members meet one leader,
the member that agrees with the most texts in all sketches. A bucket whose other members are then
one class is done, as no pair of them can join two classes.

The texts of the other buckets, such as those that share a passage but little else, are put into
new buckets by their rarest k-mers, so many of each that two texts without a common one cannot be
similar. These are worked off in rounds: members of the smallest classes lead, four times as many in
each round, and meet the members of other classes; who has led leaves the bucket. The rounds end when no
bucket holds two classes, so no pair that could join two classes is left out.

A pair is a link if the aligned k-mers, over all k-mers of both, are at least `threshold`. The
alignment is the longest common subsequence of the two k-mer sequences within the band that a pair
of that similarity cannot leave. Classes are the connected components of all links.

Defined results: texts without a word (null, empty) have equal words, none, and are one class;
a text of fewer than k words is one k-mer; equal rows are one class; an empty table gives an
empty result; of other columns only those in `keep` are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import checkpointed, components, stored
from tidemark.llm.words import Words, chunks, gram_hash, keyed, mix, powers, signed, split_words

K = 5
SKETCHES, MINIMA = 24, 3
#: Leaders of a bucket of rare k-mers in the first round; each later round has four times as many.
LEADERS = 8
#: Bits of the filter that texts pass before they are shuffled, as a power of two: at most 2**20 rows of 64 bits.
FILTER_BITS = 26
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Odd multipliers of the hash functions.
_FUNCTIONS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64)) | np.uint64(1)


def kmers(words: Words, n: int, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-mers of n texts and the bounds of each text's; a short text is one k-mer."""
    count = np.diff(words.bounds)
    sizes = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    within = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes)
    at = np.repeat(words.bounds[:-1], sizes) + within
    # words beyond the end of a short text count as nothing
    padded = np.concatenate((words.hash, np.zeros(k, np.uint64)))
    short = np.flatnonzero((count > 0) & (count < k))
    out = gram_hash(padded, k)[at]
    for i in short.tolist():
        own = np.zeros(k, np.uint64)
        own[: count[i]] = words.hash[words.bounds[i] : words.bounds[i + 1]]
        out[bounds[i]] = gram_hash(own, k)[0]
    return out, bounds


def labelled(grams: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """K-mers made unique within their text by the number of earlier equal ones."""
    key = mix(grams ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = np.concatenate(([False], key[order][1:] == key[order][:-1])) if len(key) else np.zeros(0, bool)
    place = np.arange(len(key))
    first = np.maximum.accumulate(np.where(same, 0, place)) if len(key) else place
    seen = np.zeros(len(key), np.uint64)
    seen[order] = (place - first).astype(np.uint64)
    return np.where(seen > 0, mix(grams + seen * np.uint64(0x9E3779B97F4A7C15)), grams)


def sketches(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of sketches for each text that has a k-mer."""
    sizes = np.diff(bounds)
    has = sizes > 0
    starts, sizes = bounds[:-1][has], sizes[has]
    out = np.zeros((len(starts), SKETCHES), np.uint64)
    if not len(starts):
        return out
    for j, factor in enumerate(_FUNCTIONS):
        values = grams * factor
        places = np.full((len(starts), MINIMA), len(grams), np.int64)
        for r in range(MINIMA):
            least = np.minimum.reduceat(values, starts)
            some = sizes > r
            at = np.flatnonzero((values == np.repeat(least, sizes)) & np.repeat(some, sizes))
            # a value may be found twice only by a collision; the first place counts
            text = np.searchsorted(starts, at, "right") - 1
            text, which = np.unique(text, return_index=True)
            places[text, r] = at[which]
            values[at] = _MAX
        places.sort(axis=1)
        taken = np.concatenate((grams, np.zeros(1, np.uint64)))[places]
        total = np.full(len(starts), np.uint64(j + 1), np.uint64)
        for r, p in enumerate(powers(MINIMA + 1, 0xE7037ED1A0B428DB)[1:]):
            total += taken[:, r] * p
        out[:, j] = mix(total)
    return out


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_key, doc_id, n_kmers, t1, t2, sketch): t1, t2 tell texts with equal words."""
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            words, n = split_words(chunk), chunk.last - chunk.first
            grams, bounds = kmers(words, n)
            doc = np.repeat(np.arange(n), np.diff(bounds))
            unique = labelled(grams, doc)
            has = np.diff(bounds) > 0
            found = np.zeros((n, SKETCHES), np.uint64)
            found[has] = sketches(unique, bounds)
            # the words in their order, in two independent hashes
            place = (np.arange(len(words.doc)) - words.bounds[words.doc]).astype(np.uint64)
            total = np.zeros((2, n), np.uint64)
            for t in range(2):
                mixed = mix(words.hash + mix(place + np.uint64(0x632BE59BD9B4E019 * (t + 1) % 2**63)))
                if has.any():
                    total[t, has] = np.add.reduceat(mixed, words.bounds[:-1][has])
            part = batch.slice(chunk.first, n)
            empty = pa.array(~has)
            offsets = pa.array(np.concatenate(([0], np.cumsum(np.where(has, SKETCHES, 0)))).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, signed(found[has].ravel()))
            del empty
            yield pa.RecordBatch.from_arrays(
                [part.column("row_key"), part.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)),
                 signed(mix(total[0])), signed(mix(total[1] ^ np.uint64(0x5851F42D4C957F2D))), lists],
                ["row_key", "doc_id", "n_kmers", "t1", "t2", "sketch"],
            )


def _labelled_kmers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n_kmers, grams): the labelled k-mers of each text."""
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            n = chunk.last - chunk.first
            grams, bounds = kmers(split_words(chunk), n)
            unique = labelled(grams, np.repeat(np.arange(n), np.diff(bounds)))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), signed(unique))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key").slice(chunk.first, n), pa.array(np.diff(bounds).astype(np.int64)), lists],
                ["node", "n_kmers", "grams"],
            )


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_key, kmers): the k-mers of each text in order, 32 bits each."""
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            grams, bounds = kmers(split_words(chunk), chunk.last - chunk.first)
            low = (grams >> np.uint64(32)).astype("<u4")
            data = pa.py_buffer(low.tobytes())
            offsets = pa.py_buffer((bounds * 4).astype(np.int32).tobytes())
            binary = pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, data])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key").slice(chunk.first, chunk.last - chunk.first), binary], ["row_key", "kmers"]
            )


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """K-mers that both have, in any order; no alignment has more."""
    va, na = np.unique(a, return_counts=True)
    vb, nb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    return int(np.minimum(na[ia], nb[ib]).sum())


def needed(n: int, threshold: float) -> int:
    """K-mers that two texts of n k-mers in all must align to be linked."""
    return int(np.ceil(threshold * n / (1 + threshold) - 1e-9))


def aligned(a: np.ndarray, b: np.ndarray, threshold: float) -> int:
    """Length of the longest common subsequence within the band, or 0 if the threshold is out of reach.

    Equal ends are taken off; the rest is aligned row by row in bit vectors of one bit a column.
    """
    need = needed(len(a) + len(b), threshold)
    if not need or shared(a, b) < need:
        return 0
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    total = head + tail
    if not len(a) or not len(b):
        return total
    width = len(a) + len(b) + 2 * (head + tail) - 2 * need  # unaligned k-mers, at most
    if width < 0:
        width = 0
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    band = (1 << (2 * width + 1)) - 1
    row = full
    for j, y in enumerate(b.tolist()):
        hits = where.get(y, 0)
        if hits:
            hits &= band << (j - width) if j >= width else band >> (width - j)
            both_bits = row & hits
            row = ((row + both_bits) | (row - both_bits)) & full
    return total + len(a) - row.bit_count()


def _verified(threshold: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            first, second = batch.column("ka"), batch.column("kb")
            for i in range(batch.num_rows):
                a = np.frombuffer(first[i].as_py(), "<u4")
                b = np.frombuffer(second[i].as_py(), "<u4")
                linked.append(0 < needed(len(a) + len(b), threshold) <= aligned(a, b, threshold))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"]
            )

    return rows


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of docs whose row_key is among nodes.

    A bit is set for the hash of every node. The bits, 8 MB whatever the number of nodes, are broadcast
    as 64-bit words, so few other texts reach the shuffle of the exact join that follows; with far more
    than 2**FILTER_BITS nodes all texts do.
    """
    place = F.xxhash64("row_key").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    marks = nodes.select(F.col("node").alias("row_key")).withColumn("place", place)
    words = marks.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    placed = docs.select("row_key", "text").withColumn("place", place).withColumn("word", F.shiftright("place", 6))
    passed = placed.join(F.broadcast(words), "word").where(F.col("bits").bitwiseAND(bit) != 0)
    return passed.select("row_key", "text").join(nodes, F.col("row_key") == F.col("node"), "left_semi")


def _compare(pairs: DataFrame, sequences: DataFrame, threshold: float) -> DataFrame:
    """(a, b, linked) of each pair."""
    left = sequences.select(F.col("row_key").alias("a"), F.col("kmers").alias("ka"))
    right = sequences.select(F.col("row_key").alias("b"), F.col("kmers").alias("kb"))
    loaded = pairs.join(left, "a").join(right, "b").select("a", "b", "ka", "kb")
    return loaded.mapInArrow(_verified(threshold), "a long, b long, linked boolean")


def _leading(members: DataFrame, count: int) -> DataFrame:
    """The next leaders of each bucket: of the smallest classes, then of the highest degrees."""
    order = Window.partitionBy("bucket").orderBy("n_class", F.desc("degree"), "node")
    ranked = members.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select("bucket", *(F.col(c).alias(f"lead_{c}") for c in ("node", "n_kmers", "pos", "root")))


def _pairs(members: DataFrame, leading: DataFrame, threshold: float) -> DataFrame:
    """Members with the leaders of their buckets, each pair once, without those of one class and those
    that cannot link. A pair that can has, from its first common k-mer on, all it needs to share."""
    met = members.join(leading, "bucket").where(F.col("root") != F.col("lead_root"))
    need = F.ceil((F.col("n_kmers") + F.col("lead_n_kmers")) * (threshold / (1 + threshold)) - 1e-9)
    left = F.least(F.col("n_kmers") - F.col("pos"), F.col("lead_n_kmers") - F.col("lead_pos"))
    met = met.where(left >= need)
    return met.select(F.least("node", "lead_node").alias("a"), F.greatest("node", "lead_node").alias("b")).distinct()


def _undecided(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold several classes, with root and the size of the class there."""
    at = members.select("bucket", "node", "n_kmers", "pos", "degree").join(roots, "node", "left")
    at = at.withColumn("root", F.coalesce("root", "node"))
    classes = at.groupBy("bucket", "root").agg(F.count("*").alias("n_class"))
    several = classes.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return at.join(several, "bucket", "left_semi").join(classes, ["bucket", "root"])


def _able(members: DataFrame, threshold: float) -> DataFrame:
    """Members that may link even with the shortest text of their bucket, which asks the least of them."""
    shortest = members.groupBy("bucket").agg(F.min("n_kmers").alias("least"))
    least = F.ceil((F.col("n_kmers") + F.col("least")) * (threshold / (1 + threshold)) - 1e-9)
    return members.join(shortest, "bucket").where(F.col("n_kmers") - F.col("pos") >= least).drop("least")


def _by_rare_kmers(docs: DataFrame, threshold: float) -> DataFrame:
    """(bucket, node, n_kmers, pos, degree): a bucket holds the texts that have a k-mer among their rarest.

    Of n k-mers, two similar texts share at least `threshold` * n. In any common order, so, they share
    one of the first n - threshold * n + 1. K-mers of one text alone come first and need no bucket.
    pos: how many k-mers of the text come before.
    """
    every = docs.select("row_key", "text").mapInArrow(_labelled_kmers, "node long, n_kmers long, grams array<long>")
    every = every.select("node", "n_kmers", F.explode("grams").alias("bucket"))
    # written, so that the join shuffles both sides and very frequent k-mers can be split
    shared = stored(every.groupBy("bucket").agg(F.count("*").alias("n_texts")).where("n_texts > 1"))
    of_text = every.join(shared, "bucket").groupBy("node", "n_kmers")
    ordered = of_text.agg(F.array_sort(F.collect_list(F.struct("n_texts", "bucket"))).alias("grams"))
    first = F.col("n_kmers") - F.ceil(F.col("n_kmers") * threshold - 1e-9) + 1
    alone = F.col("n_kmers") - F.size("grams")
    taken = F.slice("grams", F.lit(1), F.greatest(first - alone, F.lit(0)).cast("int"))
    placed = ordered.select("node", "n_kmers", alone.alias("alone"), F.posexplode(taken).alias("i", "gram"))
    return placed.select(
        F.col("gram.bucket").alias("bucket"),
        "node",
        "n_kmers",
        (F.col("alone") + F.col("i")).alias("pos"),
        F.lit(0).cast("long").alias("degree"),
    )


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    keep: tuple[str, ...] = (),
    leaders: int = LEADERS,
) -> DataFrame:
    """One row per document: doc_id, kept columns, class_id, n_links, chosen.

    class_id: the smallest id of the class. n_links: verified links of the document's words to other
    words; pairs within a class that earlier links already join are not compared. chosen: true for exactly one document of a class, of its smallest id.
    """
    docs = keyed(df, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row_key long, doc_id {kind}, n_kmers long, t1 long, t2 long, sketch array<long>"
    sketched = checkpointed(docs.mapInArrow(_sketched, schema))
    texts = checkpointed(
        sketched.groupBy("t1", "t2").agg(
            F.min("row_key").alias("node"), F.first("n_kmers").alias("n_kmers"), F.first("sketch").alias("sketch")
        )
    )
    agree = texts.select("node", "n_kmers", F.explode("sketch").alias("bucket"))
    sizes = agree.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = agree.join(sizes, "bucket")
    degrees = members.groupBy("node").agg(F.sum("size").alias("degree"))
    members = stored(
        members.select("bucket", "node", "n_kmers")
        .join(degrees, "node")
        .withColumns({"root": F.col("node"), "n_class": F.lit(1).cast("long"), "pos": F.lit(0).cast("long")})
    )
    wanted = stored(_texts_of(docs, stored(members.select("node").distinct())))
    sequences = checkpointed(wanted.mapInArrow(_sequences, "row_key long, kmers binary"))

    leading = stored(_leading(members, 1))
    found = stored(_compare(_pairs(members, leading, threshold), sequences, threshold))
    tested, links = found.select("a", "b"), found.where("linked").select("a", "b")
    roots = components(links)
    led = leading.select("bucket", F.col("lead_node").alias("node"))
    open_texts = stored(_undecided(members.join(led, ["bucket", "node"], "left_anti"), roots).select("node").distinct())
    rare = _by_rare_kmers(wanted.join(open_texts, F.col("row_key") == F.col("node"), "left_semi"), threshold)
    members, count = stored(_undecided(_able(stored(rare), threshold), roots)), leaders
    while not members.isEmpty():
        leading = stored(_leading(members, count))
        new = _pairs(members, leading, threshold).join(tested, ["a", "b"], "left_anti")
        found = stored(_compare(new, sequences, threshold))
        more = found.where("linked").select("a", "b")
        tested, count = tested.union(found.select("a", "b")), 4 * count
        if not more.isEmpty():
            links = links.union(more)
            roots = components(links)
        led = leading.select("bucket", F.col("lead_node").alias("node"))
        members = stored(_undecided(members.join(led, ["bucket", "node"], "left_anti"), roots))

    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    label = texts.select("t1", "t2", "node").join(roots, "node", "left").join(degree, "node", "left")
    label = label.select("t1", "t2", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    placed = checkpointed(sketched.select("row_key", "doc_id", "t1", "t2").join(label, ["t1", "t2"]))
    classes = placed.groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.min(F.struct("doc_id", "row_key")).alias("chosen")
    )
    result = placed.join(classes, "root").select(
        "row_key", "doc_id", "class_id", "n_links", (F.col("row_key") == F.col("chosen.row_key")).alias("chosen")
    )
    if not keep:
        return result.drop("row_key")
    others = df.select(F.monotonically_increasing_id().alias("row_key"), *(df[c].alias(f"keep_{c}") for c in keep))
    return others.join(result, "row_key").select(
        "doc_id", *(F.col(f"keep_{c}").alias(c) for c in keep), "class_id", "n_links", "chosen"
    )

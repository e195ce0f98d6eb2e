"""Benchmark decontamination by winnowing, in DataFrame functions only.

Texts become arrays of 64-bit word hashes. Of every window of consecutive k-gram hashes the
smallest is kept, so any two texts that share `span` consecutive words share a kept hash
(guarantee: window + k - 1 = span). Kept hashes of documents and items are joined; each hit is
extended along its diagonal, and the stretches of at least `span` equal words are the shared ones.
An item of fewer words than `span` is one window itself: for each such length (at most span - 1)
the hash of that many words is looked up as well.

The fingerprints of the benchmark are counted first. Up to BROADCAST_ROWS they are broadcast and a
document's words travel with the join, within one stage. Beyond, fingerprints are joined by a
shuffle of (document, hash) alone, and words are joined to the hits afterwards.

Defined results: null and empty texts have no words and no hit; equal rows are judged each; an
item whose text is null or has no words never occurs; items with one id count once; an empty
benchmark contaminates nothing; columns other than id and text are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import ascii_lower, keyed

#: Words of a window of the benchmark.
SPAN = 13
#: Words of a hashed k-gram.
GRAM = 5
#: Fingerprints of the benchmark (with their item's words) that are broadcast at most.
BROADCAST_ROWS = 20_000

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_hashes(text: Column) -> Column:
    """Hash of each word; a text without a word gives an empty array."""
    parts = F.filter(F.split(ascii_lower(text), _NOT_WORD), lambda w: w != "")
    return F.transform(parts, lambda w: F.xxhash64(w))


def _shifted(values: str, step: int, both) -> Column:
    """both(values[i], values[i + step]) for each i at which the second exists."""
    last = F.size(values) - step
    return F.when(
        last > 0,
        F.transform(
            F.slice(values, F.lit(1), F.greatest(last, F.lit(0))),
            lambda x, i: both(x, F.get(F.col(values), i + step)),
        ),
    ).otherwise(F.array().cast("array<long>"))


def _sliding(df: DataFrame, source: str, width: int, both, name: str) -> DataFrame:
    """Column `name`: `source` combined over every `width` neighbours, by doubling."""
    df, have, at = df.withColumn("_0", F.col(source)), 1, source
    while have < width:
        step = min(have, width - have)
        # the two halves may overlap only if the order and repetition do not matter; see the callers
        df = df.withColumn(f"_{have + step}", _shifted(at, step, both))
        have, at = have + step, f"_{have + step}"
    return df.withColumn(name, F.col(at)).drop(*[c for c in df.columns if c.startswith("_")])


def _hash_pair(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _grams(df: DataFrame, k: int, name: str) -> DataFrame:
    """Hash of each k consecutive words. Halves may overlap: both sides are hashed the same way."""
    return _sliding(df, "wh", k, _hash_pair, name)


def fingerprints(df: DataFrame, span: int = SPAN, k: int = GRAM) -> DataFrame:
    """Adds grams (hash of each k words) and kept (the distinct window minima)."""
    df = _grams(df, k, "grams")
    df = _sliding(df, "grams", span - k + 1, F.least, "minima")
    return df.withColumn("kept", F.array_distinct("minima")).drop("minima")


def _items(benchmark: DataFrame, id_col: str, text_col: str, span: int) -> DataFrame:
    items = benchmark.select(
        benchmark[id_col].alias("item_id"), word_hashes(F.coalesce(benchmark[text_col], F.lit(""))).alias("wh")
    )
    return items.where(F.size("wh") > 0)


def _matched(hits: DataFrame, span: int) -> DataFrame:
    """Stretches of equal words of each hit: hits have dw, iw (word hashes), p and q (where a k-gram is equal)."""
    low = F.least("p", "q")
    n = F.least(F.size("dw") - F.col("p"), F.size("iw") - F.col("q")) + low
    diagonal = hits.withColumn("d0", F.col("p") - low).withColumn("i0", F.col("q") - low).withColumn("n", n)
    # numbers of the unequal words on the diagonal, with a wall at each end
    unequal = F.filter(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda j: F.get("dw", (F.col("d0") + j).cast("int")) != F.get("iw", (F.col("i0") + j).cast("int")),
    )
    walls = diagonal.withColumn(
        "walls", F.concat(F.array(F.lit(-1).cast("long")), unequal.cast("array<long>"), F.array(F.col("n").cast("long")))
    )
    spans = F.filter(
        F.transform(
            F.slice("walls", F.lit(1), F.size("walls") - 1),
            lambda w, i: F.struct(
                (F.col("d0") + w + 1).cast("long").alias("s"),
                (F.col("d0") + F.get("walls", i + 1)).cast("long").alias("e"),
            ),
        ),
        lambda x: x["e"] - x["s"] >= F.least(F.lit(span), F.size("iw")),
    )
    return walls.withColumn("spans", spans)


def _places(array: str, value: Column) -> Column:
    """Numbers of the elements equal to a value."""
    return F.filter(
        F.sequence(F.lit(0), F.size(array) - 1), lambda i: F.get(F.col(array), i.cast("int")) == value
    )


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    span: int = SPAN,
    k: int = GRAM,
    broadcast_rows: int = BROADCAST_ROWS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: doc_id, n_words, spans (disjoint, sorted, of hit words) and item_ids.

    keep: columns of the documents that are carried along.
    """
    if not 0 < k <= span:
        raise ValueError("k must be from 1 to span")
    items = _items(benchmark, item_id_col, item_text_col, span)
    short = [r["m"] for r in items.where(F.size("wh") < span).select(F.size("wh").alias("m")).distinct().collect()]
    long_items = fingerprints(items.where(F.size("wh") >= span), span, k)
    known = long_items.select("item_id", F.col("wh").alias("iw"), F.explode_outer("kept").alias("h"), "grams").select(
        "item_id", "iw", "h", F.explode_outer(_places("grams", F.col("h"))).alias("q"), F.lit(k).alias("width")
    )
    for m in sorted(short):  # fewer than span, whatever the benchmark
        one = _grams(items.where(F.size("wh") == m), m, "g")
        known = known.unionByName(
            one.select(
                "item_id", F.col("wh").alias("iw"), F.get("g", F.lit(0)).alias("h"),
                F.lit(0).cast(known.schema["q"].dataType).alias("q"), F.lit(m).alias("width"),
            )
        )
    # the outer forms of explode keep the optimiser from pushing "not empty" through all the steps above
    known = known.withColumnRenamed("h", "ih").withColumnRenamed("width", "iwidth")

    docs = df.select(
        F.monotonically_increasing_id().alias("row_key"),
        df[id_col].alias("doc_id"),
        *(df[c].alias(f"keep_{c}") for c in keep),
        word_hashes(F.coalesce(df[text_col], F.lit(""))).alias("dw"),
    )
    small = known.limit(broadcast_rows + 1).count() <= broadcast_rows
    if not small:
        docs = docs.checkpoint()  # both joins below must see the same keys
    prints = fingerprints(docs.withColumnRenamed("dw", "wh"), span, k).withColumnRenamed("wh", "dw")
    widths = _with_width(F.col("kept"), k)
    for m in sorted(short):
        prints = _grams(prints.withColumnRenamed("dw", "wh"), m, "g").withColumnRenamed("wh", "dw")
        prints = prints.withColumn("_more", _with_width(F.array_distinct("g"), m))
        widths = F.concat(widths, F.col("_more"))
        prints = prints.withColumn("widths", widths).drop("_more", "g")
        widths = F.col("widths")
    head = F.array(F.struct(F.lit(None).cast("long").alias("h"), F.lit(0).alias("width")))
    prints = prints.withColumn("prints", F.concat(head, widths)).drop("widths", "kept")

    carried = ["doc_id", *(f"keep_{c}" for c in keep)]
    same = (F.col("h") == F.col("ih")) & (F.col("width") == F.col("iwidth"))
    if small:
        each = prints.select(
            "row_key", *carried, F.size("dw").cast("long").alias("n_words"), "dw", F.inline_outer("prints")
        )
        hits = each.join(F.broadcast(known), same, "left").where(F.col("h").isNull() | F.col("item_id").isNotNull())
    else:
        each = prints.select("row_key", F.inline_outer("prints")).where("h is not null")
        found = each.join(known, same)
        heads = docs.select("row_key", *carried, F.size("dw").cast("long").alias("n_words"), "dw")
        hits = heads.join(found, "row_key", "left")
    # all places of the k-gram in the document; the head row has none
    gram = F.when(F.col("item_id").isNotNull(), _hits_in("dw", "iw", "q", "width"))
    hits = hits.withColumn("ps", gram)
    placed = hits.select(
        "row_key", *carried, "n_words", "item_id", "dw", "iw", "q", F.explode_outer("ps").alias("p")
    )
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    spans = _matched(placed, span).select(
        "row_key", *carried, "n_words", "item_id",
        F.when(F.col("p").isNotNull(), F.col("spans")).otherwise(none).alias("spans"),
    )
    found_item = F.when(F.size("spans") > 0, F.col("item_id"))
    per_doc = spans.groupBy("row_key").agg(
        *(F.first(c, ignorenulls=True).alias(c) for c in carried),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"),
        F.collect_set(found_item).alias("item_ids"),
    )
    result = per_doc.withColumn("spans", union_of("spans"))
    return result.select("doc_id", *(F.col(f"keep_{c}").alias(c) for c in keep), "n_words", "spans", "item_ids")


def _with_width(hashes: Column, width: int) -> Column:
    return F.transform(hashes, lambda h: F.struct(h.alias("h"), F.lit(width).alias("width")))


def _hits_in(doc: str, item: str, q: str, width: str) -> Column:
    """Numbers of the document's words at which the item's words q ... q + width - 1 stand."""
    n = F.size(doc) - F.col(width) + 1
    return F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (F.get(F.col(doc), i.cast("int")) == F.get(F.col(item), F.col(q).cast("int")))
        & (
            F.slice(F.col(doc), (i + 1).cast("int"), F.col(width))
            == F.slice(F.col(item), (F.col(q) + 1).cast("int"), F.col(width))
        ),
    )


def union_of(spans: str) -> Column:
    """Sorted spans with those that overlap or touch made one."""
    kind = "array<struct<s:bigint,e:bigint>>"
    return F.aggregate(
        spans,
        F.array().cast(kind),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["e"] >= x["s"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["s"].alias("s"),
                        F.greatest(F.element_at(done, -1)["e"], x["e"]).alias("e"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(x["s"].alias("s"), x["e"].alias("e"))))),
    )


def n_hit() -> Column:
    """Hit words of a row of `decontaminate`."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])


def contaminated() -> Column:
    """Whether hit words are at least a twentieth of all words."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns, and those carried along."""
    ids = F.array_sort(F.transform("item_ids", lambda x: x.cast("string")))
    return (
        found.withColumn("n_hit", n_hit())
        .withColumn("n_items", F.size("item_ids").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join(ids, ","), 256))
        .withColumn("contaminated", contaminated())
        .drop("spans", "item_ids")
    )

"""License scan by diagonal voting.

Templates are short license references, notices and the openings of license texts. All rolling
word k-grams of all texts are joined with the positions at which templates hold the same k-gram.
A hit at word p of the text and word q of the template votes for diagonal p - q. Votes are
gathered by text, template and diagonal; diagonals at most `gap` apart, which words added or left
out produce, are merged; a merged span is verified: enough of the template's words must be covered, and
all k-grams that tell the template from a similar one with another label (CC BY from CC BY-NC, one
version of the GPL from another) must be hit.
K-grams are compared by two independent 64-bit hashes: the first finds, the second verifies.

A template that must stand word for word (a phrase) counts on each diagonal with all votes.

The templates are a fixed table of a few thousand k-grams, so that side of the join is broadcast.
Only hits are shuffled, by text.

Defined results: null text has no words and no labels; equal rows are judged each; an empty table
gives an empty result; columns other than id and text are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import Chunk, chunks, gram_hash, keyed, signed, split_words, whole_grams

K = 3
_SECOND = 0xE7037ED1A0B428DB

# The phrases and their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Openings of public license texts and usual notices.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    (
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    (
        "cc-by-sa",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    (
        "cc-by-nd",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    ),
    (
        "cc-by-nc-sa",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    ),
    (
        "cc-by-nc-nd",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    ),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2"),
    (
        "gpl-2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License",
    ),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
)


@dataclass(frozen=True)
class Scan:
    """Parameters: gap between diagonals that are merged, covered share of a template that is needed."""

    gap: int = 3
    coverage: float = 0.8


def _word_grams(text: str, k: int) -> tuple[int, np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), np.uint8)
    words = split_words(Chunk(0, 1, data, np.array([0, len(data)])))
    return len(words.start), gram_hash(words.hash, k), gram_hash(words.hash, k, _SECOND)


def telling_grams(templates: list[tuple[str, int, list]]) -> list[list[int]]:
    """For each (label, size, k-grams) the k-grams that a similar template of another label lacks.

    Similar: that template's k-grams cover half of this one's words.
    """
    out = []
    for label, size, grams in templates:
        needs: set[int] = set()
        for other, _, theirs in templates:
            if other == label:
                continue
            shared = [q for q, g in enumerate(grams) if g in set(theirs)]
            if 2 * len({w for q in shared for w in range(q, q + K)}) >= size:
                needs |= set(range(len(grams))) - set(shared)
        out.append(sorted(needs))
    return out


def template_grams(spark, phrases, templates) -> DataFrame:
    """(h1, h2, template, label, exact, size, q, needs): a row for each k-gram of each template."""
    known = []
    for label, text in [*phrases, *templates]:
        size, h1, h2 = _word_grams(text, K)
        if size < K:
            raise ValueError(f"a template needs {K} words: {text!r}")
        known.append((label, size, list(zip(h1.view(np.int64).tolist(), h2.view(np.int64).tolist(), strict=True))))
    needs = [[]] * len(phrases) + telling_grams(known[len(phrases) :])
    rows = [
        (*gram, number, label, int(number < len(phrases)), size, q, needs[number])
        for number, (label, size, grams) in enumerate(known)
        for q, gram in enumerate(grams)
    ]
    kinds = "h1 long, h2 long, template int, label string, exact int, size int, q int, needs array<int>"
    return spark.createDataFrame(rows, kinds)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text a row with its number of words, then one for each k-gram."""
    for batch in batches:
        keys, ids = batch.column("row_key").to_numpy(), batch.column("doc_id")
        for chunk in chunks(batch.column("text")):
            words = split_words(chunk)
            n, rows = chunk.last - chunk.first, np.arange(chunk.first, chunk.last)
            at = whole_grams(words, K)
            doc = words.doc[at]
            place = np.concatenate((np.full(n, -1), at - words.bounds[doc]))
            row = np.concatenate((rows, chunk.first + doc))
            head = np.arange(len(row)) < n
            n_words = np.concatenate((np.diff(words.bounds), np.zeros(len(at), np.int64)))
            first = np.concatenate((np.zeros(n, np.uint64), gram_hash(words.hash, K)[at]))
            second = np.concatenate((np.zeros(n, np.uint64), gram_hash(words.hash, K, _SECOND)[at]))
            # ids only where they are needed: on the head row of each text
            take = pa.array(row, mask=~head)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[row]), ids.take(take), pa.array(place), pa.array(n_words), signed(first), signed(second)],
                ["row_key", "doc_id", "p", "n_words", "h1", "h2"],
            )


def scan(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases=PHRASES,
    templates=TEMPLATES,
    settings: Scan = Scan(),  # noqa: B008
) -> DataFrame:
    """One row per text: doc_id, n_words, spans of phrases and of templates.

    phrase_spans: array of (start, label), in order. template_spans: array of (start, end, label,
    coverage), words from 0, end exclusive.
    """
    docs = keyed(df, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    grams = docs.mapInArrow(_grams, f"row_key long, doc_id {kind}, p long, n_words long, h1 long, h2 long")
    known = F.broadcast(template_grams(df.sparkSession, phrases, templates))
    head = F.col("p") == -1
    hits = grams.join(known, (~head) & (grams.h1 == known.h1) & (grams.h2 == known.h2), "left").select(
        "row_key", "doc_id", "p", "n_words", "template", "label", "exact", "size", "q", "needs"
    )
    hits = hits.where(head | F.col("template").isNotNull())
    # votes by diagonal; the head row of each text is kept as one with no template
    votes = hits.groupBy("row_key", "template", (F.col("p") - F.col("q")).alias("diagonal")).agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.first("label").alias("label"),
        F.first("exact").alias("exact"),
        F.first("size").alias("size"),
        F.first("needs").alias("needs"),
        F.collect_set("q").alias("qs"),
    )
    by_template = Window.partitionBy("row_key", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_template) > settings.gap
    votes = votes.withColumn("cluster", F.sum(F.when(apart, 1).otherwise(0)).over(by_template))
    merged = votes.groupBy("row_key", "template", "cluster").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.first("label").alias("label"),
        F.first("exact").alias("exact"),
        F.first("size").alias("size"),
        F.first("needs").alias("needs"),
        F.min("diagonal").alias("low"),
        F.collect_list(F.struct("diagonal", F.size("qs").alias("n"))).alias("diagonals"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("qs")))).alias("qs"),
        F.max(F.col("diagonal") + F.array_max("qs") + K).alias("end"),
        F.min(F.col("diagonal") + F.array_min("qs")).alias("start"),
    )
    # words of the template under a k-gram that votes: k for the first, then the step up to k
    covered = F.aggregate(
        "qs",
        F.struct(F.lit(0).alias("n"), F.lit(-K).alias("at")),
        lambda a, q: F.struct(
            (a["n"] + F.least(q - a["at"], F.lit(K))).cast("int").alias("n"), q.cast("int").alias("at")
        ),
        lambda a: a["n"],
    )
    merged = merged.withColumn("coverage", covered / F.col("size"))
    full = F.filter("diagonals", lambda d: d["n"] == F.col("size") - (K - 1))
    phrase_spans = F.when(
        F.col("exact") == 1,
        F.transform(full, lambda d: F.struct(d["diagonal"].alias("start"), F.col("label").alias("label"))),
    )
    template_span = F.when(
        (F.col("exact") == 0)
        & (F.col("coverage") >= settings.coverage)
        & (F.size(F.array_except("needs", "qs")) == 0),
        F.struct("start", "end", "label", "coverage"),
    )
    return merged.groupBy("row_key").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list(phrase_spans))).alias("phrase_spans"),
        F.array_sort(F.collect_list(template_span)).alias("template_spans"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of a scan."""
    base = F.array_sort(F.array_distinct(F.col("phrase_spans.label")))
    both = F.array_sort(F.array_distinct(F.concat(F.col("phrase_spans.label"), F.col("template_spans.label"))))
    best = F.greatest(
        F.when(F.size("phrase_spans") > 0, F.lit(1.0)).otherwise(F.lit(0.0)),
        F.coalesce(F.array_max(F.col("template_spans.coverage")), F.lit(0.0)),
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrase_spans").cast("long").alias("n_base"),
        F.array_min(F.col("phrase_spans.start")).alias("first_word"),
        F.array_max(F.col("phrase_spans.start")).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        best.cast("double").alias("score"),
    )

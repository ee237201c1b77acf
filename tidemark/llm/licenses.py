"""License scan: an exact set-similarity join of text blocks with license templates, beside exact phrases.

A template of m distinct words has a class, the smallest power of two s not below its number of words. The blocks of that class are the
windows of 2s words that start at every s-th word of a text, so a passage of up to s words lies whole within one. A block matches a
template if it holds at least ``threshold`` of the template's distinct words (containment), and every such block is found:

- The words of all templates are put in order of the number of documents of the whole corpus that hold them, rare ones first.
- Prefix filter: with ``need`` = ceil(threshold * m), a match shares one of the first m - need + 1 template words with one of the first
  |B| - need + 1 block words, B being the block's words that any template has. A block without such a word leaves no row.
- Length filter: |B| >= need. Position filter: where the words at places i and j are the first shared ones (from 0), no more than
  min(m - i, |B| - j) can be shared.
- What passes is joined on (class, word), once per block and template, and checked on whole sets.

Templates are a list of at most ``MOST_BYTES`` on the driver; the join of their prefixes is left to Spark's size threshold. Words are
those of ``decontaminate.words_of``.

Defined results: null and empty texts have no words; a row is told by key and text, so rows that repeat both have equal results and a null
key keeps its rows; a template without words matches nothing; an empty list of templates or phrases adds nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import text_bytes, worker_cache
from .decontaminate import words_of

MOST_BYTES = 4 << 20

#: Notices in common use, with the label that a match gives.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
            " the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


def need_of(words: int, threshold: float) -> int:
    """Shared words that a template of so many distinct words asks for."""
    return max(1, math.ceil(round(threshold * words, 9)))


def class_of(words: int) -> int:
    return 1 << max(words - 1, 0).bit_length()


def _document_counts(docs: DataFrame, vocabulary: set[bytes], key: str, text: str) -> dict[bytes, int]:
    """In how many documents each template word occurs."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("licenses")
        found: dict[bytes, int] = {}
        for batch in batches:
            for body in batch.column(1).to_pylist():
                for word in vocabulary.intersection(words_of(body)):
                    found[word] = found.get(word, 0) + 1
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "times"])

    rows = text_bytes(docs, key, text).mapInArrow(counted, "word binary, times long").groupBy("word").agg(F.sum("times").alias("times")).collect()
    return {bytes(row["word"]): row["times"] for row in rows}


def places_of(words: list[bytes], phrases: list[list[bytes]]) -> list[tuple[int, int]]:
    """(phrase, start) of every place where a phrase's words stand consecutively."""
    joined = b" " + b" ".join(words) + b" "
    found = []
    for number, phrase in enumerate(phrases):
        said = b" " + b" ".join(phrase) + b" "
        at = joined.find(said)
        while at >= 0 and phrase:
            found.append((number, joined.count(b" ", 0, at)))
            at = joined.find(said, at + 1)
    return sorted(found, key=lambda p: (p[1], p[0]))


def _candidates(words: list[bytes], rank: dict[bytes, int], heads: dict[int, tuple[set[bytes], int]]) -> list[tuple[int, int, list[int]]]:
    """(class, start, ranks of B) of the blocks that hold a word of some template's prefix and enough template words."""
    found = []
    for size, (prefix, least) in heads.items():
        if prefix.isdisjoint(words):
            continue
        ranks = np.array([rank.get(w, -1) for w in words], np.int64)
        last = (len(words) - 1) // size
        hit = np.array([i for i, w in enumerate(words) if w in prefix]) // size
        for block in np.unique(np.concatenate((hit, hit - 1))).tolist():
            if 0 <= block <= last:
                held = np.unique(ranks[block * size:block * size + 2 * size])
                held = held[held >= 0]
                if held.size >= least:
                    found.append((size, block * size, held.tolist()))
    return found


def license_matches(docs: DataFrame, phrases: dict[str, str], templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, places, blocks) per row.

    ``places`` are the (label, start) where a phrase's words stand consecutively, ``blocks`` the (label, template, start, words, containment)
    of the blocks that match a template, its number being that in the list; both by start.
    """
    spark = docs.sparkSession
    if sum(len(said) for _, said in templates) > MOST_BYTES:
        raise ValueError(f"templates of more than {MOST_BYTES} characters")
    said = [words_of(phrase.encode()) for phrase in phrases]
    named = list(phrases.values())
    cut = [(number, label, words_of(body.encode())) for number, (label, body) in enumerate(templates)]
    cut = [t for t in cut if t[2]]
    times = _document_counts(docs, {w for _, _, words in cut for w in words}, key, text) if cut else {}
    rank = {w: i for i, w in enumerate(sorted({w for _, _, words in cut for w in words}, key=lambda w: (times.get(w, 0), w)))}
    sets = [(number, label, class_of(len(words)), sorted({rank[w] for w in words})) for number, label, words in cut]
    word_at = sorted(rank, key=rank.get)
    heads: dict[int, tuple[set[bytes], int]] = {}
    for _, _, size, ranks in sets:
        need = need_of(len(ranks), threshold)
        prefix, least = heads.get(size, (set(), need))
        heads[size] = (prefix | {word_at[r] for r in ranks[:len(ranks) - need + 1]}, min(least, need))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("licenses")
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            words = [words_of(body) for body in bodies]
            places = [[{"label": named[number], "start": start} for number, start in places_of(ws, said)] for ws in words]
            blocks = [[{"size": size, "start": start, "held": held} for size, start, held in _candidates(ws, rank, heads)] for ws in words]
            yield pa.RecordBatch.from_pandas(pd.DataFrame({
                "digest": np.array([xxhash.xxh64_intdigest(body, 42) for body in bodies], np.uint64).view(np.int64),
                "n_words": np.array([len(ws) for ws in words], np.int64)}), preserve_index=False).add_column(0, "doc_id", batch.column(0)).append_column(
                "places", pa.array(places, pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())])))).append_column(
                "cuts", pa.array(blocks, pa.list_(pa.struct([("size", pa.int64()), ("start", pa.int64()), ("held", pa.list_(pa.int32()))]))))

    kind = docs.schema[key].dataType.simpleString()
    rows = cut_lineage(text_bytes(docs, key, text).mapInArrow(
        scanned, f"doc_id {kind}, digest long, n_words long, places array<struct<label:string,start:long>>, "
                 "cuts array<struct<size:long,start:long,held:array<int>>>"))

    theirs = spark.createDataFrame(
        [(number, label, size, ranks, need_of(len(ranks), threshold)) for number, label, size, ranks in sets],
        "template int, label string, size long, ranks array<int>, need int")
    prefixes = theirs.select("template", "label", "size", "ranks", "need", F.posexplode(F.slice("ranks", F.lit(1), F.size("ranks") - F.col("need") + 1)).alias("i", "word"))
    cuts = rows.where(F.size("cuts") > 0).select("doc_id", "digest", F.explode("cuts").alias("cut")).select("doc_id", "digest", "cut.*").distinct()
    words = cuts.select("doc_id", "digest", "size", "start", "held", F.posexplode("held").alias("j", "word"))
    possible = words.join(prefixes, ["size", "word"]).where(
        (F.size("held") >= F.col("need")) & (F.col("j") <= F.size("held") - F.col("need"))
        & (F.least(F.size("ranks") - F.col("i"), F.size("held") - F.col("j")) >= F.col("need")))
    pairs = possible.select("doc_id", "digest", "start", "template", "label", "ranks", "need", "held").distinct()
    shared = F.size(F.array_intersect("held", "ranks"))
    near = pairs.withColumn("shared", shared).where(F.col("shared") >= F.col("need"))
    blocks = near.groupBy(F.col("doc_id").alias("their_id"), F.col("digest").alias("their_digest")).agg(F.sort_array(F.collect_list(F.struct(
        "start", "template", "label", F.col("shared").alias("words"), (F.col("shared") / F.size("ranks")).alias("containment")))).alias("blocks"))
    joined = rows.drop("cuts").join(blocks, F.col("doc_id").eqNullSafe(F.col("their_id")) & (F.col("digest") == F.col("their_digest")), "left")
    none = F.array().cast(blocks.schema["blocks"].dataType)
    return joined.select(F.col("doc_id").alias(key), "n_words", "places", F.coalesce("blocks", none).alias("blocks"))

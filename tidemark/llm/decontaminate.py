"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` reads the corpus once and stores the positions of the terms that the test items use. A token is
stored only where a test window could lie around it: among some ``size + slop`` consecutive tokens there are ``size``
test terms, and with no slop every two adjacent ones are adjacent in some test window as well. The filters are bitmaps
of hashes of fixed size, so their false positives only store a little more.
``exact_hits`` starts from the rarest term of each window, subtracts offsets to get (document, shift) candidates, and
meets the other terms of the window on exact position; ``proximity_hits`` lets every term be up to ``slop`` words away
from its place.

Defined results: null and empty texts have no words; an item without words has no window; an item of fewer words than
``size`` is one window; items count by their id, under which each text has windows of its own; repeated
document rows are separate rows of the index; an item without an id has windows like any other and counts as one item, which has no name to list. Columns other than key and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import Memo, text_bytes, worker_cache

#: Bits of a term bitmap (2 MB), whatever the size of the benchmark.
BITMAP_BITS = 1 << 24

#: Fixed rule: digits, a-z and everything above ASCII are word characters; A-Z become a-z; all else separates words.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words_of(body: bytes) -> list[bytes]:
    """Words of a UTF-8 text, in order."""
    return body.translate(_FOLD).split()


def item_windows(items: DataFrame, size: int = 13, key: str = "item_id") -> DataFrame:
    """(item, item_id, first, length, term, place): the terms of every window of every item.

    ``item`` numbers the distinct (item_id, text) rows, so that two texts under one id keep their windows
    apart; ``first`` is the window's place in its item, ``place`` the term's.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(body) for body in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.binary()))], ["item_id", "words"])

    kind = items.schema[key].dataType.simpleString()
    words = (text_bytes(items, key).dropDuplicates()
             .mapInArrow(split, f"item_id {kind}, words array<binary>").where(F.size("words") > 0)
             .withColumn("item", F.monotonically_increasing_id()))
    length = F.least(F.size("words"), F.lit(size))
    starts = words.select("item", "item_id", "words", length.alias("length"),
                          F.explode(F.sequence(F.lit(0), F.size("words") - length)).alias("first"))
    return starts.select("item", "item_id", "first", "length", F.posexplode(F.slice("words", F.col("first") + 1, F.col("length")))
                         .alias("offset", "term")).select("item", "item_id", "first", "length", "term", (F.col("first") + F.col("offset")).alias("place"))


def _bitmaps(windows: DataFrame, size: int, value: str) -> dict[bool, tuple[int, bytes]]:
    """(least window length, bitmap of the hashes of ``value``) for whole windows (False) and for short items (True)."""
    # Spark numbers the bits of a bitmap, and the bitmaps, from 1.
    hashed = (windows.where(F.col(value).isNotNull())
              .select((F.col("length") < size).alias("short"), "length", (F.xxhash64(value).bitwiseAND(BITMAP_BITS - 1) + 1).alias("bit"))
              .withColumn("bucket", F.bitmap_bucket_number("bit")))
    rows = (hashed.groupBy("short", "bucket")
            .agg(F.min("length").alias("length"), F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    found: dict[bool, tuple[int, bytearray]] = {}
    for row in rows:
        length, bits = found.get(row["short"], (size, bytearray(BITMAP_BITS // 8)))
        at = (row["bucket"] - 1) * len(row["bits"])
        bits[at:at + len(row["bits"])] = row["bits"]
        found[row["short"]] = (min(length, row["length"]), bits)
    return {short: (length, bytes(bits)) for short, (length, bits) in found.items()}


def _filters(windows: DataFrame, size: int) -> list[tuple[int, bytes, bytes]]:
    """Per class of windows: least length, bitmap of terms, bitmap of adjacent terms."""
    following = F.lead("term").over(Window.partitionBy("item", "first").orderBy("place"))
    terms = _bitmaps(windows, size, "term")
    pairs = _bitmaps(windows.withColumn("pair", F.concat("term", F.lit(b" "), following)), size, "pair")
    return [(length, bits, pairs.get(short, (0, bytes(BITMAP_BITS // 8)))[1]) for short, (length, bits) in terms.items()]


def _member(bits: np.ndarray, value: bytes) -> bool:
    bit = xxhash.xxh64_intdigest(value, 42) & (BITMAP_BITS - 1)
    return bool(bits[bit >> 3] >> (bit & 7) & 1)


def _possible(member: np.ndarray, length: int, slop: int) -> np.ndarray:
    """Which members lie in some ``length + slop`` consecutive tokens of which at least ``length`` are members."""
    total = member.size
    if total == 0:
        return member
    span = min(length + slop, total)
    sums = np.concatenate(([0], np.cumsum(member)))
    good = (sums[span:] - sums[:-span]) >= min(length, total)
    if total < length:
        return np.zeros(total, bool)
    cover = np.zeros(total + 1, np.int64)
    starts = np.flatnonzero(good)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + span, -1)
    return member & (np.cumsum(cover[:-1]) > 0)


@dataclass
class PositionalIndex:
    """``docs``: (doc, doc_id, digest, n_words) with the XXH64 of the text; ``postings``: (term, doc, pos); ``windows``: the test side."""

    docs: DataFrame
    postings: DataFrame
    windows: DataFrame


def build_index(docs: DataFrame, items: DataFrame, size: int = 13, slop: int = 0, key: str = "doc_id", item_key: str = "item_id") -> PositionalIndex:
    """One pass over the corpus; the stored index grows with what the corpus shares with the test terms."""
    windows = cut_lineage(item_windows(items, size, item_key))
    filters = _filters(windows, size)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("decontaminate")
        classes = [(length, *(np.frombuffer(bits, np.uint8) for bits in both)) for length, *both in filters]
        # Bit i of a word's or a pair's kind says whether class i has it.
        kind_of = Memo(lambda word: sum(_member(terms, word) << i for i, (_, terms, _) in enumerate(classes))).__getitem__
        pair_kind = Memo(lambda pair: sum(_member(pairs, pair) << i for i, (_, _, pairs) in enumerate(classes)), limit=100_000).__getitem__

        def stored(words: list[bytes]) -> np.ndarray:
            keep = np.zeros(len(words), bool)
            if not classes:
                return keep
            kind = np.fromiter(map(kind_of, words), np.uint8, len(words))
            for i, (length, _, _) in enumerate(classes):
                good = _possible((kind >> i & 1).astype(bool), length, slop)
                if slop == 0 and length > 1 and good.any():
                    linked = np.zeros(len(words) - 1, bool)
                    near = np.flatnonzero(good[:-1] & good[1:])
                    linked[near] = [pair_kind(words[j] + b" " + words[j + 1]) >> i & 1 for j in near.tolist()]
                    linked = _possible(linked, length - 1, 0)
                    good = np.append(linked, False) | np.insert(linked, 0, False)
                keep |= good
            return keep

        for batch in batches:
            counts, digests, terms, places = [], [], [], []
            for body in batch.column(1).to_pylist():
                words = words_of(body)
                counts.append(len(words))
                digests.append(xxhash.xxh64_intdigest(body, 42))
                keep = stored(words)
                at = np.flatnonzero(keep).tolist()
                places.append(at)
                terms.append([words[i] for i in at])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(counts, pa.int64()), pa.array(terms, pa.list_(pa.binary())), pa.array(places, pa.list_(pa.int32()))],
                ["doc_id", "digest", "n_words", "terms", "places"])

    kind = docs.schema[key].dataType.simpleString()
    stored = cut_lineage(text_bytes(docs, key).mapInArrow(post, f"doc_id {kind}, digest long, n_words long, terms array<binary>, places array<int>")
                         .withColumn("doc", F.monotonically_increasing_id()))
    postings = (stored.where(F.size("places") > 0).select("doc", F.explode(F.arrays_zip("terms", "places")).alias("p"))
                .select("doc", F.col("p.terms").alias("term"), F.col("p.places").alias("pos")))
    return PositionalIndex(stored.select("doc", "doc_id", "digest", "n_words"), postings, windows)


def _rarest_first(index: PositionalIndex) -> DataFrame:
    """Windows whose terms all occur, with ``turn`` 1 for the rarest term of each; ties go to the earlier place."""
    often = index.postings.groupBy("term").agg(F.count(F.lit(1)).alias("often"))
    known = index.windows.join(often, "term")
    window = Window.partitionBy("item", "first")
    return (known.withColumn("present", F.count(F.lit(1)).over(window)).where(F.col("present") == F.col("length"))
            .withColumn("turn", F.row_number().over(window.orderBy("often", "place"))))


def exact_hits(index: PositionalIndex) -> DataFrame:
    """(item_id, doc, first, length, start): every exact occurrence of a window, ``start`` the place of its first word.

    The lists of the two rarest terms of a window are intersected first; what survives meets the remaining terms.
    """
    terms = cut_lineage(_rarest_first(index))
    lead = terms.where(F.col("turn") == 1).select("item", "item_id", "first", "length", "term", "place")
    found = (lead.join(index.postings, "term").select("item", "item_id", "first", "length", "doc", (F.col("pos") - F.col("place")).alias("shift")))
    second = terms.where(F.col("turn") == 2).select("item", "first", "term", "place")
    paired = (found.where(F.col("length") > 1).join(second, ["item", "first"])
              .withColumn("pos", F.col("shift") + F.col("place")).join(index.postings, ["term", "doc", "pos"], "left_semi"))
    found = paired.select(*found.columns).unionAll(found.where(F.col("length") == 1))
    # Windows of one alignment overlap; their words are met once, as (item, document, shift, place).
    alignments = found.groupBy("item", "doc", "shift").agg(F.min("first").alias("low"), F.max(F.col("first") + F.col("length")).alias("high"))
    words = index.windows.select("item", "place", "term").distinct()
    met = (alignments.join(words, "item").where((F.col("place") >= F.col("low")) & (F.col("place") < F.col("high")))
           .select("item", "doc", "shift", "place", "term", (F.col("place") + F.col("shift")).alias("pos"))
           .join(index.postings, ["term", "doc", "pos"], "left_semi"))
    # Runs of met places: a window occurs where its whole length lies in one run.
    line = Window.partitionBy("item", "doc", "shift").orderBy("place")
    runs = (met.withColumn("run", F.col("place") - F.row_number().over(line))
            .groupBy("item", "doc", "shift", "run").agg(F.min("place").alias("from"), (F.max("place") + 1).alias("to")))
    return (found.distinct().join(runs, ["item", "doc", "shift"])
            .where((F.col("first") >= F.col("from")) & (F.col("first") + F.col("length") <= F.col("to")))
            .select("item_id", "doc", "first", "length", (F.col("first") + F.col("shift")).alias("start")))


def proximity_hits(index: PositionalIndex, slop: int) -> DataFrame:
    """(item_id, doc, first, length, start): windows whose terms all lie within ``slop`` words of their place around the rarest one.

    The index must have been built with at least twice this slop.
    """
    terms = cut_lineage(_rarest_first(index))
    lead = (terms.where(F.col("turn") == 1).join(index.postings, "term")
            .select("item", "item_id", "first", "length", "doc", (F.col("pos") - F.col("place")).alias("shift")))
    others = terms.select("item", "first", "term", "place")
    near = (lead.join(others, ["item", "first"]).join(index.postings, ["term", "doc"])
            .where(F.abs(F.col("pos") - F.col("place") - F.col("shift")) <= slop))
    return (near.select("item", "item_id", "first", "length", "doc", "shift", "place").distinct()
            .groupBy("item", "item_id", "doc", "first", "length", "shift").agg(F.count(F.lit(1)).alias("met"))
            .where(F.col("met") == F.col("length"))
            .select("item_id", "doc", "first", "length", (F.col("first") + F.col("shift")).alias("start")))


def contamination(index: PositionalIndex, hits: DataFrame, share: int = 20) -> DataFrame:
    """(doc_id, digest, n_words, n_hit, n_items, items, contaminated): words of each document inside any hit, and the items met."""
    hits = cut_lineage(hits)
    covered = (hits.groupBy("doc", "start").agg(F.max("length").alias("length"))
               .select("doc", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("pos"))
               .distinct().groupBy("doc").agg(F.count(F.lit(1)).alias("n_hit")))
    items = (hits.select("doc", F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy("doc").agg(F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list("item")).alias("items")))
    joined = index.docs.join(covered, "doc", "left").join(items, "doc", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select("doc_id", "digest", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                         ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))

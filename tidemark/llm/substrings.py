"""Removal of passages that repeat across documents, behind a count-min prefilter.

A window is ``size`` consecutive words. Every window holds a minimiser: the smallest hash among its 8-word shingles. Equal
windows have equal minimisers, so the number of documents that hold a window's minimiser, as a count-min sketch has it,
is never below the number that hold the window. Partitions count their minimisers into sketch cells, the cells are summed, and the
cells met twice or more become bitmaps. A second pass emits only windows whose minimiser is estimated in two documents
or more; these are grouped exactly by 128-bit hashes, so no repeat is lost and none is made up.

Windows with the same minimiser form runs. Runs are compared first: where a run as a whole occurs in a document with a
smaller key, its windows are settled. A window can only equal one of another run if both runs have the same minimiser, so
windows are grouped one by one only for minimisers that occur with different runs, and only in each run's first document;
a third pass emits just those.

Defined results: null and empty texts have no words; texts below ``size`` words lose nothing; repeated rows of one key are
one document and don't remove each other; rows with a null key stay whole and remove nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import Memo, text_bytes

SHINGLE = 8
#: Cells of a sketch row: 16 for each expected minimiser within these bounds (a bitmap row of 32 MB at most).
LEAST_CELLS, MOST_CELLS, ROWS = 1 << 20, 1 << 28, 2
#: Odd multipliers of the two rolling hashes, and of the mixing step.
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
#: Words hashed at a time; a longer text is taken in overlapping parts.
PART = 1 << 18


class _Powers:
    """Powers of a base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int) -> None:
        self.base, self.size = base, 0
        self.grow(1 << 12)

    def grow(self, size: int) -> None:
        if size > self.size:
            self.size = max(size, 2 * self.size)
            self.up = self._series(self.base)
            self.down = self._series(pow(self.base, -1, 1 << 64))

    def _series(self, base: int) -> np.ndarray:
        steps = np.full(self.size, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)


_POWERS = [_Powers(base) for base in _BASE]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def _rolling(lanes: np.ndarray, lane: int) -> np.ndarray:
    """Prefix sums from which ``_span`` takes the hash of any run of words."""
    powers = _POWERS[lane]
    powers.grow(len(lanes) + 1)
    sums = np.zeros(len(lanes) + 1, np.uint64)
    np.cumsum(lanes[:, lane] * powers.up[:len(lanes)], out=sums[1:])
    return sums


def _span(sums: np.ndarray, lane: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return (sums[stop] - sums[start]) * _POWERS[lane].down[start]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, from running minima of blocks in both directions."""
    count = values.size - width + 1
    blocks = np.full(-(-values.size // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:values.size] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1:width - 1 + count])


def _parts(body: bytes, hashes: Memo, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first word, word hashes, minimiser of each window) for the parts of a text."""
    words = body.split()
    for at in range(0, max(len(words) - size + 1, 0), PART):
        part = words[at:at + PART + size - 1]
        lanes = np.frombuffer(b"".join(map(hashes.__getitem__, part)), "<u8").reshape(-1, 2)
        shingles = np.arange(len(part) - SHINGLE + 1)
        values = _mix(_span(_rolling(lanes, 0), 0, shingles, shingles + SHINGLE))
        yield at, lanes, _sliding_min(values, size - SHINGLE + 1)


def _cells(minimisers: np.ndarray, row: int, width: int) -> np.ndarray:
    return (_mix(minimisers + np.uint64((row + 1) * _BASE[1] % (1 << 64))) & np.uint64(width - 1)).astype(np.int64)


def _word_hashes() -> Memo:
    return Memo(xxhash.xxh3_128_digest, limit=200_000)


def sketch_repeats(bodies: DataFrame, size: int, width: int) -> list[np.ndarray]:
    """Per sketch row the bitmap of cells that at least two documents reach, ``width`` bits each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, waiting, held = _word_hashes(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            found = np.concatenate(waiting)
            for row in range(ROWS):
                cells, counts = np.unique(_cells(found, row, width), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells * ROWS + row), pa.array(counts.astype(np.int32))], ["cell", "n"])
            waiting.clear()

        for batch in batches:
            for body in batch.column(1).to_pylist():
                mine = [np.unique(minimisers) for _, _, minimisers in _parts(body, hashes, size)]
                if mine:  # a document counts once for each of its minimisers
                    waiting.append(mine[0] if len(mine) == 1 else np.unique(np.concatenate(mine)))
                    held += waiting[-1].size
            if held >= 1 << 20:
                yield from flush()
                held = 0
        if waiting:
            yield from flush()

    cells = bodies.mapInArrow(count, "cell long, n int").groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") >= 2)
    return _bitmaps(cells, width)


def _bitmaps(cells: DataFrame, width: int) -> list[np.ndarray]:
    """Per sketch row the bitmap of its cells; ``cell`` holds the cell times ``ROWS`` plus the row."""
    bit = F.floor(F.col("cell") / ROWS).cast("long") + 1  # Spark numbers bits from 1
    rows = (cells.select((F.col("cell") % ROWS).alias("row"), bit.alias("bit"))
            .groupBy("row", F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).toLocalIterator())
    maps = [np.zeros(max(width // 8, 4096), np.uint8) for _ in range(ROWS)]
    for row in rows:
        at = (row["bucket"] - 1) * len(row["bits"])
        maps[row["row"]][at:at + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    return maps


def _member_maps(minimisers: DataFrame, width: int) -> list[np.ndarray]:
    """Bitmaps that hold every ``m`` of a table (and, by chance, a few others)."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for row in range(ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(_cells(values, row, width) * ROWS + row)], ["cell"])

    return _bitmaps(minimisers.select("m").mapInArrow(cells, "cell long"), width)


def _estimated_repeated(minimisers: np.ndarray, maps: list[np.ndarray], width: int) -> np.ndarray:
    good = np.ones(minimisers.size, bool)
    for row, bits in enumerate(maps):
        cells = _cells(minimisers, row, width)
        good &= (bits[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)
    return good


def _runs(bodies: DataFrame, size: int, width: int, maps: list[np.ndarray], windows: bool) -> DataFrame:
    """(doc, start, n, m, r1, r2, h1, h2): runs of windows whose minimiser m the bitmaps hold.

    r1 and r2 are hashes of a run's words, h1 and h2 those of its windows, empty unless ``windows`` is set.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _word_hashes()
        for batch in batches:
            owner, first, length, least, spans, inner = [], [], [], [], ([], []), ([], [])
            for at_row, body in enumerate(batch.column(1).to_pylist()):
                for at, lanes, minimisers in _parts(body, hashes, size):
                    edges = np.flatnonzero(np.concatenate(([True], minimisers[1:] != minimisers[:-1], [True])))
                    start, stop = edges[:-1], edges[1:]
                    good = _estimated_repeated(minimisers[start], maps, width)
                    if not good.any():
                        continue
                    start, stop = start[good], stop[good]
                    counts = stop - start
                    inside = np.repeat(start - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
                    owner.append(np.full(start.size, at_row))
                    first.append(start + at)
                    length.append(counts)
                    least.append(minimisers[start])
                    for lane in (0, 1):
                        sums = _rolling(lanes, lane)
                        spans[lane].append(_span(sums, lane, start, stop + size - 1))
                        if windows:
                            inner[lane].append(_span(sums, lane, inside, inside + size))
            if owner:
                counts = np.concatenate(length)
                offsets = pa.array((np.concatenate(([0], np.cumsum(counts))) if windows else np.zeros(counts.size + 1)).astype(np.int32))
                held = [np.concatenate(w) if windows else np.empty(0, np.uint64) for w in inner]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(owner))), pa.array(np.concatenate(first).astype(np.int32)), pa.array(counts.astype(np.int32)),
                     pa.array(np.concatenate(least).view(np.int64)), *(pa.array(np.concatenate(s).view(np.int64)) for s in spans),
                     *(pa.ListArray.from_arrays(offsets, pa.array(w.view(np.int64))) for w in held)],
                    ["doc", "start", "n", "m", "r1", "r2", "h1", "h2"])

    kind = bodies.schema["doc_id"].dataType.simpleString()
    return bodies.mapInArrow(runs, f"doc {kind}, start int, n int, m long, r1 long, r2 long, h1 array<long>, h2 array<long>")


def repeated_spans(docs: DataFrame, size: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, spans): word spans [from, to) of each document covered by windows that start in a document with a smaller key."""
    bodies = text_bytes(docs.where(F.col(key).isNotNull()), key, text)
    chars = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    width = LEAST_CELLS
    while width < min(MOST_CELLS, chars // 8):  # about 130 bytes of text bring one minimiser
        width *= 2
    maps = sketch_repeats(bodies, size, width)
    content = ["m", "r1", "r2", "n"]
    runs = cut_lineage(_runs(bodies, size, width, maps, windows=False).drop("h1", "h2"))
    first = cut_lineage(runs.groupBy(*content).agg(F.min("doc").alias("least"), F.max("doc").alias("most")))
    whole = (runs.join(first.where(F.col("most") > F.col("least")).drop("most"), content).where(F.col("doc") > F.col("least"))
             .select("doc", F.col("start").alias("from"), (F.col("start") + F.col("n") + size - 1).alias("to")))
    # Minimisers of different runs in different documents: only there can single windows still be equal.
    mixed = (first.groupBy("m").agg(F.count(F.lit(1)).alias("kinds"), F.min("least").alias("low"), F.max("most").alias("high"))
             .where((F.col("kinds") > 1) & (F.col("high") > F.col("low"))).select("m"))
    leading = first.join(mixed, "m", "left_semi").drop("most")
    opened = (_runs(bodies, size, width, _member_maps(mixed, width), windows=True).join(leading, content).where(F.col("doc") == F.col("least")))
    windows = cut_lineage(opened.select("doc", "start", F.posexplode(F.arrays_zip("h1", "h2")).alias("i", "h"))
                          .select("doc", (F.col("start") + F.col("i")).alias("from"), F.col("h.h1").alias("h1"), F.col("h.h2").alias("h2")))
    shared = windows.groupBy("h1", "h2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where(F.col("most") > F.col("least"))
    single = windows.join(shared, ["h1", "h2"]).where(F.col("doc") > F.col("least")).select("doc", "from", (F.col("from") + size).alias("to"))
    return whole.unionAll(single).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("from", "to"))).alias("spans"))


def covered(n_words: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which words lie in any span."""
    depth = np.zeros(n_words + 1, np.int64)
    if spans:
        edges = np.array(spans, np.int64).reshape(-1, 2)
        np.add.at(depth, edges[:, 0], 1)
        np.add.at(depth, edges[:, 1], -1)
    return np.cumsum(depth[:-1]) > 0


def remove_spans(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(key, n_words, n_removed, kept): kept words joined by one space, or their SHA-256 where ``digest`` is set.

    Only documents that may have spans are shuffled with their text: a bitmap of key hashes of fixed size tells the
    others apart, and they are finished where they are read.
    """
    bits = 1 << 24
    place = F.pmod(F.xxhash64(F.col("doc").cast("string")), F.lit(bits)) + 1
    rows = (spans.select(place.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    touched = np.zeros(bits // 8, np.uint8)
    for row in rows:
        at = (row["bucket"] - 1) * len(row["bits"])
        touched[at:at + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    kind = docs.schema[key].dataType.simpleString()
    finish = (lambda words: hashlib.sha256(b" ".join(words)).hexdigest().encode()) if digest else b" ".join

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, kept, left = [], [], []
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = body.split()
                counts.append(len(words))
                at = xxhash.xxh64_intdigest(str(name).encode(), 42) % bits
                open_ = name is not None and bool(touched[at >> 3] >> (at & 7) & 1)
                kept.append(None if open_ else finish(words))
                left.append(body if open_ else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(kept, pa.binary()), pa.array(left, pa.binary())],
                                             ["doc_id", "n_words", "kept", "body"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for done, body, where in zip(*(batch.column(n).to_pylist() for n in ("kept", "body", "spans"))):
                if body is None:
                    removed.append(0)
                    kept.append(done)
                    continue
                words = body.split()
                gone = covered(len(words), [(s["from"], s["to"]) for s in where or ()])
                removed.append(int(gone.sum()))
                kept.append(finish([w for w, g in zip(words, gone.tolist()) if not g]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                                             [key, "n_words", "n_removed", "kept"])

    parts = text_bytes(docs, key, text).mapInArrow(split, f"doc_id {kind}, n_words long, kept binary, body binary")
    return (parts.join(spans, parts["doc_id"] == spans["doc"], "left").select("doc_id", "n_words", "kept", "body", "spans")
            .mapInArrow(cut, f"`{key}` {kind}, n_words long, n_removed long, kept string"))


def remove_repeats(docs: DataFrame, size: int = 50, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """``remove_spans`` of ``repeated_spans``."""
    return remove_spans(docs, cut_lineage(repeated_spans(docs, size, key, text)), key, text, digest)

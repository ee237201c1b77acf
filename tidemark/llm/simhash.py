"""SimHash fingerprints and near duplicates through vantage-point trees.

Two 64-bit fingerprints within 4 bits agree within 1 bit in at least one of three segments (22, 21 and 21 bits). Each
segment has a vantage-point tree whose leaves are shards: a node holds a vantage point and the median Hamming distance
to it; nearer values go left, others right. A fingerprint lives in one leaf per segment. As a query it also visits
the leaves that the triangle bound can't exclude: with distance d and radius r the left side can hold a match only if
d - r <= median, the right one only if d + r > median. Because links go both ways, a visitor only needs the leaves left
of its home. Inside a leaf all pairs of a home row and any other row are compared exactly on the full 64 bits.

Equal fingerprints are one row from the start, so a group of copies costs nothing. A leaf larger than a block is cut
into blocks that meet each other pairwise. A block pair reports its members' connected components, never all pairs.

Defined results: null and empty texts have the fingerprint zero and link like any other; repeated rows of a key share its
component; a null key has a fingerprint but links nothing (its component is null).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import text_bytes, worker_cache
from .components import connected_components


def fingerprint(body: bytes, size: int = 4, seed: int = 42, block: int = 65_536) -> int:
    """A bit is set if over half the shingles' hashes have it; shingles count with repeats."""
    words = body.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(len(words) - size + 1, 1)
    lows, highs = starts[:n].tolist(), ends[-n:].tolist()
    votes = np.zeros(64, np.int64)
    for at in range(0, n, block):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(lows[at:at + block], highs[at:at + block])], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def print_of(hashes: np.ndarray, block: int = 65_536) -> int:
    """The fingerprint of shingle hashes that have been counted already; without any it is zero."""
    votes = np.zeros(64, np.int64)
    for at in range(0, hashes.size, block):
        votes += np.unpackbits(hashes[at:at + block].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > hashes.size, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text, as a signed 64-bit integer."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("simhash")
        for batch in batches:
            found = np.array([fingerprint(body, size) for body in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return text_bytes(docs, key, text).mapInArrow(hashed, f"doc_id {docs.schema[key].dataType.simpleString()}, fp long")


@dataclass(frozen=True)
class VantageTree:
    """A complete binary tree in heap order over one segment: vantage values and medians of the inner nodes."""

    shift: int
    bits: int
    vantage: np.ndarray
    median: np.ndarray

    @property
    def depth(self) -> int:
        return int(self.vantage.size + 1).bit_length() - 1

    def segment(self, fps: np.ndarray) -> np.ndarray:
        return (fps >> np.uint64(self.shift)) & np.uint64((1 << self.bits) - 1)

    @staticmethod
    def grow(sample: np.ndarray, shift: int, bits: int, depth: int, seed: int) -> VantageTree:
        """Vantage points are drawn from the sample that reaches the node, medians taken over it."""
        random = np.random.default_rng(seed + shift)
        values = (sample >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
        inner = (1 << depth) - 1
        vantage, median = np.zeros(inner, np.uint64), np.zeros(inner, np.int64)
        groups = {0: values}
        for node in range(inner):
            here = groups.pop(node)
            vantage[node] = here[random.integers(here.size)] if here.size else random.integers(1 << bits)
            far = np.bitwise_count(here ^ vantage[node]).astype(np.int64)
            median[node] = int(np.median(far)) if here.size else bits // 2
            groups[2 * node + 1], groups[2 * node + 2] = here[far <= median[node]], here[far > median[node]]
        return VantageTree(shift, bits, vantage, median)

    def homes(self, fps: np.ndarray) -> np.ndarray:
        """Leaf of each fingerprint."""
        values, node = self.segment(fps), np.zeros(fps.size, np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (np.bitwise_count(values ^ self.vantage[node]) > self.median[node])
        return node - self.vantage.size

    def visits(self, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that the triangle bound leaves open, the home included."""
        values, row, node = self.segment(fps), np.arange(fps.size), np.zeros(fps.size, np.int64)
        for _ in range(self.depth):
            far = np.bitwise_count(values[row] ^ self.vantage[node]).astype(np.int64)
            left, right = far - radius <= self.median[node], far + radius > self.median[node]
            row, node = np.concatenate((row[left], row[right])), np.concatenate((2 * node[left] + 1, 2 * node[right] + 2))
        return row, node - self.vantage.size


def _trees(distinct: DataFrame, leaf_rows: int, sample_rows: int, max_depth: int, bits: int) -> tuple[list[VantageTree], int]:
    """One tree per segment, from a hash-chosen sample of at most about ``sample_rows`` fingerprints (8 bytes each).

    A pair within ``bits`` bits has a segment within ``bits // 3``.
    """
    there = distinct.count()
    depth = min(max_depth, max(0, int(np.ceil(np.log2(max(there, 1) / leaf_rows)))))
    share = min(1.0, min(sample_rows, 64 << depth) / max(there, 1))
    chosen = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30))).select("fp").toPandas()["fp"]
    sample = np.sort(chosen.to_numpy(dtype=np.int64)).view(np.uint64)
    return [VantageTree.grow(sample, shift, width, depth, 11) for shift, width in ((0, 22), (22, 21), (43, 21))], bits // 3


def _local_links(fps: np.ndarray, left: np.ndarray, bits: int, step: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """Links between ``left`` rows and all rows of a block, thinned to the components they make: (member, root) indices."""
    root = np.arange(fps.size)
    for at in range(0, left.size, step):
        part = left[at:at + step]
        i, j = np.nonzero(np.bitwise_count(fps[part][:, None] ^ fps[None, :]) <= bits)
        a, b = part[i], j
        while a.size:
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            open_ = low < high
            a, b = a[open_], b[open_]
            if a.size:
                np.minimum.at(root, high[open_], low[open_])
                while True:  # every row points to the root of its tree
                    up = root[root]
                    if np.array_equal(up, root):
                        break
                    root = up
    member = np.flatnonzero(root != np.arange(fps.size))
    return member, root[member]


def near_links(distinct: DataFrame, bits: int = 4, leaf_rows: int = 1024, block_rows: int = 8192,
               sample_rows: int = 1 << 19, max_depth: int = 16) -> DataFrame:
    """(a, b): ids of near fingerprints, enough links to connect all of them. ``distinct`` has unique ``fp`` and ``id``."""
    trees, radius = _trees(distinct, leaf_rows, sample_rows, max_depth, bits)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for number, tree in enumerate(trees):
                home = tree.homes(fps)
                row, leaf = tree.visits(fps, radius)
                wanted = leaf <= home[row]
                row, leaf = row[wanted], leaf[wanted]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf * len(trees) + number), pa.array(leaf == home[row]), batch.column("id").take(pa.array(row)), batch.column("fp").take(pa.array(row))],
                    ["leaf", "home", "id", "fp"])

    placed = cut_lineage(distinct.select("id", "fp").mapInArrow(place, "leaf long, home boolean, id long, fp long"))
    # A leaf of n rows is cut into k blocks by hash; each pair of blocks is one task's work.
    sizes = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("k"))
    cut = placed.join(sizes, "leaf").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
    paired = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select(
        "leaf", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "home", "id", "fp")

    def link(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("id", ignore_index=True)
        fps, ids = group["fp"].to_numpy().view(np.uint64), group["id"].to_numpy()
        member, root = _local_links(fps, np.flatnonzero(group["home"].to_numpy()), bits)
        return pd.DataFrame({"a": ids[member], "b": ids[root]})

    return paired.groupBy("leaf", "p", "q").applyInPandas(link, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 4, bits: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component): ``component`` is the smallest key reachable over links of at most ``bits`` bits."""
    marked = cut_lineage(fingerprints(docs, size, key, text))
    # The smallest key stands for all documents with the same fingerprint.
    distinct = cut_lineage(marked.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").cast("long").alias("id")))
    parts = connected_components(near_links(distinct, bits))
    named = distinct.join(parts, distinct["id"] == parts["node"], "left").select("fp", F.coalesce("component", "id").alias("component"))
    return (marked.join(named, "fp", "left")
            .select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component")))


def keep_one(docs: DataFrame, size: int = 4, bits: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents whose component has a smaller key. Rows without a key stay."""
    gone = near_duplicates(docs, size, bits, key, text).where(F.col("component") < F.col("doc_id")).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(gone, key, "left_anti").select(*docs.columns)

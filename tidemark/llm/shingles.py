"""Near copies by the Jaccard similarity of whole shingle sets: SimHash links first, then all that they can't reach.

Documents of equal sets are one node from the start. The vantage-point trees of ``simhash`` link nodes whose fingerprints over the same
shingles are within 4 bits; they tie most copies together before anything wide moves. Edits of up to a fifth of the shingles change
more bits than a tree can prune by (13 of 64 were seen), so a prefix filter finds the rest, without misses: two sets of
similarity 4/5 share at least four fifths of the larger one, so in any fixed order of all shingles each has a shared one among
its first ``n - ceil(4n/5) + 1``. The order puts shingles that are common in a hash sample of the documents last, so a passage
of many documents is in few prefixes; it decides the cost, never the result.

Only prefix shingles of two or more nodes are posted. To know them, each task sends 40 bits of every prefix shingle with
at most two of its nodes, packed into binary rows; what any two nodes share goes into a bitmap that grows with it up to
``common.MOST_BITS``. A bitmap too full lets more postings through and never fewer.

Candidates meet in rounds, and every link is confirmed on the whole sets, those of the SimHash links too. In a star round each node meets
one centre, drawn anew by hash, of each of its prefix shingles; that joins groups of copies with one row per node and shingle. In
the last round all pairs that share a prefix shingle and are still in different components meet. Pairs are judged by their sizes and
by the places of the shingle in both orders (what two sets share does not come before the first shingle that they share), then by parity
bits in proportion to the sets, which bound how many shingles two sets differ in, and only then by their sets, of which each node has one row.
The nodes of a frequent shingle meet in blocks, which report no pairs: first the nodes that the parity bits leave a partner, then, with
the sets of these, the links that join components, fewer than nodes. A round's files go when it is over.

Defined results: words are divided by ASCII white space and A-Z are a-z; a text of fewer words than a shingle is one
shingle; null and empty texts have the empty set and are copies of each other; a row without a key is nobody's copy.
Shingles and sets are told by 64-bit hashes, shingles of two sets in the last comparison by 48 bits of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from . import simhash
from .common import among, bitmap, text_bytes, without_rows, worker_cache
from .components import connected_components

#: Star rounds before the last one. More of them leave fewer pairs to it; the result is the same.
STARS = 2
#: Parity bits of a set: two for each shingle, between these bounds.
LEAST_PARITY, MOST_PARITY = 1 << 10, 1 << 15
#: A shingle of more nodes is frequent. A block of its nodes has at most about so many of them, and so many shingles in their sets together.
SMALL, BLOCK_ROWS, BLOCK_LOAD = 64, 1 << 12, 1 << 22
_LOW40 = np.uint64((1 << 40) - 1)


def shingle_hashes(body: bytes, size: int = 5) -> np.ndarray:
    """Hashes of the shingles of a text, in order, with repeats."""
    words = body.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(len(words) - size + 1, 1)
    return np.array([digest(joined[a:b]) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist())], np.uint64)


def shingle_set(body: bytes, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    return np.unique(shingle_hashes(body, size))


def row_id(key: object, body: bytes) -> int:
    """Tells a row by its key and text."""
    return xxhash.xxh64_intdigest(body, xxhash.xxh64_intdigest(str(key).encode()))


def prefix(hashes: np.ndarray, common: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The first ``n - ceil(4n/5) + 1`` shingles of a set: rare ones first, then by hash."""
    n = hashes.size
    if n == 0:
        return hashes
    rank = np.zeros(n, np.int64)
    if common.size:
        at = np.minimum(np.searchsorted(common, hashes), common.size - 1)
        rank = np.where(common[at] == hashes, often[at], 0)
    return hashes[np.lexsort((hashes, rank))[: n - (4 * n + 4) // 5 + 1]]


def parity(hashes: np.ndarray, each: int = 2, most: int = MOST_PARITY) -> bytes:
    """For each class of hashes, by their low bits, if the set has an odd number of it: two sets differ in as many elements as in bits, or more."""
    bits = min(max(1 << (each * hashes.size - 1).bit_length() if hashes.size else 0, LEAST_PARITY), most)
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(bits: bytes, width: int) -> np.ndarray:
    """Parity bits by fewer classes, ``width`` bytes of them."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint8).reshape(-1, width), axis=0)


def _differ(a: bytes, b: bytes) -> int:
    """How many elements two sets differ in, at least."""
    width = min(len(a), len(b))
    return int(np.bitwise_count(_folded(a, width) ^ _folded(b, width)).sum())


def _common(docs: DataFrame, size: int, key: str, text: str, rows: int = 4096, least: int = 4, limit: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of at least ``least`` documents of a hash sample, and in how many; at most ``limit`` of them."""
    share = min(1.0, rows / max(docs.count(), 1))
    sample = docs.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30)))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("shingles")
        for batch in batches:
            for body in batch.column(1).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(body, size).view(np.int64))], ["shingle"])

    found = (text_bytes(sample, key, text).mapInArrow(split, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
             .where(F.col("often") >= least).orderBy(F.desc("often"), "shingle").limit(limit).toPandas())
    common, often = found["shingle"].to_numpy(np.int64).view(np.uint64), found["often"].to_numpy(np.int64)
    order = np.argsort(common)
    return common[order], often[order]


def marks(docs: DataFrame, size: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, digest, node, n, fp, parity): XXH64 of the text, hash and size of its shingle set, SimHash fingerprint and parity bits."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("shingles")
        for batch in batches:
            found = []
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = shingle_hashes(body, size)
                held = np.unique(hashes)
                found.append((row_id(name, body), xxhash.xxh64_intdigest(body, 42), xxhash.xxh64_intdigest(held.tobytes()), held.size, simhash.print_of(hashes), parity(held)))
            row, digest, node, n, fp, bits = zip(*found) if found else [()] * 6
            longs = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in (row, digest, node, n, fp)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *longs, pa.array(bits, pa.binary())], ["doc_id", "row", "digest", "node", "n", "fp", "parity"])

    kind = docs.schema[key].dataType.simpleString()
    return text_bytes(docs, key, text).mapInArrow(marked, f"doc_id {kind}, row long, digest long, node long, n long, fp long, parity binary")


def _packed(hashes: np.ndarray, nodes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The smallest and the largest node of each hash, once where they are equal."""
    order = np.argsort(hashes, kind="stable")
    hashes, nodes = hashes[order], nodes[order]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    low, high = np.minimum.reduceat(nodes, first), np.maximum.reduceat(nodes, first)
    two = low != high
    return np.concatenate((hashes[first], hashes[first][two])), np.concatenate((low, high[two]))


def _shared(docs: DataFrame, postings: int, common: np.ndarray, often: np.ndarray, size: int, key: str, text: str,
            bucket_rows: int = 1 << 18, flush: int = 1 << 18) -> DataFrame:
    """(hash): the low 40 bits of the prefix shingles that two or more nodes have."""
    buckets = max(1, -(-postings // bucket_rows))

    def five(values: np.ndarray) -> np.ndarray:
        return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]

    def sent(hashes: list[np.ndarray], nodes: list[np.ndarray]) -> pa.RecordBatch:
        hashes, nodes = _packed(np.concatenate(hashes) & _LOW40, np.concatenate(nodes))
        rows = np.hstack((five(hashes), five(nodes)))
        bucket = hashes % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
        return pa.RecordBatch.from_arrays(
            [pa.array(range(buckets), pa.int64()), pa.array([rows[order[a:b]].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())], ["bucket", "packed"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("shingles")
        hashes, nodes, held = [], [], 0
        for batch in batches:
            for body in batch.column(1).to_pylist():
                whole = shingle_set(body, size)
                first = prefix(whole, common, often)
                hashes.append(first)
                nodes.append(np.full(first.size, xxhash.xxh64_intdigest(whole.tobytes()), np.uint64) & _LOW40)
                held += first.size
                if held >= flush:
                    yield sent(hashes, nodes)
                    hashes, nodes, held = [], [], 0
        if held:
            yield sent(hashes, nodes)

    def several(group: pd.DataFrame) -> pd.DataFrame:
        rows = np.frombuffer(b"".join(group["packed"]), np.uint8).reshape(-1, 10)
        wide = np.zeros((2, len(rows), 8), np.uint8)
        wide[0, :, :5], wide[1, :, :5] = rows[:, :5], rows[:, 5:]
        hashes, _ = _packed(wide[0].view("<u8").ravel(), wide[1].view("<u8").ravel())
        found, times = np.unique(hashes, return_counts=True)
        return pd.DataFrame({"hash": found[times > 1].astype(np.int64)})

    packed = text_bytes(docs, key, text).mapInArrow(split, "bucket long, packed binary").where(F.length("packed") > 0)
    return packed.groupBy("bucket").applyInPandas(several, "hash long")


def _postings(docs: DataFrame, shared: bytes, common: np.ndarray, often: np.ndarray, size: int, key: str, text: str) -> DataFrame:
    """(shingle, node, n, place) of the prefix shingles in the bitmap ``shared``: the size of the set, and how many of it come before the shingle."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("shingles")
        for batch in batches:
            found = [np.zeros((4, 0), np.int64)]
            for body in batch.column(1).to_pylist():
                whole = shingle_set(body, size)
                first = prefix(whole, common, often)
                place = np.flatnonzero(among(shared, first & _LOW40))
                node = np.array([xxhash.xxh64_intdigest(whole.tobytes())], np.uint64).view(np.int64)[0]
                found.append(np.stack([first[place].view(np.int64), np.full(place.size, node), np.full(place.size, whole.size), place]))
            shingle, node, n, place = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(shingle), pa.array(node), pa.array(n, pa.int32()), pa.array(place, pa.int32())], ["shingle", "node", "n", "place"])

    return text_bytes(docs, key, text).mapInArrow(split, "shingle long, node long, n int, place int").distinct()


def _sets(docs: DataFrame, wanted: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """(node, shingles) of the rows whose id is in ``wanted``, repeats or not, and of a few others: 48 bits of each shingle, packed."""
    bits = bitmap(wanted, "row", wanted.agg(F.approx_count_distinct("row")).first()[0])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("shingles")
        for batch in batches:
            names, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = np.array([row_id(name, body) for name, body in zip(names, bodies)], np.uint64)
            sets = [shingle_set(bodies[i], size) for i in np.flatnonzero(among(bits, rows)).tolist()]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            packed = [np.ascontiguousarray(s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(packed, pa.binary())], ["node", "shingles"])

    return text_bytes(docs, key, text).mapInArrow(split, "node long, shingles binary")


def _unpacked(packed: bytes) -> np.ndarray:
    rows = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(rows), 8), np.uint8)
    wide[:, :6] = rows
    return wide.view("<u8").ravel()


def _near(x: np.ndarray, y: np.ndarray) -> bool:
    """If two sets have a similarity of at least 4/5."""
    return np.intersect1d(x, y).size * 9 >= (x.size + y.size) * 4  # both / (x + y - both) >= 4/5


def _alike(a: bytes, b: bytes) -> bool:
    return _near(_unpacked(a), _unpacked(b))


def _kept_pairs(pairs: DataFrame, test, a: str, b: str) -> DataFrame:
    """(a, b) of the rows whose two binary columns pass ``test``."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [test(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.select("a", "b", a, b).mapInArrow(judged, "a long, b long")


def _may_be_near(n_a: str, place_a: str, n_b: str, place_b: str) -> Column:
    """By sizes and places of a shared shingle. Of two near sets at least the first shared shingle passes, which all others follow in both."""
    a, b = F.col(n_a), F.col(n_b)
    return (F.least(a, b) * 5 >= F.greatest(a, b) * 4) & (F.least(a - F.col(place_a), b - F.col(place_b)) * 9 >= (a + b) * 4)


def _rare_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): pairs of a shingle of few nodes in different components that may be near; ``rows`` has (shingle, node, n, place, part, many)."""
    few = rows.where(F.col("many") <= SMALL)
    one, two = (few.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "place", "part")]) for x in "ab")
    return (one.join(two, "shingle").where("node_a < node_b and part_a <> part_b").where(_may_be_near("n_a", "place_a", "n_b", "place_b"))
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))


def _partners(group: pd.DataFrame, bits: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """For the rows of block p those of block q in other components that may be near them; rows and their parity ``bits`` are in order of n."""
    own, part, n, place = (group[c].to_numpy() for c in ("own", "part", "n", "place"))
    n, place = n.astype(np.int64), place.astype(np.int64)
    p, q = group["p"].iat[0], group["q"].iat[0]
    right, width, levels = np.flatnonzero(own == q), np.array([len(b) for b in bits]), {}
    sizes = n[right]
    for i in np.flatnonzero(own == p).tolist():
        j = right[np.searchsorted(sizes, -(-4 * n[i] // 5)):np.searchsorted(sizes, 5 * n[i] // 4, "right")]
        if p == q:
            j = j[j > i]
        j = j[(part[j] != part[i]) & (np.minimum(n[i] - place[i], n[j] - place[j]) * 9 >= (n[i] + n[j]) * 4)]
        for least in (True, False):  # a short form of the bits first
            if j.size:
                wide = int(width[0] if least else min(width[i], width[j].min()))
                if wide not in levels:
                    start = int(np.searchsorted(width, wide))
                    levels[wide] = start, np.stack([_folded(b, wide) for b in bits[start:]]).view(np.uint64)
                start, held = levels[wide]
                differ = np.bitwise_count(held[i - start] ^ held[j - start]).sum(axis=1, dtype=np.int64)
                j = j[differ * 9 <= n[i] + n[j]]
        if j.size:
            yield i, j


def _meet(group: pd.DataFrame) -> pd.DataFrame:
    """The rows of two blocks that have a partner by the parity bits."""
    group = group.sort_values("n", ignore_index=True)
    kept = np.zeros(len(group), bool)
    for i, j in _partners(group, group["parity"].tolist()):
        kept[i] = kept[j] = True
    return group[kept].drop(columns="parity")


def _tie(group: pd.DataFrame) -> pd.DataFrame:
    """(a, b): near pairs of two blocks, by their whole sets, as few as join the same components."""
    group = group.drop_duplicates("node").sort_values("n", ignore_index=True)
    sets = [_unpacked(packed) for packed in group["shingles"]]
    node, part = group["node"].tolist(), group["part"].tolist()
    root = {c: c for c in part}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    a, b = [], []
    for i, partners in _partners(group, [parity(s, each=16, most=1 << 19) for s in sets]):
        for j in partners.tolist():
            x, y = find(part[i]), find(part[j])
            if x != y and _near(sets[i], sets[j]):
                root[x] = y
                a.append(min(node[i], node[j]))
                b.append(max(node[i], node[j]))
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _crowd_links(rows: DataFrame, reps: DataFrame, sets_of) -> DataFrame:
    """(a, b): near pairs of the frequent shingles, enough to join their components; ``rows`` has (shingle, node, n, place, part, many, load)."""
    blocks = F.ceil(F.greatest(F.col("many") / BLOCK_ROWS, F.col("load") / BLOCK_LOAD)).cast("int")
    cut = rows.where(F.col("many") > SMALL).withColumn("k", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    paired = cut.join(reps.select("node", "row", "parity"), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select(
        "shingle", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "node", "row", "part", "n", "place", "parity")
    met = cut_lineage(paired.groupBy("shingle", "p", "q").applyInPandas(_meet, "shingle long, p int, q int, own int, node long, row long, part long, n int, place int"))
    sets = cut_lineage(sets_of(met.select("row")))
    links = cut_lineage(met.drop("row").join(sets, "node").groupBy("shingle", "p", "q").applyInPandas(_tie, "a long, b long").distinct())
    release(met, sets)
    return links


def near_links(docs: DataFrame, marked: DataFrame, size: int = 5, bits: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b): pairs of nodes of similarity at least 4/5, enough of them to connect all."""
    # One row stands for all of a node.
    reps = cut_lineage(marked.groupBy("node").agg(F.min("row").alias("row"), F.max("n").alias("n"), F.first("fp").alias("fp"), F.first("parity").alias("parity")))
    judges = reps.select("node", "row", "n", "parity")

    def sets_of(wanted: DataFrame) -> DataFrame:
        return _sets(docs, wanted, size, key, text)

    def confirmed(pairs: DataFrame) -> DataFrame:
        bounded = (pairs.distinct().join(judges.toDF("a", "row_a", "n_a", "bits_a"), "a").join(judges.toDF("b", "row_b", "n_b", "bits_b"), "b")
                   .where(F.least("n_a", "n_b") * 5 >= F.greatest("n_a", "n_b") * 4))

        def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                most = [(x + y) // 9 for x, y in zip(batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist())]
                good = [_differ(x, y) <= m for x, y, m in zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), most)]
                yield batch.select(["a", "b", "row_a", "row_b"]).filter(pa.array(good, pa.bool_()))

        near = cut_lineage(bounded.mapInArrow(judged, "a long, b long, row_a long, row_b long"))
        sets = cut_lineage(sets_of(near.select(F.explode(F.array("row_a", "row_b")).alias("row"))))
        whole = near.select("a", "b").join(sets.toDF("a", "of_a"), "a").join(sets.toDF("b", "of_b"), "b")
        # A repeated row, or a bit shared by two rows, may give a set twice.
        found = cut_lineage(_kept_pairs(whole, _alike, "of_a", "of_b").distinct())
        release(near, sets)
        return found

    # Equal fingerprints meet the smallest of their nodes, near ones the trees.
    prints = cut_lineage(reps.groupBy("fp").agg(F.min("node").alias("id")))
    same = reps.join(prints, "fp").where("node <> id").select(F.least("node", "id").alias("a"), F.greatest("node", "id").alias("b"))
    close = simhash.near_links(prints, bits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = confirmed(same.unionAll(close))
    release(prints)

    common, often = _common(docs, size, key, text)
    postings = marked.agg(F.sum(F.col("n") - F.ceil(F.col("n") * 4 / 5) + 1)).first()[0] or 0
    held = cut_lineage(_shared(docs, postings, common, often, size, key, text))
    posted = cut_lineage(_postings(docs, bitmap(held, "hash"), common, often, size, key, text))
    release(held)

    open_, dry = posted, False
    for turn in range(STARS + 1):
        if dry and turn < STARS:
            continue
        if not dry:
            named = connected_components(links)
        parts = (open_.select("shingle", "node", "n", "place").join(named, "node", "left")
                 .select("shingle", "node", "n", "place", F.coalesce("component", "node").alias("part")))
        ends = parts.groupBy("shingle").agg(F.min("part").alias("from"), F.max("part").alias("to"),
                                            F.min_by(F.struct("node", "n", "place", "part"), F.xxhash64("node", F.lit(turn))).alias("centre"),
                                            F.count(F.lit(1)).alias("many"), F.sum("n").alias("load")).where("from <> to")
        before, open_ = open_, cut_lineage(parts.join(ends.select("shingle", "centre", "many", "load"), "shingle"))
        release(before)
        if turn < STARS:
            pairs = (open_.where("part <> centre.part").where(_may_be_near("n", "place", "centre.n", "centre.place"))
                     .select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b")))
        else:
            pairs = _rare_pairs(open_)
        found = confirmed(pairs)
        links, dry = links.unionAll(found), found.isEmpty()
    links = links.unionAll(_crowd_links(open_, reps, sets_of))
    release(open_, reps)
    return links


def keep_one(docs: DataFrame, size: int = 5, bits: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that a chain of near copies links to a document of a smaller key. Rows without a key stay.

    A row is told by its key and text: of the texts of one key, only those with an earlier copy go.
    """
    keyed = docs.where(F.col(key).isNotNull())
    marked = cut_lineage(marks(keyed, size, key, text))
    parts = connected_components(near_links(keyed, marked, size, bits, key, text))
    rows = marked.select("doc_id", "digest", "node").join(parts, "node", "left").select("doc_id", "digest", F.coalesce("component", "node").alias("part")).distinct()
    kept = rows.groupBy("part").agg(F.min(F.struct("doc_id", "digest")).alias("kept"))
    return without_rows(docs, rows.join(kept, "part").where(F.struct("doc_id", "digest") > F.col("kept")).select("doc_id", "digest"), key, text)

"""Periodic runs of words: maximal stretches that repeat a root of words several times over.

Baier's grouping, the first phase of his suffix sorter, orders the suffixes into groups by their longest Lyndon prefix.
Groups are taken from the highest down; every member points at the nearest position to its left that lies in a lower
group, and the positions pointed at move, by how often, into new groups right above their old ones, whose common prefix
grows by that many copies. The length of a position's last group prefix is its longest Lyndon word, so the Lyndon array
comes from the grouping directly, without a suffix array. It is taken under the order of the words and under its reverse:
each run has its Lyndon roots in one of the two. A root is extended to its run by the longest common extensions of
the root and the word after it, to the right and to the left.

Only parts of a text that may hold a run are grouped. A run of four or more roots and six or more words repeats each
group of three words inside it at least three times; stretches where every three words do so are kept, counted again by
themselves, and cut further until nothing changes. Every word beside a run that would extend it belongs to the same
stretch, so runs and their ends are those of the whole text.

Defined results: words are divided by ASCII white space; null and empty texts have no words and no runs and collapse to the
empty text; rows are taken one by one, so repeated and null keys keep their rows. A text is one row's work: memory is in
proportion to its stretches of repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes, worker_cache

#: The filter by groups of three words holds from this exponent and this length on.
LEAST_EXPONENT, LEAST_LENGTH = 4, 6
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def lyndon_array(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each position, by Baier's grouping of the suffixes."""
    size = len(ranks)
    # Positions count from 1. ``left`` leads from a position of a finished group towards the nearest one of an unfinished group.
    left = list(range(size + 1))
    longest = [0] * (size + 1)
    order = {rank: number for number, rank in enumerate(sorted(set(ranks)))}
    group = [-1] + [order[rank] for rank in ranks]
    members: list[list[int]] = [[] for _ in order]
    for at in range(1, size + 1):
        members[group[at]].append(at)
    prefix = [1] * len(order)
    below, above = list(range(-1, len(order) - 1)), list(range(1, len(order) + 1))
    now = len(order) - 1
    while now >= 0:
        length = prefix[now]
        inside = [at for at in members[now] if group[at] == now]
        members[now] = []
        for at in inside:
            longest[at], left[at] = length, at - 1
        pointed: dict[int, int] = {}
        for at in inside:
            to = at - 1
            while left[to] != to:
                left[to] = left[left[to]]
                to = left[to]
            if to:
                pointed[to] = pointed.get(to, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for to, times in pointed.items():
            moved.setdefault((times, group[to]), []).append(to)
        # Each new group goes right above its old one, so the one with the most copies has to go first.
        for times, old in sorted(moved, reverse=True):
            new = len(prefix)
            prefix.append(prefix[old] + times * length)
            members.append(moved[times, old])
            for to in members[new]:
                group[to] = new
            below.append(old)
            above.append(above[old])
            below[above[old]] = new
            above[old] = new
        now = below[now]
    return longest[1:]


def _common(ids: np.ndarray, a: int, b: int, step: int) -> int:
    """How far the words from ``a`` and from ``b`` on agree, to the right (1) or to the left (-1)."""
    found, width = 0, 16
    while True:
        room = ids.size - max(a, b) - found if step > 0 else min(a, b) + 1 - found
        width = min(width, room)
        if width <= 0:
            return found
        x, y = a + step * found, b + step * found
        if step > 0:
            same = ids[x:x + width] == ids[y:y + width]
        else:
            same = ids[x - width + 1:x + 1][::-1] == ids[y - width + 1:y + 1][::-1]
        at = int(np.argmin(same))
        if not same[at]:
            return found + at
        found += width
        width *= 4


def runs_of(ids: np.ndarray, exponent: int = LEAST_EXPONENT, shortest: int = LEAST_LENGTH) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least ``exponent`` roots and ``shortest`` symbols; the exponent is 2 or more."""
    found = set()
    for order in (ids, -ids):
        longest = np.array(lyndon_array(order.tolist()), np.int64)
        at = np.arange(ids.size)
        if exponent >= 3:  # then a run holds two roots in a row beyond its first word, and both are longest Lyndon words
            at = at[at + 2 * longest <= ids.size]
            at = at[longest[at + longest[at]] == longest[at]]
        at = at[np.lexsort((at, longest[at]))]
        start = end = last = -1
        for i, period in zip(at.tolist(), longest[at].tolist()):
            if period == last and start <= i and i + period <= end:
                continue  # this root lies in the stretch just extended
            last, start = period, i - _common(ids, i - 1, i + period - 1, -1)
            end = i + period + _common(ids, i, i + period, 1)
            if end - start >= max(shortest, exponent * period):
                found.add((start, end - start, period))
    return found


def _stretches(marked: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Bounds of the stretches of at least ``least`` marked places."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= least
    return list(zip(begin[long].tolist(), end[long].tolist()))


def _triples(ids: np.ndarray) -> np.ndarray:
    mixed = ids.view(np.uint64)
    return (mixed[:-2] * _MIX[0]) ^ (mixed[1:-1] * _MIX[1]) ^ (mixed[2:] * _MIX[2])


def _dense(ids: np.ndarray, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Stretches between ``start`` and ``end`` in which every three words in a row occur three times within the stretch."""
    todo = [(start, end)]
    while todo:
        start, end = todo.pop()
        if end - start < LEAST_LENGTH:
            continue
        _, which, times = np.unique(_triples(ids[start:end]), return_inverse=True, return_counts=True)
        parts = [(start + a, start + b + 2) for a, b in _stretches(times[which] >= 3, LEAST_LENGTH - 2)]
        if parts == [(start, end)]:
            yield start, end
        else:
            todo.extend(parts)


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words, by start and period."""
    sizes = [len(words) for words in texts]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    total = int(bounds[-1])
    found: list[set[tuple[int, int, int]]] = [set() for _ in texts]
    if total < LEAST_LENGTH:
        return [[] for _ in texts]
    hashes = np.fromiter((h for words in texts for h in map(hash, words)), np.int64, total)
    # First all texts at once, with counts by hash that are never too low; a stretch of three words over a text's end is cut there.
    owner = np.repeat(np.arange(len(texts)), sizes)
    keys = _triples(hashes) ^ (owner[:-2].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    keys *= _MIX[1]
    slots = (keys >> np.uint64(64 - max(total.bit_length() + 2, 8))).astype(np.int64)
    marked = np.bincount(slots)[slots] >= 3
    marked &= owner[:-2] == owner[2:]
    for a, b in _stretches(marked, LEAST_LENGTH - 2):
        text, base = int(owner[a]), int(bounds[owner[a]])
        for start, end in _dense(hashes, a, b + 2):
            numbers: dict[bytes, int] = {}
            ids = np.array([numbers.setdefault(w, len(numbers) + 1) for w in texts[text][start - base:end - base]], np.int64)
            found[text].update((start - base + s, n, p) for s, n, p in runs_of(ids))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds beyond its first root, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, runs, collapsed) per row: runs of four or more roots and six or more words, and the text with each cut to its first root."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("runs")
        for batch in batches:
            texts = [body.split() for body in batch.column(1).to_pylist()]
            found = runs_of_texts(texts)
            flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
            ends = np.cumsum([0] + [len(runs) for runs in found]).astype(np.int32)
            rows = pa.StructArray.from_arrays([pa.array(flat[:, i].copy()) for i in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(words) for words in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), rows),
                 pa.array([collapsed(words, runs) for words, runs in zip(texts, found)], pa.binary())], ["doc_id", "n_words", "runs", "body"])

    kind = docs.schema[key].dataType.simpleString()
    rows = text_bytes(docs, key, text).mapInArrow(
        searched, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, body binary")
    return rows.select(F.col("doc_id").alias(key), "n_words", "runs", F.col("body").cast("string").alias("collapsed"))

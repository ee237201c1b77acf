"""Byte-level BPE encoding and decoding with a pair occurrence index.

The distinct words of a batch are laid out in one array of symbols. An index maps each adjacent pair to all its
positions; the lowest active rank is applied at every position at once, by arrays where there are many, else left to
right, and the lists of the pairs it creates are extended, until no active pair is left. Encoded words are kept in a bounded cache of the worker.

Defined results: null and empty texts give no ids; a special token's string in a text is that token; rows stay one for
one, repeated rows included; columns other than the key and the text are not looked at. Ids outside the vocabulary
fail when they are decoded.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Memo, pieces, worker_cache

#: Fixed value: the public split pattern of this family of vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The same for characters up to U+00FF, whose letters, numbers and spaces are few enough to list. The first alternatives of
#: either pattern start with different characters, so their order is free.
_LETTER, _NUMBER, _SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\x09-\x0d \x85\xa0"
LATIN_SPLIT = f" ?[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"

#: From so many positions on a pair is merged by arrays.
BULK = 24


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else the next from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Codec:
    """Encodes and decodes with one vocabulary file of the ``tokenizers`` library (byte-level BPE)."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, alphabet = spec["model"]["vocab"], byte_alphabet()
        of_char = {c: b for b, c in enumerate(alphabet)}
        self.first = [vocabulary[c] for c in alphabet]
        self.spelled: dict[int, bytes] = {i: bytes(of_char[c] for c in token) for token, i in vocabulary.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.spelled |= {i: content.encode() for content, i in self.special.items()}
        self.pairs: list[tuple[int, int]] = []
        self.made: list[int] = []
        born = {i: -1 for i in self.first}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made = vocabulary[left + right]
            if not max(born.get(vocabulary[left], rank), born.get(vocabulary[right], rank)) < rank:
                raise ValueError("a merge comes before its parts, so ranks can't be applied in ascending order")
            born.setdefault(made, rank)
            self.pairs.append((vocabulary[left], vocabulary[right]))
            self.made.append(made)
        # Ranks by one part of the pair, so that a merge looks up its neighbours alone.
        self.following: dict[int, dict[int, int]] = defaultdict(dict)
        self.preceding: dict[int, dict[int, int]] = defaultdict(dict)
        for rank, (left, right) in enumerate(self.pairs):
            self.following[left][right] = self.preceding[right][left] = rank
        self.following, self.preceding = dict(self.following), dict(self.preceding)
        self.of_byte = np.array(self.first, np.int64)
        self.of_bytes = np.array([self.following.get(a, {}).get(b, -1) for a in self.first for b in self.first], np.int64)
        self.split_any, self.split_latin = regex.compile(SPLIT).findall, re.compile(LATIN_SPLIT).findall
        self.beyond_latin = re.compile("[^\x00-\xff]").search
        ids = np.array(sorted(self.spelled))
        #: Bytes of all tokens in order of their ids, where each id's begin, and their number; -1 for no id.
        self.letters = np.frombuffer(b"".join(self.spelled[i] for i in ids.tolist()), np.uint8)
        self.lengths, self.begins = np.full(ids[-1] + 1, -1), np.zeros(ids[-1] + 1, np.int64)
        self.lengths[ids] = [len(self.spelled[i]) for i in ids.tolist()]
        self.begins[ids] = np.cumsum(self.lengths[ids]) - self.lengths[ids]
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.known = Memo(lambda word: self.encode_words([word])[0])

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, packed as 32-bit integers."""
        if not words:
            return []
        bodies = [word.encode("utf-8") for word in words]
        stops = np.cumsum([len(body) + 1 for body in bodies]) - 1
        data = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8).astype(np.int64)
        start = self.of_byte[data]
        start[stops] = -1  # no symbol: it ends a word, and is in no pair
        ranks = self.of_bytes[data[:-1] * 256 + data[1:]]
        ranks[stops[:-1]] = ranks[stops[stops > 0] - 1] = -1
        found = np.flatnonzero(ranks >= 0)
        found = found[np.argsort(ranks[found], kind="stable")]
        active, cuts = np.unique(ranks[found], return_index=True)
        active = active.tolist()  # in order, so a heap
        # Positions of a pair: those of the start, and those that merges have added.
        first, index = dict(zip(active, np.split(found, cuts[1:]))), {}
        size = start.size
        places, nexts, lasts = start, np.arange(1, size + 1), np.arange(-1, size - 1)
        symbols, after, before = memoryview(places), memoryview(nexts), memoryview(lasts)  # the same numbers, read one by one
        none: dict[int, int] = {}

        def add(at: list[int], ranks: Iterable[int | None]) -> None:
            for i, new in zip(at, ranks):
                if new is not None:
                    if new in index:
                        index[new].append(i)
                    else:
                        index[new] = [i]
                        if new not in first:
                            heapq.heappush(active, new)

        while active:
            rank = heapq.heappop(active)
            (left, right), made = self.pairs[rank], self.made[rank]
            next_rank, last_rank = self.following.get(made, none).get, self.preceding.get(made, none).get
            at, added = first.pop(rank, None), index.pop(rank, [])
            if left != right and len(added) + (0 if at is None else len(at)) >= BULK:
                # Occurrences of two different symbols don't overlap, so all are merged at once. None is listed twice: only
                # two neighbours that are both made here name the same place, and their pair is of two equal symbols.
                at = np.concatenate(([] if at is None else at, added)).astype(np.int64)
                at = at[(places[at] == left) & (places[nexts[at]] == right)]
                gone = nexts[at]
                places[at], places[gone] = made, -1
                behind = nexts[at] = nexts[gone]
                lasts[behind] = at
                ahead = lasts[at]
                add(at.tolist(), map(next_rank, places[behind].tolist()))
                add(ahead.tolist(), map(last_rank, places[ahead].tolist()))
                continue
            for i in sorted(added if at is None else at.tolist() + added):
                if symbols[i] != left or symbols[j := after[i]] != right:
                    continue  # this occurrence has gone into an earlier merge
                symbols[i], symbols[j] = made, -1
                k = after[i] = after[j]
                before[k] = i
                h = before[i]
                if (new := next_rank(symbols[k])) is not None:
                    if new in index:
                        index[new].append(i)
                    else:
                        index[new] = [i]
                        if new not in first:
                            heapq.heappush(active, new)
                if (new := last_rank(symbols[h])) is not None:
                    if new in index:
                        index[new].append(h)
                    else:
                        index[new] = [h]
                        if new not in first:
                            heapq.heappush(active, new)
        merged = places.astype(np.int32)
        kept = merged >= 0
        ends = (np.cumsum(kept)[stops] * 4).tolist()
        packed = merged[kept].tobytes()
        return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def split(self, text: str) -> list[str]:
        return self.split_any(text) if self.beyond_latin(text) else self.split_latin(text)

    def _words(self, text: str) -> Iterator[list[str] | int]:
        """Lists of words, and the ids of special tokens between them."""
        for part in self.marks.split(text) if self.marks else [text]:
            if part in self.special:
                yield self.special[part]
            elif part:
                for piece in pieces(part):
                    yield self.split(piece)

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of each text; the new words of several texts are merged together."""
        out, waiting, size = [], [], 0
        known = self.known

        def settle() -> None:
            words = set().union(*(p for parts, _ in waiting for p in parts if not isinstance(p, int)))
            older = known.older
            fresh = [w for w in words if w not in known and w not in older]
            now = {}
            for word, ids in zip(fresh, self.encode_words(fresh)):
                if len(word) > known.longest:
                    now[word] = ids
                else:
                    known.put(word, ids)
            look = (lambda w: now[w] if w in now else known[w]) if now else known.__getitem__
            for parts, place in waiting:
                out[place].extend(array("i", [p]).tobytes() if isinstance(p, int) else b"".join(map(look, p)) for p in parts)
            waiting.clear()

        for place, text in enumerate(texts):
            out.append([])
            for part in self._words(text):
                waiting.append(([part], place))
                size += 1 if isinstance(part, int) else len(part)
                if size >= 200_000:
                    settle()
                    size = 0
        settle()
        return [np.frombuffer(b"".join(chunks), dtype=np.int32) for chunks in out]

    def decode(self, ids: Iterable[int]) -> str:
        ids, out = np.asarray(ids, np.int64), []
        for some in (ids[i:i + 100_000] for i in range(0, len(ids), 100_000)):
            if some.min() < 0 or some.max() >= self.lengths.size or (sizes := self.lengths[some]).min() < 0:
                raise KeyError("an id is not in the vocabulary")
            out.append(self.letters[np.repeat(self.begins[some] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())].tobytes())
        return b"".join(out).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    """One codec per worker, so that tasks of a worker share its cache."""
    return worker_cache(("bpe", path), lambda: Codec(path))


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """(key, ids) per row of ``docs``; ``path`` is where each worker finds the vocabulary.

    With ``decoded`` the text that the ids stand for comes along, made by the same worker with the same caches.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            rows = coder.encode(batch.column(1).to_pylist())
            offsets = np.cumsum([0, *map(len, rows)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.empty(0, np.int32)))
            columns = [batch.column(0), ids]
            if decoded:
                columns.append(pa.array([coder.decode(row) for row in rows], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [key, "ids", "decoded"][:len(columns)])

    wanted = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return wanted.mapInArrow(encode, f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>" + (", decoded string" if decoded else ""))


def decode_ids(ids: Column, path: str) -> Column:
    """The text of an id column; bytes that are no text become the replacement character."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = codec(path)
        for rows in batches:
            yield pd.Series([coder.decode(row) for row in rows], dtype=object)

    return decode(F.coalesce(ids, F.array().cast("array<int>")))

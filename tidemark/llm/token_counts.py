"""Token counts of whole texts by byte-pair merging over a heap and a linked list.

A word starts as one symbol per character. The lowest-ranked adjacent pair is popped from a heap again and again, its
two symbols become one in a linked list, and the pairs it now forms are pushed. The count is the number of initial
symbols minus the merges, plus the further bytes of characters the vocabulary lacks; identifiers are never made.

Words are counted once per worker and then looked up, in a cache of bounded size. Defined results: null and empty texts
have 0 tokens; rows stay one for one, repeated rows included; columns other than the key and the text are not looked at.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Memo, pieces, worker_cache

SPACE = "▁"
#: A run of spaces with the word behind it, a word at the start of a line, a line end.
WORD = re.compile(" +[^ \n]*|[^ \n]+|\n")


class MergeCounter:
    """Counts the tokens of a piece model (BPE, byte fallback, spaces as piece starts) without building them."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ranks: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                piece = model.id_to_piece(i).replace(SPACE, " ")
                self.ranks[piece] = -model.get_score(i)
                if len(piece) > 1 and ("\n" in piece or " " in piece.lstrip(" ")):
                    raise ValueError(f"piece {piece!r} reaches over a word's end, so words can't be counted alone")
        self.known = Memo(self.count_word)

    def count_word(self, word: str) -> int:
        ranks, size = self.ranks, len(word)
        end = list(range(1, size + 1))  # of the symbol that starts here; 0 once it is merged into the one before
        before = list(range(-1, size))  # start of the symbol before
        heap = [(ranks[word[i:i + 2]], i, i + 2) for i in range(size - 1) if word[i:i + 2] in ranks]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= stop or end[middle] != stop:
                continue  # one of the two has been merged meanwhile
            merges += 1
            end[i], end[middle] = stop, 0
            if i:
                first = before[i]
                rank = ranks.get(word[first:stop])
                if rank is not None:
                    heapq.heappush(heap, (rank, first, stop))
            if stop < size:
                before[stop] = i
                last = end[stop]
                rank = ranks.get(word[i:last])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, last))
        spelled = sum(len(c.encode()) - 1 for i, c in enumerate(word) if end[i] == i + 1 and c not in ranks)
        return size - merges + spelled

    def count(self, text: str) -> int:
        if not text:
            return 0
        known = self.known.__getitem__
        text = " " + text.replace(SPACE, " ")  # a space goes before the text
        return sum(sum(map(known, WORD.findall(part))) for part in pieces(text))


def merge_counter(path: str) -> MergeCounter:
    """One counter per worker, so that tasks of a worker share its cache."""
    return worker_cache(("tokens", path), lambda: MergeCounter(path))


def token_count(text: Column, path: str) -> Column:
    """Tokens of a text column; ``path`` is where each worker finds the piece model."""

    @F.pandas_udf("long")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = merge_counter(path)
        for texts in batches:
            yield pd.Series([counter.count(text) for text in texts], dtype="int64")

    return counts(F.coalesce(text, F.lit("")))


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) per row of ``docs``."""
    counted = docs.select(F.col(key), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                          token_count(F.col(text), path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

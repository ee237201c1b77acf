"""Quality classifier with supervised subword embeddings.

Words, pairs of neighbouring words and the character n-grams of words are hashed to rows of a table of learned vectors; one row
stands for a word that every text has. Each of the three kinds is averaged over the text, so that the many n-grams don't drown the words, and
the mean of the averages is the document's vector. A linear layer with softmax gives the two classes, and both are trained by
stochastic gradient descent in numpy; examples of the rarer class weigh more. Because the layer is linear, scoring needs one number per
feature: the difference of its two class outputs. Whole texts are read in training and scoring.

Training uses at most about ``max_rows`` labelled rows, chosen by a hash of their key, in one task; everything else runs
over all rows. Defined results: null and empty texts have only that constant word; labels that are null or belong to no
document are ignored; of several labels of a document the highest counts; a labelled document that is repeated is as many examples;
without any usable label every score is 0.5.
Neither language, source nor key is a feature; other columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import worker_cache


#: Length of a gradient, and the factor that undoes the mean, at most.
LONGEST, STEEPEST = 10.0, 10.0


@dataclass(frozen=True)
class Settings:
    """Sizes and steps of the model. ``grams``: lengths in bytes of the character n-grams of ``<word>``."""

    buckets: int = 1 << 19
    width: int = 16
    grams: tuple[int, ...] = (2, 4)
    epochs: int = 5
    rate: float = 0.5
    #: Weight of an example of the rarer class at most.
    most_weight: float = 5.0
    max_rows: int = 8000
    seed: int = 7


def groups(bodies: Iterable[bytes], size: int = 1 << 20) -> Iterator[list[bytes]]:
    """``bodies`` in order, in lists of about ``size`` bytes."""
    held, taken = [], 0
    for body in bodies:
        held.append(body)
        taken += len(body)
        if taken >= size:
            yield held
            held, taken = [], 0
    if held:
        yield held


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def gram_buckets(words: list[bytes], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of words, word by word, and where each word's begin, with the end as last entry.

    Grams are cut from all words at once, and each distinct one is hashed once.
    """
    data = np.frombuffer(b"".join([b"<%b>" % word for word in words]), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    counts = [np.maximum(sizes - n + 1, 0) for n in settings.grams]
    cuts = np.concatenate(([0], np.cumsum(sum(counts))))
    buckets, before = np.empty(cuts[-1], np.int64), cuts[:-1]
    for n, times in zip(settings.grams, counts):
        inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        at = np.repeat(starts, times) + inside
        width = -(-n // 8) * 8
        padded = np.zeros((at.size, width), np.uint8)
        for i in range(n):
            padded[:, i] = data[at + i]
        distinct, which = np.unique(padded.view(np.uint64 if width == 8 else f"V{width}").ravel(), return_inverse=True)
        packed = distinct.tobytes()
        hashed = hashes_of([packed[i:i + n] for i in range(0, len(packed), width)])
        buckets[np.repeat(before, times) + inside] = (hashed % np.uint64(settings.buckets - 1)).astype(np.int64)[which] + 1
        before = before + times
    return buckets, cuts


def word_buckets(hashes: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words, and of the pairs of each with the next."""
    pairs = (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (hashes[1:] >> np.uint64(1))
    words, pairs = ((v % np.uint64(settings.buckets - 1)).astype(np.int64) + 1 for v in (hashes, pairs))
    return words, pairs


def examples(bodies: list[bytes], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct features of each text and their shares."""
    for group in groups(bodies):
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        texts = [np.array([numbers[word] for word in body.split()], np.int64) for body in group]
        words = [*numbers]
        hashes, (spelled, cuts) = hashes_of(words), gram_buckets(words, settings)
        for text in texts:
            sizes = cuts[text + 1] - cuts[text]
            grams = spelled[np.repeat(cuts[text] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
            single, pairs = word_buckets(hashes[text], settings)
            parts = [p for p in (np.concatenate(([0], single)), pairs, grams) if p.size]
            buckets, at = np.unique(np.concatenate(parts), return_inverse=True)
            shares = np.bincount(at, np.concatenate([np.full(p.size, 1 / (p.size * len(parts))) for p in parts]))
            yield buckets, shares.astype(np.float32)


def descend(vectors: np.ndarray, output: np.ndarray, buckets: np.ndarray, shares: np.ndarray, label: int, rate: float, weight: float = 1.0) -> None:
    """One step of gradient descent on the log loss of one example, in place."""
    rows = vectors[buckets]
    hidden = shares @ rows
    logits = hidden @ output
    chances = np.exp(logits - logits.max())
    error = chances / chances.sum()
    error[label] -= 1
    error *= weight
    back = output @ error
    # Both gradients have a bounded length.
    output -= rate * np.outer(hidden, error) / max(1.0, np.linalg.norm(hidden) * np.linalg.norm(error) / LONGEST)
    back /= max(1.0, np.linalg.norm(back) / LONGEST)
    # The mean spreads the gradient by the features' shares; undoing the mean keeps long texts learning.
    rows -= (rate * np.minimum(shares * min(len(buckets), 100), STEEPEST))[:, None] * back
    vectors[buckets] = rows


def fit(bodies: list[bytes], labels: list[int], settings: Settings) -> np.ndarray:
    """Difference of the two class outputs for each bucket, after plain stochastic gradient descent."""
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1 / settings.width, 1 / settings.width, (settings.buckets, settings.width)).astype(np.float32)
    output = np.zeros((settings.width, 2), np.float32)
    seen = [*examples(bodies, settings)]
    there = np.bincount(labels, minlength=2)
    weights = np.clip(there.max() / np.maximum(there, 1), 1, settings.most_weight).tolist()
    steps, step = settings.epochs * len(seen), 0
    for _ in range(settings.epochs):
        for at in random.permutation(len(seen)):
            rate = settings.rate * (1 - step / steps)
            step += 1
            descend(vectors, output, *seen[at], labels[at], rate, weights[labels[at]])
    return (vectors @ (output[:, 1] - output[:, 0])).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text",
          label: str = "quality", usable: Column | None = None) -> np.ndarray:
    """Learned outputs per bucket (``settings.buckets`` floats), from the labelled rows that ``usable`` admits."""
    marked = (labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
              .where(F.col("k").isNotNull() & F.col("y").isin(0, 1)).groupBy("k").agg(F.max("y").alias("y")))
    if usable is not None:
        marked = marked.where(usable)
    there = marked.count()
    # A hash of the key decides, so the sample is the same on every run and about max_rows at any size.
    share = min(1.0, settings.max_rows / max(there, 1))
    chosen = marked.where(F.pmod(F.xxhash64("k"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body")).join(chosen, "k")

    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r["k"], r["body"], r["y"]) for b in batches for r in b.to_pylist())
        if got:
            outputs = fit([r[1] for r in got], [r[2] for r in got], settings)
            yield pa.RecordBatch.from_arrays([pa.array([outputs.tobytes()], pa.binary())], ["outputs"])

    found = rows.select("k", "body", "y").repartition(1).mapInArrow(fit_all, "outputs binary").collect()
    return np.frombuffer(found[0]["outputs"], np.float32) if found else np.zeros(settings.buckets, np.float32)


class Scorer:
    """Logits of texts. Recent words keep a number, and by it their hash, output, and sum and count of their n-grams' outputs."""

    def __init__(self, outputs: bytes, settings: Settings, limit: int = 200_000) -> None:
        self.table, self.settings, self.limit = np.frombuffer(outputs, np.float32).astype(float), settings, limit
        self.forget()

    def forget(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.held, self.hashes = 0, np.empty(0, np.uint64)
        self.alone, self.spelled, self.grams = np.empty((3, 0))

    def learn(self) -> None:
        """What is kept of the words that got a number last."""
        fresh = [*islice(self.numbers, self.hashes.size, None)]
        if not fresh:
            return
        hashes, (buckets, cuts) = hashes_of(fresh), gram_buckets(fresh, self.settings)
        sizes = np.diff(cuts)
        spelled = np.bincount(np.repeat(np.arange(len(fresh)), sizes), self.table[buckets], len(fresh))
        self.held += sum(map(len, fresh))
        self.hashes = np.concatenate((self.hashes, hashes))
        self.alone = np.concatenate((self.alone, self.table[word_buckets(hashes, self.settings)[0]]))
        self.spelled, self.grams = np.concatenate((self.spelled, spelled)), np.concatenate((self.grams, sizes))

    def logits(self, bodies: list[bytes]) -> np.ndarray:
        """The mean of the averages of each kind of feature that a text has."""
        if len(self.numbers) > self.limit or self.held > 64 * self.limit:
            self.forget()
        texts = [body.split() for body in bodies]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        words = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(texts)), np.int64, sizes.sum())
        self.learn()
        text = np.repeat(np.arange(len(texts)), sizes)
        paired = self.table[word_buckets(self.hashes[words], self.settings)[1]]
        paired[text[:-1] != text[1:]] = 0  # words of two texts
        kinds = [(self.table[0] + np.bincount(text, self.alone[words], len(texts)), sizes + 1),
                 (np.bincount(text[1:], paired, len(texts)), np.maximum(sizes - 1, 0)),
                 (np.bincount(text, self.spelled[words], len(texts)), np.bincount(text, self.grams[words], len(texts)))]
        return sum(total / np.maximum(number, 1) for total, number in kinds) / sum((number > 0).astype(int) for _, number in kinds)


def _scorer(outputs: bytes, settings: Settings) -> Scorer:
    """One per worker, so that tasks of a worker share its words."""
    return worker_cache(("quality", xxhash.xxh3_128_digest(outputs), settings), lambda: Scorer(outputs, settings))


def quality_score(text: Column, outputs: np.ndarray, settings: Settings = Settings()) -> Column:
    """Probability of label 1 of a text column. The outputs travel with the function: their size is fixed."""
    packed = outputs.tobytes()

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _scorer(packed, settings)
        for bodies in batches:
            logits = [scorer.logits(group) for group in groups(bodies)]
            yield pd.Series((1 + np.tanh(np.concatenate([*logits, []]) / 2)) / 2)

    return score(F.coalesce(text.cast("binary"), F.lit(b"")))

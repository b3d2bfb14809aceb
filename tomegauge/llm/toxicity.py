"""Toxicity by subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams and of the whole
word; a passage of a few words is the mean of its words; a linear softmax on it
tells how likely the passage is toxic. Misspelled or inflected words that
training never saw share n-grams with known ones.

Labels are given per document, not per passage. Training first takes the label
of the document for each passage, then, for toxic documents, only their most
suspicious passages; a word repeated at once counts once. A document scores as its most suspicious passage does; two
numbers that turn this into a probability are fitted on training documents
kept aside. The model is fitted on the driver on a bounded sample of labelled rows
(``max_rows`` per class, ``max_chars`` of text in all); all texts are scored whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomegauge.llm.common import new_names, remainder, ready_for_python
from tomegauge.llm.hashing import mix

BUCKETS = 1 << 18
DIMENSIONS = 8
GRAMS = (3, 4, 5, 6)
#: Words of a passage.
SPAN = 8
#: Words whose scores a task remembers.
REMEMBERED = 400_000
THRESHOLD = 0.7
#: A text longer than this share of the characters of its class is learnt from in evenly spread pieces, so many in number.
LARGEST, PIECES = 0.01, 20
#: Documents of each label kept aside to turn log odds into scores.
LEAST_ASIDE = 20
#: Scores of words by model, kept between the tasks of a Python worker.
_KNOWN: dict[bytes, dict[bytes, float]] = {}
_LETTERS = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words in UTF-8; ASCII characters that are no letters separate them."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def subwords(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words, one word after the other, and where each word begins."""
    marked = [f"<{w.decode('utf-8', 'surrogatepass')}>" for w in found]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    sizes = np.array([len(w) for w in marked], dtype=np.int64)
    word = np.repeat(np.arange(len(found)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    places = np.arange(len(codes))
    factor = np.uint64(0x100000001B3)
    whole = np.zeros(len(found), dtype=np.uint64)
    np.add.at(whole, word, mix(codes + (places - (ends - np.repeat(sizes, sizes))).astype(np.uint64) * factor))
    owners, hashes = [np.arange(len(found))], [mix(whole)]
    rolled = codes.copy()
    for n in range(2, max(GRAMS) + 1):
        if len(codes) < n:
            break
        rolled = rolled[: len(codes) - n + 1] * factor + codes[n - 1 :]
        if n in GRAMS:
            inside = places[: len(rolled)] + n <= ends[: len(rolled)]
            owners.append(word[: len(rolled)][inside])
            hashes.append(mix(rolled[inside] + np.uint64(n)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    buckets = (np.concatenate(hashes)[order] % np.uint64(BUCKETS)).astype(np.int64)
    return buckets, np.searchsorted(owner[order], np.arange(len(found)))


def all_subwords(found: list[bytes], block: int = 10_000) -> tuple[np.ndarray, np.ndarray]:
    """The same for very many words, worked on in blocks to bound the memory of the driver."""
    buckets, starts, size = [], [], 0
    for at in range(0, len(found), block):
        some, first = subwords(found[at : at + block])
        buckets.append(some.astype(np.int32))
        starts.append(first + size)
        size += len(some)
    return np.concatenate(buckets), np.concatenate(starts)


def _means(values: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    sizes = np.diff(np.append(starts, n))
    sums = np.add.reduceat(values, starts, axis=0)
    return sums / (sizes[:, None] if values.ndim > 1 else sizes)


@dataclass
class Model:
    """What scoring needs: the share of each bucket in the log odds of a passage, and how log odds become a score."""

    shares: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, texts: pd.Series, known: dict[bytes, float]) -> np.ndarray:
        split = [words(t) for t in texts]
        fresh = [w for w in {w for found in split for w in found} if w not in known]
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
            fresh = list({w for found in split for w in found})
        for k in range(0, len(fresh), 50_000):
            part = fresh[k : k + 50_000]
            buckets, starts = subwords(part)
            known.update(zip(part, _means(self.shares[buckets], starts, len(buckets)).tolist(), strict=True))
        top = np.array([self._top(np.fromiter(map(known.__getitem__, found), float, len(found))) for found in split])
        return 1 / (1 + np.exp(-np.clip(self.slope * top + self.offset, -50, 50)))

    def _top(self, values: np.ndarray) -> float:
        if not len(values):
            return self.bias
        values = values[np.append(True, values[1:] != values[:-1])]
        span = min(SPAN, len(values))
        sums = np.concatenate([[0.0], np.cumsum(values)])
        return float((sums[span:] - sums[:-span]).max() / span) + self.bias


def _passages(numbered: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of the passages of all texts, -1 where one is shorter, and the text each is from."""
    rows, owner = [np.empty((0, SPAN), np.int32)], [np.empty(0, np.int64)]
    for k, ids in enumerate(numbered):
        if len(ids):
            ids = ids[np.append(True, ids[1:] != ids[:-1])]
            padded = np.append(ids, np.full(-len(ids) % SPAN, -1, dtype=np.int32))
            rows.append(padded.reshape(-1, SPAN))
            owner.append(np.full(len(rows[-1]), k, dtype=np.int64))
    return np.concatenate(rows), np.concatenate(owner)


def fit(texts: list[str | None], labels: list[int], epochs: int = 8, batch: int | None = None, rate: float = 0.1, seed: int = 7) -> Model:
    """Train on texts and their labels, 0 or 1. Without both labels every text gets the share of the one there is."""
    target = np.array(labels, dtype=np.int64)
    if len(set(labels)) < 2:
        share = (target.sum() + 0.05) / (len(target) + 1)
        return Model(np.zeros(BUCKETS), 0.0, 0.0, float(np.log(share / (1 - share))))
    index: dict[bytes, int] = {}
    numbered = [np.array([index.setdefault(w, len(index)) for w in words(t)], dtype=np.int32) for t in texts]
    vocabulary = list(index)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    weights, bias = rng.uniform(-0.1, 0.1, (DIMENSIONS, 2)), np.zeros(2)
    if not vocabulary:
        return fit(texts, [0] * len(labels))
    buckets, starts = all_subwords(vocabulary)
    sizes = np.diff(np.append(starts, len(buckets)))
    passages, owner = _passages(numbered)
    aside = rng.permutation(len(target)) < len(target) // 5
    if np.bincount(target[aside], minlength=2).min() < LEAST_ASIDE:
        aside[:] = False  # too few to fit a curve on: the curve then sees the training texts
    squares, weight_squares = np.full(table.shape, 1e-8), np.full(weights.shape, 1e-8)
    mask = passages >= 0
    lengths = mask.sum(axis=1)

    def word_vectors(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        spans = sizes[ids]
        firsts = np.cumsum(spans) - spans
        flat = np.repeat(starts[ids] - firsts, spans) + np.arange(spans.sum())
        return np.add.reduceat(table[buckets[flat]], firsts, axis=0) / spans[:, None], buckets[flat], spans

    def odds() -> np.ndarray:
        each = np.zeros(len(vocabulary) + 1)
        each[:-1] = _means((table @ (weights[:, 1] - weights[:, 0]))[buckets], starts, len(buckets))
        return each[passages].sum(axis=1) / lengths + bias[1] - bias[0]

    usable = ~aside[owner]
    batch = batch or int(np.clip(usable.sum() // 64, 64, 2048))  # many steps on few passages, too
    for epoch in range(epochs):
        chosen = usable.copy()
        if epoch >= 2:
            toxic = np.flatnonzero(usable & (target[owner] == 1))
            ranked = toxic[np.lexsort((-odds()[toxic], owner[toxic]))]
            place = np.arange(len(ranked)) - np.searchsorted(owner[ranked], owner[ranked])
            chosen[ranked[place >= 2]] = False
        order = rng.permutation(np.flatnonzero(chosen))
        share = np.bincount(target[owner[order]], minlength=2) / len(order)
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            ids, inverse = np.unique(passages[rows], return_inverse=True)
            inverse = inverse.reshape(len(rows), SPAN)
            blank = ids[0] == -1
            ids, inverse = ids[int(blank) :], inverse - int(blank)
            vectors, used, spans = word_vectors(ids)
            padded = np.vstack([vectors, np.zeros(DIMENSIONS)])
            mean = padded[inverse].sum(axis=1) / lengths[rows, None]
            logits = mean @ weights + bias
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            truth = target[owner[rows]]
            slope = chance
            slope[np.arange(len(rows)), truth] -= 1
            slope *= (0.5 / np.maximum(share[truth], 1e-3))[:, None]
            down = (slope @ weights.T) / lengths[rows, None]
            flat, live = inverse.ravel(), inverse.ravel() >= 0
            spread = np.repeat(down, SPAN, axis=0)[live]
            grad = np.stack([np.bincount(flat[live], spread[:, d], len(ids)) for d in range(DIMENSIONS)], axis=1)
            per_gram = np.repeat(grad / spans[:, None], spans, axis=0)
            touched, where = np.unique(used, return_inverse=True)
            step = np.stack([np.bincount(where, per_gram[:, d], len(touched)) for d in range(DIMENSIONS)], axis=1)
            squares[touched] += step**2
            table[touched] -= rate * step / np.sqrt(squares[touched])
            turn = mean.T @ slope
            weight_squares += turn**2
            weights -= rate * turn / np.sqrt(weight_squares)
            bias -= 0.01 * slope.mean(axis=0)
    model = Model(table @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0]), 1.0, 0.0)
    each = _means(model.shares[buckets], starts, len(buckets))
    tops = np.array([model._top(each[ids]) if len(ids) else model.bias for ids in numbered])
    rows = np.flatnonzero(aside) if aside.any() else np.arange(len(target))
    model.slope, model.offset = _calibrate(tops[rows], target[rows])
    return model


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (x, y), with a slight pull towards a flat one."""
    centre, scale = x.mean(), x.std() + 1e-9
    z, a, b = (x - centre) / scale, 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * z).sum() + 0.05 * a, (p - y).sum() + 0.01 * b])
        h = np.array([[(w * z * z).sum() + 0.05, (w * z).sum()], [(w * z).sum(), w.sum() + 0.01]])
        move = np.linalg.solve(h, g)
        a, b = a - np.clip(move[0], -2, 2), b - np.clip(move[1], -2, 2)
    return float(a / scale), float(b - a * centre / scale)


def bounded(text: Column, size: int) -> Column:
    """The text, or of one longer than ``size`` that many characters in evenly spread pieces."""
    piece = size // PIECES - 1  # and a blank
    step = (F.length(text) - piece) / (PIECES - 1)
    pieces = [F.substring(text, (step * k).cast("int") + 1, F.lit(piece)) for k in range(PIECES)]
    return F.when(F.length(text) <= size, text).otherwise(F.concat_ws(" ", *pieces))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 1200, max_chars: int = 4_000_000) -> Model:
    """Fit on labelled rows outside the held-out third.

    The sample is bounded: per class ``max_rows`` documents, the first by a hash
    of the id, and of these as many as have half of ``max_chars`` characters in all. A text
    of over ``LARGEST`` of that half counts with pieces of that size in all, so no
    text leaves the others without room, and a class of long texts only is still learnt. Rows
    without an id, a label or a text are not learnt from. An id with several labels
    counts as toxic if one says so.
    """
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic")
    )
    marks = marks.where(remainder(F.col("doc_id"), 3) != 1)
    parts = [marks.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows) for k in (0, 1)]
    wanted = parts[0].union(parts[1]).select(F.col("doc_id").cast("long").alias("_id"), "toxic")
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("_id"), "text")
    found = texts.join(F.broadcast(wanted), "_id")  # at most 2 * max_rows ids
    found = found.groupBy("_id", "toxic").agg(F.max("text").alias("text"))
    found = found.withColumn("text", bounded(F.col("text"), max(10 * PIECES, int(max_chars // 2 * LARGEST))))
    room = Window.partitionBy("toxic").orderBy(F.xxhash64("_id"), "_id").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("_room", F.sum(F.length("text")).over(room)).where(F.col("_room") <= max_chars // 2)
    rows = sorted(found.select("_id", "toxic", "text").collect())
    return fit([r.text for r in rows], [r.toxic for r in rows])


def remembered(mark: bytes) -> dict[bytes, float]:
    """The scores of words this Python worker has met with a model; only one model's are kept."""
    if mark not in _KNOWN:
        _KNOWN.clear()
    return _KNOWN.setdefault(mark, {})


def scorer(model: Model) -> Callable:
    mark = hashlib.sha256(model.shares.tobytes()).digest()

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = remembered(mark)
        for texts in batches:
            yield pd.Series(model.score(texts, known))

    return score


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (0 or 1) added for each row; every text is scored whole.

    Null and empty texts get the score of a text without words. Rows that
    repeat get equal scores. Columns named like the new ones are replaced. An
    empty table stays empty; without labels all scores are one low constant.
    """
    ready_for_python(docs.sparkSession)
    model = train(docs, labels)
    plain = new_names(docs, ["score", "predicted"])
    return plain.withColumn("score", scorer(model)("text")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns as they were.

    Null texts score as empty ones; rows that repeat score alike. Without labels every row stays. Columns may have any
    names; an empty table gives no rows.
    """
    ready_for_python(docs.sparkSession)
    return docs.where(scorer(train(docs, labels))("text") < threshold)

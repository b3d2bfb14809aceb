"""Toxicity and language-model scores."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tomegauge.llm import catalog, language_model, toxicity


def marked(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


def test_toxicity_on_misspellings_never_seen():
    draw = np.random.default_rng(5)
    stems, tails = ["plorgi", "zwackel", "murnto"], ["", "ing", "s", "aro", "ette", "ix", "um", "ola"]

    def text(toxic, endings):
        found = ["".join(draw.choice(list("aeioustrnl"), draw.integers(2, 8))) for _ in range(draw.integers(20, 200))]
        for _ in range(toxic):
            found[draw.integers(len(found))] = str(draw.choice(stems)) + str(draw.choice(endings))
        return " ".join(found)

    labels = [int(k % 4 == 0) for k in range(600)]
    model = toxicity.fit([text(3 * y, tails[:5]) for y in labels], labels)
    scores = model.score(pd.Series([text(3 * y, tails[5:]) for y in labels]), {})
    truth = np.array(labels, dtype=bool)
    assert (scores[truth] >= 0.7).mean() > 0.75 and (scores[~truth] >= 0.7).mean() < 0.03
    assert model.score(pd.Series([None, "", " \n", "12 34"]), {}).max() < 0.5


def test_toxicity_without_both_labels(spark, odd, empty):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    found = toxicity.scored(odd, none)
    assert set(odd.columns) | {"score", "predicted"} == set(found.columns)
    assert [r.predicted for r in found.collect()] == [0] * odd.count()
    assert toxicity.scored(empty, none).count() == 0
    assert toxicity.without_toxic(odd, none).columns == odd.columns


def test_toxicity_query(spark, folder, texts):
    rows = catalog.op6_toxicity(spark, folder).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        assert r.held_out == (marked(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    assert rows and sorted(map(tuple, rows)) == sorted(map(tuple, catalog.op6_toxicity(spark, folder).collect()))


def test_toxicity_never_learns_from_held_out_rows(spark, make):
    docs = make(*[(k, "fine words here" if k % 2 else "vile words here") for k in range(200)])
    labels = spark.createDataFrame([(k, int(marked(k, 3) == 1)) for k in range(200)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels).slope == 0.0  # all rows it may see have one label


@pytest.mark.parametrize("huge", [{0}, {1}, {0, 1}])
def test_toxicity_learns_despite_huge_texts(spark, make, huge):
    order = [r.id for r in spark.range(300).orderBy(F.xxhash64("id"), "id").collect()]
    first = {k: next(i for i in order if i % 2 == k and marked(i, 3) != 1) for k in huge}
    said = ["fine words here", "vile words here"]
    docs = make(*[(i, f"{said[i % 2]} n{i} " * (8000 if first.get(i % 2) == i else 3)) for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, max_chars=100_000)
    clean, toxic = model.score(pd.Series(said), {})
    assert clean < 0.3 and toxic > 0.7


def test_toxicity_learns_from_huge_texts_only(spark, make):
    said = ["fine words here ", "vile words here "]
    docs = make(*[(i, said[i % 2] * 1000) for i in range(90)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id long, toxic int")
    clean, toxic = toxicity.train(docs, labels, max_chars=30_000).score(pd.Series(said), {})
    assert clean < 0.3 and toxic > 0.7
    text = "".join(chr(0x100 + k) for k in range(1000))
    cut = docs.select(toxicity.bounded(F.lit(text), 200).alias("a"), toxicity.bounded(F.lit(text), 1000).alias("b")).first()
    assert 180 <= len(cut.a) <= 200 and cut.a[:9] == text[:9] and cut.a[-9:] == text[-9:] and cut.b == text


class Backoff:
    """The same model, recursively, on the words themselves."""

    def __init__(self, texts, order, least):
        self.counts = Counter(w for t in texts for w in t)
        self.n, self.v = sum(self.counts.values()), len(self.counts)
        grams = Counter()
        for t in texts:
            line = ["<s>", *t]
            grams.update(tuple(line[k : k + n]) for n in range(2, order + 1) for k in range(len(line) - n + 1))
        self.kept = {g: c for g, c in grams.items() if c >= least}
        self.times = {(w,): c for w, c in self.counts.items()} | {("<s>",): self.counts["</s>"]} | self.kept
        self.after = defaultdict(list)
        for g in self.kept:
            self.after[g[:-1]].append(g)

    def chance(self, context, word):
        if not context:
            return (self.counts[word] + 1) / (self.n + self.v + 1)
        shorter = self.chance(context[1:], word)
        if context not in self.after:
            return shorter
        own = max(self.kept.get((*context, word), 0.5) - 0.5, 0) / self.times[context]
        return own + (1 - sum((self.kept[g] - 0.5) / self.times[context] for g in self.after[context])) * shorter

    def score(self, text, order):
        line = ["<s>", *text]
        return sum(math.log10(self.chance(tuple(line[max(0, k - order + 1) : k]), line[k])) for k in range(1, len(line)))


def cut(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()), "</s>"]


@pytest.mark.parametrize(("order", "least", "group", "heavy"), [(3, 2, 1 << 20, 1 << 20), (3, 2, 3000, 1 << 20), (3, 2, 1 << 20, 20), (3, 2, 3000, 20), (4, 3, 10_000, 100), (2, 1, 50_000, 5), (1, 2, 9000, 50)])
def test_language_model_against_recursion(documents, texts, order, least, group, heavy):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    found = {r.doc_id: r for r in language_model.scores(documents, ~held_out, order, least, group, heavy).collect()}
    tokens = {d: cut(t) for d, t in texts.items()}
    model = Backoff([t for d, t in tokens.items() if marked(d, 7) != 2], order, least)
    for doc_id, text in tokens.items():
        row = found[doc_id]
        assert (row.n_tokens, row.train_tokens, row.n_known) == (len(text), model.n, sum(model.counts[w] > 0 for w in text))
        assert row.base_score == pytest.approx(sum(math.log10((model.counts[w] + 1) / (model.n + model.v + 1)) for w in text))
        assert row.score == pytest.approx(model.score(text, order))
    words = [w for w, c in model.counts.items() if c > 0]
    for context in [(), ("<s>",), *list(model.after)[:5]]:
        unknown = model.chance(context, "never seen")
        assert sum(model.chance(context, w) for w in words) + unknown == pytest.approx(1)


def test_language_model_beats_unigrams_on_held_out_texts(spark, folder):
    rows = [r for r in catalog.op4_lm_scores(spark, folder).collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_language_model_keeps_what_occurs_twice_in_any_corpus(make):
    """What is seen twice counts as much among many other texts as among few."""
    twice, once = "alpha beta gamma delta epsilon zeta eta theta", "iota kappa lambda mu nu xi omicron pi"
    gains = []
    for others in (10, 2000):
        rows = [(0, twice), (1, twice), (2, once), *[(3 + k, " ".join(f"w{(k * 31 + j * j * 7) % 5003}" for j in range(20))) for k in range(others)]]
        found = {r.doc_id: r.score - r.base_score for r in language_model.scores(make(*rows), F.lit(True)).collect()}
        assert found[0] == found[1] > found[2] + 8
        gains.append(found[0])
    assert gains[1] > gains[0]


def test_language_model_on_odd_rows(odd, empty):
    rows = language_model.scores(odd, F.lit(True)).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r.score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    untrained = language_model.scores(odd, F.lit(False)).collect()
    assert {(r.score, r.base_score, r.n_known, r.train_tokens) for r in untrained} == {(0.0, 0.0, 0, 0)}
    assert language_model.scores(empty, F.lit(True)).count() == 0

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tomegauge.llm import hashing, near_dedup
from tomegauge.llm.components import components


def brute(texts, width, percent):
    """doc_id → (set size, least doc_id reachable)."""
    sets, lists, root = {}, defaultdict(list), {}
    for doc_id, text in texts.items():
        words = (text or "").encode().lower().split()
        cut = {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
        sets[doc_id], root[doc_id] = cut, doc_id
        for item in cut:
            lists[item].append(doc_id)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for one, cut in sets.items():
        for two, both in Counter(d for item in cut for d in lists[item] if d < one).items():
            if both * 100 >= percent * (len(cut) + len(sets[two]) - both):
                a, b = sorted((find(one), find(two)))
                root[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


def rows(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in frame.collect()}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_documents_against_brute_force(documents, texts, width, percent):
    expected = {d: (n, c, c == d) for d, (n, c) in brute(texts, width, percent).items()}
    assert rows(near_dedup.near_duplicates(documents, width, percent)) == expected


def test_chains_and_large_groups(make):
    draw = random.Random(4)
    base = [f"w{draw.randrange(10**6)}" for _ in range(160)]
    made = [(k, " ".join(base)) for k in range(40)]
    for k in range(40, 140):
        words = base.copy()
        for _ in range(draw.randrange(1, 9)):
            words[draw.randrange(len(words))] = f"n{draw.randrange(10**6)}"
        made.append((k, " ".join(words)))
    chain = [f"c{k}" for k in range(200)]
    made += [(200 + k, " ".join(chain[k * 3 : k * 3 + 80])) for k in range(20)]
    made += [(300, " ".join(base).upper()), (301, "two words"), (302, "Two  WORDS"), (303, "words two")]
    expected = {d: (n, c, c == d) for d, (n, c) in brute(dict(made), 3, 85).items()}
    assert rows(near_dedup.near_duplicates(make(*made))) == expected
    kept = near_dedup.dedup(make(*made), 3, 85)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, v in expected.items() if v[2])


def test_estimate_from_union_sketches(spark):
    draw = random.Random(9)
    texts, pairs = [], []
    for k in range(0, 800, 2):
        words = [f"w{draw.randrange(10**7)}" for _ in range(draw.randrange(60, 200))]
        share = draw.choice([0.45, 0.55, 0.65, 0.8])
        texts += [(k, " ".join(words)), (k + 1, " ".join(words[: round(len(words) * share)]))]  # one holds the other
        pairs.append((k, k + 1))
    sets = spark.createDataFrame(texts, "node long, text string").mapInArrow(near_dedup._sets(3), "node long, items array<long>")
    kept = near_dedup._estimated(spark.createDataFrame(pairs, "a long, b long"), sets, 80).collect()
    expected = set()
    for a, b in pairs:
        x, y = (hashing.shingle_set(texts[k][1], 3)[: near_dedup.SKETCH].tolist() for k in (a, b))
        union = sorted(set(x) | set(y))[: near_dedup.SKETCH]
        if len(set(union) & set(x) & set(y)) >= len(union) * (0.8 - near_dedup.SLACK):
            expected.add((a, b))
    assert {(r.a, r.b) for r in kept} == expected and 100 < len(expected) < 400


def test_odd_rows(odd, empty, inner_names):
    found = near_dedup.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in found)
    assert [g for g in got if g[0] in (0, 1, 2, 3, 6)] == [(0, 4, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (6, 5, 5, False)]
    left = near_dedup.dedup(odd, 3, 85)
    assert left.columns == odd.columns
    assert all(row[name] == name for row in left.collect() for name in inner_names)
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 5, 7]
    assert near_dedup.near_duplicates(empty).count() == near_dedup.dedup(empty).count() == 0


def test_components(spark):
    draw = random.Random(1)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(300)] + [(k, k + 1) for k in range(500, 560)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    found = components(spark.createDataFrame(links + links[:9], "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_do_not_depend_on_place_or_pieces(monkeypatch):
    text = " ".join(f"word{k % 50}\t\n" for k in range(3000)).encode()
    whole, starts, ends = hashing.words(text)
    assert [text[a:b] for a, b in zip(starts, ends, strict=True)] == text.split()
    assert len(set(whole.tolist())) == 50
    monkeypatch.setattr(hashing, "CHUNK", 64)
    again = hashing.words(text)
    assert all((x == y).all() for x, y in zip((whole, starts, ends), again, strict=True))
    assert (hashing.words(b"x" * 500 + b" y")[1] == [0, 501]).all()

"""Periodic runs, hard negatives and URL filters against brute force and SQL."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from oracle_check import connect, differences
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tomegauge.llm import catalog, hard_negatives, runs, url_filters

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Periodic runs


def every_run(words, least=6, times=4):
    """By the definition: each maximal stretch with a period, its smallest."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            stretch = words[at : end + q]
            if len(stretch) >= max(least, times * q) and not any(
                all(x == y for x, y in zip(stretch, stretch[p:], strict=False)) for p in range(1, q)
            ):
                found.append((at, len(stretch), q))
            at = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def looped(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def kept(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def invented_texts(draw, count):
    texts = []
    for _ in range(count):
        words = [draw.choice("abc") for _ in range(draw.randrange(40))]
        for _ in range(draw.randrange(4)):
            unit = [draw.choice("abcdefg") for _ in range(draw.choice([1, 2, 3, 5, 6, 7, 18, 19, 30]))]
            many = unit * draw.randrange(1, 8)
            words += many[: len(many) - draw.randrange(len(unit))] + [draw.choice("ab") for _ in range(draw.randrange(9))]
        texts.append(" ".join(words))
    return texts


def test_runs_against_the_definition(make):
    draw = random.Random(3)
    texts = invented_texts(draw, 300) + ["a " * 500, "a b " * 400 + "a", "", "x", "a a a a a", "a a a a a a", ("a b c d e f g h " * 9 + "z ") * 5]
    found = runs.periodic_runs(make(*enumerate(texts))).collect()
    assert len(found) == len(texts)
    for row in found:
        words = texts[row.doc_id].split()
        expected = every_run(words)
        assert [tuple(r) for r in row.runs] == expected and row.n_words == len(words)
        assert row.collapsed == kept(words, expected) and row.source == "src"


@pytest.mark.parametrize(("least", "times"), [(2, 2), (9, 3), (30, 4), (8, 2), (6, 5)])
def test_runs_of_other_bounds(least, times):
    texts = [t.encode() for t in invented_texts(random.Random(least), 120)]
    counts, found = runs.search(texts, least, times)
    for text, count, own in zip(texts, counts, found, strict=True):
        assert count == len(text.split()) and own == every_run(text.split(), least, times)


@pytest.mark.parametrize(("least", "times"), [(6, 4), (2, 2), (50, 4), (7, 3)])
def test_grams_fit_their_classes(least, times):
    found = list(runs.classes(10**6, least, times))
    lags = [range(low, gram + 1) for low, gram in found]
    assert [q for own in itertools.islice(lags, 4) for q in own] == list(range(1, found[3][1] + 1))
    for low, gram in found[:4]:
        assert all(max(least, times * q) - q >= gram >= q for q in range(low, gram + 1))


def test_a_long_loop_is_searched_in_linear_time(make):
    long = " ".join(f"w{k % 1000}" for k in range(400_000))
    one = " ".join(["same"] * 400_000)
    found = {r.doc_id: r for r in runs.periodic_runs(make((1, long), (2, one))).collect()}
    assert [tuple(r) for r in found[1].runs] == [(0, 400_000, 1000)] and len(found[1].collapsed.split()) == 1000
    assert [tuple(r) for r in found[2].runs] == [(0, 400_000, 1)] and found[2].collapsed == "same"


def test_runs_of_odd_tables(odd, empty):
    found = runs.periodic_runs(odd.withColumn("runs", F.lit("x")).withColumn("row", F.lit("mine")))
    rows = found.collect()
    assert len(rows) == odd.count() and {r.row for r in rows} == {"mine"} and {r.size for r in rows} == {"size"}
    assert all(r.runs == [] for r in rows if r.doc_id != 4)
    assert sorted((r.doc_id or 0, r.n_words) for r in rows)[:3] == [(0, 6), (1, 0), (2, 0)]
    assert runs.digests(runs.periodic_runs(runs.with_loops(empty))).count() == 0
    assert runs.digests(runs.periodic_runs(runs.with_loops(odd))).count() == odd.count()


def test_run_query_against_brute_force(spark, folder, texts):
    rows = {r.doc_id: r for r in catalog.op11_periodic_runs(spark, folder).collect()}
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        words = looped(doc_id, WORD.findall(text or ""))
        found, row = every_run(words), rows[doc_id]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert row.n_runs == len(found)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(kept(words, found).encode()).hexdigest()
        if found:
            start, length, q = min(found, key=lambda r: (-r[1], r[0], r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (start, length, q, 1000 * length // q)
        else:
            assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4
    assert sum(r.n_runs > 0 for r in rows.values()) > 5


# Hard negatives


def mined(rows):
    """By the definition, over (vec_id, label, whole components, is an anchor)."""
    found = []
    for anchor, label, vector, asked in rows:
        if not asked:
            continue
        order = lambda r: (-r[0], r[1])
        scored = [(sum(int(a) * int(b) for a, b in zip(vector, v, strict=False)), i, own) for i, own, v, _ in rows]
        for positive, positive_id, _ in sorted((s for s in scored if s[2] == label and s[1] != anchor), key=order)[:5]:
            fits = sorted((s for s in scored if s[2] != label and 80 * positive <= 100 * s[0] <= 100 * positive), key=order)[:5]
            found += [(anchor, positive_id, k + 1, i, positive, s) for k, (s, i, _) in enumerate(fits)]
    return sorted(found)


def vectors_of(spark, rows):
    kinds = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("rank", T.StringType())])
    return spark.createDataFrame([(*row, "x") for row in rows], kinds)


@pytest.mark.parametrize("grid", [None, (1, 1), (3, 4)])
def test_hard_negatives_against_brute_force(spark, grid):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(3, 19))
    rows = [(k, [float(x) for x in np.float32((centres[k % 3] + draw.normal(size=19) * 0.5) / 4)], k % 4) for k in range(260)]
    rows += [(k, rows[7][1], 1) for k in range(300, 312)] + [(k, rows[7][1], 2) for k in range(312, 330)]  # ties
    found = hard_negatives.hard_negatives(vectors_of(spark, rows), F.col("vec_id") % 10 == 0, F.col("label"), grid=grid)
    plain = [(i, label, [int(np.floor(256 * x)) for x in v], i % 10 == 0) for i, v, label in rows]
    assert sorted(map(tuple, found.collect())) == mined(plain)


def test_scores_are_exact_integers():
    draw = np.random.default_rng(6)
    for dims, high, kind in ((64, 255, np.int32), (7, 1, np.int32), (9, 1 << 27, np.int64)):
        values = draw.integers(-high, high, (50, -(-dims // 8) * 8))
        values[:, dims:] = 0
        values[0] = -high
        packed = hard_negatives.planes(values, int(high).bit_length() + 1)
        assert (hard_negatives.unpacked(packed) == values).all()
        assert (hard_negatives.scores(packed, hard_negatives.subset_sums(values[:20], kind)) == values @ values[:20].T).all()


def test_hard_negatives_of_odd_tables(spark):
    bad = [(0, None, 1), (10, [1.0, float("nan")], 1), (20, [1.0, None], 1), (30, [float("inf")], 1), (None, [1.0], 1), (40, [1.0], None)]
    good = [(50, [1.0, 2.0], 1), (51, [1.0, 2.0], 1), (52, [1.0, 1.9], 2), (53, [1.0], 2), (54, [], 1), (50, [1.0, 2.0], 1), (60, [-1.0, 0.0], 3), (61, [1.0, 0.0], 3)]
    ask = lambda rows: hard_negatives.hard_negatives(vectors_of(spark, rows), F.col("vec_id") % 10 == 0, F.col("label"))
    plain = {i: (i, label, [int(np.floor(256 * x)) for x in v], i % 10 == 0) for i, v, label in good}
    assert sorted(map(tuple, ask(bad + good).collect())) == mined(list(plain.values())) != []
    assert ask([]).count() == ask(bad).count() == ask(good[:1]).count() == 0
    with pytest.raises(ValueError, match="too large"):
        ask([(0, [1e30], 1)])


# URL filters


def test_cascade_is_exact(spark):
    keys = spark.range(40_000).selectExpr("concat('k', id) as key")
    listed = keys.where("pmod(xxhash64(key), 3) = 0")
    cascade = url_filters.Cascade(listed.union(listed), keys.union(keys), 40_000)
    assert len(cascade.levels) >= 3
    wrong = keys.where(cascade.holds(F.col("key")) != (F.expr("pmod(xxhash64(key), 3) = 0")))
    assert wrong.count() == 0
    assert cascade.bytes() < 40_000


def verdict(url, rules):
    """By the definition, in plain Python."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    name = re.match(r"[^/?#]*", rest).group()
    start = re.match(r"[^?#]*", rest[len(name) :]).group()
    name = "".join(c.lower() if "A" <= c <= "Z" else c for c in name)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (name == h or name.endswith("." + h)) and start.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return name, start, best[2], best[3]


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


@pytest.mark.parametrize("filter_bytes", [url_filters.FILTER_BYTES, 300])
def test_verdicts_against_brute_force(spark, filter_bytes):
    draw = random.Random(4)
    hosts = [".".join(draw.choice(["a", "b", "www", "example", "com", "NET", "net", ""]) for _ in range(draw.randrange(1, 5))) for _ in range(60)]
    urls = [f"{draw.choice(['http', 'ftp', ''])}://{draw.choice(hosts)}{draw.choice(['', '/', '/en/', '/en', '/es/x', '/e?q=://', '#/en/', '?x=/en/'])}{draw.choice(['', 'a', '/b'])}" for _ in range(3000)]
    urls += [None, "", "no scheme", "://", "http://com", "a://b://com/en/", "http://" + "a." * 3000 + "com/" + "x" * 5000, "http://x.com/é漢/"]
    rules = {(draw.choice(hosts).lower(), draw.choice(["/", "/e", "/en/", "", "/es/x"])): draw.choice(["allow", "block"]) for _ in range(80)}
    rules = [(h, p, v) for (h, p), v in rules.items() if h] + [("", "/", "block"), (None, None, None)]
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'r' as row", "'f' as found", "'b' as best", "'p' as PATH")
    seen = []
    found = url_filters.judged(pages, frame, filter_bytes=filter_bytes, watch=seen.append).collect()
    plain = [r for r in rules if r[0]]
    assert len(found) == len(urls) and (len(seen) == 2) == (filter_bytes > 300)
    for row in found:
        assert (row.host, row.path, row.rule, row.verdict) == verdict(urls[row.page_id], plain)
        assert (row.row, row.found, row.best) == ("r", "f", "b")


def test_filters_of_odd_tables(spark):
    pages = spark.createDataFrame([(1, "http://x.com/"), (1, "http://x.com/"), (None, None)], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert sorted(map(tuple, url_filters.judged(pages.where("false"), rules).collect())) == []
    assert [r.verdict for r in url_filters.judged(pages, rules.where("false"), other="ask").collect()] == ["ask"] * 3
    assert [r.rule for r in url_filters.judged(pages, rules).orderBy("page_id").collect()] == [None, "com/", "com/"]
    twice = spark.createDataFrame([("com", "/", "allow"), ("COM", "/", "block"), ("com", "/", "other")], rules.schema)
    assert {r.verdict for r in url_filters.judged(pages.dropna(), twice).collect()} == {"block"}


@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_url_filters"])
def test_equals_sql(spark, folder, name):
    assert differences(catalog.queries()[name](spark, folder), connect(folder), catalog.oracle_sql()[name]) == []

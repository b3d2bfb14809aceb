import math
import re
import zlib
from collections import defaultdict

import pytest
from oracle_check import connect, differences
from pyspark.sql import functions as F
from tomegauge.llm import catalog, mixing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        loose = [s for s in order if s not in fixed]
        share = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in loose))
        over = [s for s in loose if share * weight[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return fixed | {s: share * weight[s] for s in loose}
        fixed |= {s: 3.0 * sizes[s] for s in over}


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, "c": 2, None: 3}, {"a": 0, "b": 5}, {"a": 0}, {"é": 7, "z": 1, "Z": 900, "~": 4, "b": 1}],
)
def test_targets(spark, sizes):
    found = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    assert {r.source: r.target for r in found.collect()} == pytest.approx(filled(sizes))


def test_mix_of_documents(spark, folder, documents):
    rows = catalog.op5_mix_sources(spark, folder).collect()
    source = {r.doc_id: r.source for r in documents.collect()}
    sums = defaultdict(lambda: [0, 0, 0.0])
    for r in rows:
        part = sums[source[r.doc_id]]
        part[0], part[1], part[2] = part[0] + r.size, part[1] + r.taken, r.target
        epochs = math.floor(r.target / r.source_size)
        assert epochs * r.size <= r.taken <= min(epochs + 1, 3) * r.size
    assert {s: v[2] for s, v in sums.items()} == pytest.approx(filled({s: v[0] for s, v in sums.items()}))
    assert all(abs(v[1] - v[2]) <= 0.5 for v in sums.values())
    again = catalog.op5_mix_sources(spark, folder)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again.collect()))


@pytest.mark.parametrize("name", ["op3_minhash_near_dedup", "op5_mix_sources", "op10_sharding"])
def test_equals_sql(spark, folder, name):
    assert differences(catalog.queries()[name](spark, folder), connect(folder), catalog.oracle_sql()[name]) == []


def test_heavier_documents_come_first(spark, make):
    docs = make(*[(k, "w " * 10, "a") for k in range(2000)], *[(k, "w " * 10, "b") for k in range(5000, 6000)])
    weight = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    taken = mixing.mix(docs, weight).where("source = 'a' and doc_id < 2000")
    even, odd = (taken.where(f"doc_id % 2 = {k}").agg(F.sum("taken")).first()[0] for k in (0, 1))
    assert even > 1.5 * odd


def test_mixed_rows(make, documents):
    copies = {r.doc_id: r.copies for r in mixing.mix(documents, mixing.text_quality(), whole=True).where("copies > 0").collect()}
    rows = mixing.mixed(documents)
    assert rows.columns == documents.columns
    assert {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()} == copies


def test_odd_rows(odd, empty, inner_names):
    found = mixing.mix(odd)
    assert found.count() == odd.count()
    assert all(r.taken <= 3 * r.size for r in found.collect())
    assert {r.doc_id: r.taken for r in found.collect()}[1] == 0
    assert mixing.mixed(odd).columns == odd.columns
    for result in (found, mixing.mixed(odd), sharding.shard(odd, 3)):
        assert all(row[name] == name for row in result.collect() for name in inner_names)
    sharded = sharding.shard(odd, 3, ranges=4).collect()
    assert len(sharded) == odd.count()
    assert sum(r["size"] for r in sharded) == sum(len((r.text or "").encode()) + 1 for r in odd.collect())
    for frame in (mixing.mix(empty), mixing.mixed(empty), sharding.shard(empty)):
        assert frame.count() == 0


@pytest.mark.parametrize("ranges", [1, 7, 50])
def test_shards(documents, ranges):
    rows = sorted(sharding.shard(documents, 8, ranges).collect(), key=lambda r: r.doc_id)
    sizes = [len((r.text or "").encode()) + 1 for r in rows]
    total, before, count = sum(sizes), 0, defaultdict(int)
    for r, size in zip(rows, sizes, strict=True):
        assert r["size"] == size
        assert r.shard == min(7, (2 * before + size) * 8 // (2 * total))
        assert r.slot == count[r.shard]
        before, count[r.shard] = before + size, count[r.shard] + 1


def test_sharding_query(spark, folder, texts):
    for r in catalog.op10_sharding(spark, folder).collect():
        assert r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) and r.law == "bytes" and r.grown_shard is None


def test_native(spark, folder, physical):
    for name in ("op5_mix_sources", "op10_sharding"):
        assert not re.search("Python|Pandas|Arrow|CartesianProduct", physical(catalog.queries()[name](spark, folder)))

"""Runs: stretches of words that repeat themselves at a period, and texts without the repeats.

A run of period q and at least ``least`` words and ``times`` periods equals itself, moved by q, over a stretch of a
guaranteed length. Grams of the smallest such length among a class of periods are indexed per document. As they are no shorter than
the periods of their class, the next place of a gram within a run lies just its period away, so
each place is paired with the next one only and a gram that occurs very often gives no more pairs than places. A pair is a
seed on the diagonal of its lag; it is extended both ways unless what was covered last on that lag holds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomegauge.llm.common import WORD, new_names, ready_for_python
from tomegauge.llm.hashing import _BASE, _INVERSE, mix, powers, seeded, words

#: Words and periods that a run has at least.
LEAST, TIMES = 6, 4
#: Bytes of texts searched together; a longer text is searched alone.
TOGETHER = 4 << 20
ADDED = ["n_words", "runs", "collapsed"]
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def classes(longest: int, least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, int]]:
    """Classes of periods, smallest period and length of the grams, which is also the greatest period, for texts of so many words."""
    low, turn = 1, least // times
    while max(least, times * low) <= longest:
        gram = min(max(least, times * q) - q for q in (low, max(low, turn), max(low, turn + 1)))
        yield low, gram
        low = gram + 1


def _equal(codes: np.ndarray, at: int, lag: int, step: int) -> int:
    """How far places from ``at`` on, forwards or backwards, equal those ``lag`` later."""
    far, width = 0, 16
    most = len(codes) - lag - at if step > 0 else at + 1
    while far < most:
        width = min(2 * width, most - far)
        first = at + far if step > 0 else at - far - width + 1
        differ = np.flatnonzero(codes[first : first + width] != codes[first + lag : first + lag + width])
        if len(differ):
            return far + int(differ[0] if step > 0 else width - 1 - differ[-1])
        far += width
    return far


def _extended(codes: np.ndarray, places: np.ndarray, lags: np.ndarray, gram: int) -> Iterator[tuple[int, int, int]]:
    """Start, length and period of the stretches that seeds grow to; the seeds in order of lag and place."""
    if not len(places):
        return
    # Of seeds side by side on a diagonal, the extension of the first covers the others.
    first = np.append(True, (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1))
    covered: dict[int, int] = {}
    for place, lag in zip(places[first].tolist(), lags[first].tolist(), strict=True):
        if place + gram <= covered.get(lag, 0):
            continue
        end = place + gram + _equal(codes, place + gram, lag, 1)
        start = place - _equal(codes, place - 1, lag, -1)
        covered[lag] = end
        yield start, end - start + lag, lag


def runs_of(codes: np.ndarray, documents: np.ndarray, longest: int, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """All runs of a sequence of codes, in which a code of its own ends each document; ``documents`` numbers them by place."""
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * powers(_BASE, len(codes)), out=sums[1:])
    back = powers(_INVERSE, len(codes) + 1)
    salt = seeded(int(documents[-1]) + 1 if len(documents) else 0, 77)
    at, found = np.arange(len(codes)), []
    for low, gram in classes(longest, least, times):
        at = at[at + gram <= len(codes)]
        grams = mix((sums[at + gram] - sums[at]) * back[at]) ^ salt[documents[at]]
        ordered = np.sort(grams)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            break
        spot = np.minimum(np.searchsorted(twice, grams), len(twice) - 1)
        met = twice[spot] == grams
        at, grams = at[met], grams[met]
        order = np.argsort(grams, kind="stable")
        places, same = at[order], grams[order][1:] == grams[order][:-1]
        lags = places[1:] - places[:-1]
        seeds = same & (lags >= low) & (lags <= gram)
        places, lags = places[:-1][seeds], lags[seeds]
        order = np.lexsort((places, lags))
        found += [r for r in _extended(codes, places[order], lags[order], gram) if r[1] >= max(least, times * r[2])]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one blank, of each run only those of its first period."""
    found = text.split()
    if runs:
        kept = np.ones(len(found), dtype=bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        found = [w for w, k in zip(found, kept.tolist(), strict=True) if k]
    return b" ".join(found)


def search(texts: list[bytes], least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, list[list[tuple[int, int, int]]]]:
    """Number of words and runs of each text."""
    hashes, starts, _ = words(b"\n".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, ends)
    counts = np.diff(upto, prepend=0)
    documents = np.repeat(np.arange(len(texts)), counts + 1)
    codes = np.empty(len(documents), dtype=np.uint64)
    stops = upto + np.arange(len(texts))
    inner = np.ones(len(codes), dtype=bool)
    inner[stops] = False
    codes[inner] = hashes
    codes[stops] = seeded(len(texts), 78)
    longest = int(counts.max(initial=0))
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in runs_of(codes, documents, longest, least, times):
        document = int(documents[start])
        runs[document].append((start - int(stops[document] - counts[document]), length, period))
    return counts, runs


def _search(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("bytes").to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= TOGETHER):
                    size, end = size + len(texts[end]), end + 1
                counts, runs = search(texts[at:end], least, times)
                shorter = [collapse(t, r) for t, r in zip(texts[at:end], runs, strict=True)]
                found = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(at, end - at), pa.array(counts, pa.int64()), pa.array(found, pa.list_(RUN)), pa.array(shorter, pa.binary())],
                    ["row", *ADDED],
                )
                at = end

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``n_words, runs, collapsed`` of the whole text.

    ``runs`` lists ``start, length, period`` of every stretch of consecutive words that has this smallest period,
    at least ``least`` words and ``times`` periods, and no neighbouring word that goes on with it; by start, then
    period, words counted from 0. ``collapsed`` has the words joined by one blank, without those
    that any run holds after its first period. Words are compared byte by byte. Null, empty and blank texts have no word, no run and an empty
    ``collapsed``. Rows that repeat are searched alike and kept, columns that have the
    added names are replaced, all others are kept; an empty table gives no rows. No shuffle; a text is searched in one task.
    """
    ready_for_python(docs.sparkSession)
    kept = new_names(docs, ["text", *ADDED])
    rows = docs.select(
        F.struct(*([F.col(f"`{c}`") for c in kept.columns] or [F.lit(None).alias("none")])).alias("row"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("bytes"),
    )
    inner = rows.schema["row"].dataType.simpleString()
    found = rows.mapInArrow(_search(least, times), f"row {inner}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary")
    columns = [F.col(f"row.`{c}`") for c in kept.columns]
    return found.select(*columns, "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def with_loops(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` in which one document in ten runs in a loop from some word on.

    With h the crc32 of the id as text and g = h div 10, a text of n words with h divisible by 10 has its
    word i, from a = g mod n on, replaced by word a + (i - a) mod p, where p = 1 + (n - a) div (3 + g mod 8). Its words are then
    joined by one blank; other texts, also those of a null id or without words, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = (h / 10).cast("long")  # exact: crc32 has 32 bits

    def looped(found):
        n = F.size(found)
        a = (g % n).cast("int")
        p = ((n - a) / (3 + g % 8)).cast("int") + 1
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(found, F.when(i < a, i).otherwise(a + (i - a) % p))), " ")

    cut = F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))  # bound once by the lambda
    new = F.get(F.transform(cut, lambda found: F.when(F.size(found) > 0, looped(found))), F.lit(0))
    return docs.withColumn("text", F.when(h % 10 == 0, F.coalesce(new, F.col("text"))).otherwise(F.col("text")))


def digests(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one (ties: smallest start, then period), and checksums of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"), F.col("_best.length").alias("length"),
        (-F.col("_best.period")).alias("period"), F.floor(F.col("_best.length") * 1000 / -F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

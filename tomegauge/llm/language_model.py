"""Language-model scores from a weighted backoff automaton.

N-grams are counted over all training documents. Those seen at least ``LEAST`` times, a number
that is the same for every corpus, become arcs, and their contexts states. With discounted counts,
an n-gram's probability is ``(count - DISCOUNT) / count of context`` plus the context's weight times the
probability one order down. The weight is what its arcs leave free, so that the probabilities of
all words sum to one, and it is what the failure arc to the shorter context costs. At the end of all failures
is the add-one unigram probability of the word. A text is scored in one traversal
from left to right that carries the state and adds up logarithms.

The automaton grows with the corpus and is nowhere held whole. Texts are dealt to groups of about ``GROUP`` tokens.
A group sends its distinct n-grams, one message per part, to the parts that count them, and each part
answers with the totals in the order it was asked, so keys travel once and totals take about a byte. The last word
of an n-gram is sent as its rank if it is one of the ``COMMON`` most frequent, else as its hash. With its answers
a group builds all states and arcs that its texts can reach. From trigrams on only n-grams are asked
for whose two parts were both kept, which loses none.

A part counts all n-grams of its contexts, so it knows what they leave free. A context with very many
n-grams is dealt to all parts, and its sums are added up over them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomegauge.llm import hashing
from tomegauge.llm.common import partitions_for, ready_for_python, stored

ORDER = 3
LEAST = 2
DISCOUNT = 0.5
#: Tokens of a group, and n-grams that a part counts in the mean; both are held by one task at a time.
GROUP, PART = 1 << 20, 1 << 22
#: A context with so many tokens, or this share of all where that is more, is dealt to all parts; so there are at most a million such contexts.
HEAVY, HEAVY_SHARE = PART // 4, 1e-6
#: Words that are sent by rank; two bytes hold it.
COMMON = 60_000
#: Stand for the end of a text, which is a token, and its start, which is only a context.
END, START = (int(x) for x in hashing.seeded(2, 97))
_NEXT = np.uint64(int(hashing.seeded(1, 98)[0]) | 1)

_CHUNKS = "group long, doc_ids array<long>, sizes array<int>, training array<boolean>, words binary, ids binary, tokens long, trained long, starts long"
_ASKED = "part int, group long, contexts binary, runs binary, last binary, others binary, counts binary"
_ANSWERS = (
    "group long, part int, totals binary, sums binary, kinds binary, seen long, "
    "heavy array<long>, split array<struct<context: long, total: long, kinds: long>>"
)


def text_tokens(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, and the end."""
    return np.append(hashing.words(hashing.fold(text))[0], np.uint64(END))


def pack(values: np.ndarray) -> bytes:
    """Numbers byte by byte of equal weight, compressed; their size comes first."""
    data = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(data).to_bytes(8, "little") + (pa.compress(data, codec="zstd", asbytes=True) if data else b"")


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.empty(0, kind)
    plain = np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(plain.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _chunked(group_tokens: int):
    """Texts to groups: the distinct words of a group, the most frequent first, and each token as a number of one."""

    def row(held: list[tuple[int | None, bool, np.ndarray]], number: int) -> pa.RecordBatch:
        words, ids, counts = np.unique(np.concatenate([tokens for _, _, tokens in held]), return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        task = TaskContext.get().partitionId()
        values = (task << 32 | number, [h[0] for h in held], [len(h[2]) for h in held], [h[1] for h in held], pack(words[order]),
                  pack(rank[ids]), len(ids), sum(len(h[2]) for h in held if h[1]), sum(h[1] for h in held))
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = ["group", "doc_ids", "sizes", "training", "words", "ids", "tokens", "trained", "starts"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, 0
        for batch in batches:
            for doc_id, training, text in zip(*(batch.column(c) for c in ("doc_id", "training", "text")), strict=True):
                held.append((doc_id.as_py(), training.as_py(), text_tokens(text.as_py())))
                size += len(held[-1][2])
                if size >= group_tokens:
                    yield row(held, number)
                    held, size, number = [], 0, number + 1
        if held:
            yield row(held, number)

    return run


@dataclass
class Deal:
    """How n-grams of one order are dealt to parts."""

    parts: int
    heavy: np.ndarray
    #: Common words by rank, and the same ascending by hash with their ranks.
    common: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    ascending: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    ranks: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def sent(self, words: np.ndarray) -> tuple[bytes, bytes]:
        """Words as ranks, 0 for those that follow as hashes."""
        at = np.minimum(np.searchsorted(self.ascending, words), len(self.ascending) - 1)
        found = self.ascending[at] == words
        return pack(np.where(found, self.ranks[at] + 1, 0).astype(np.uint16)), pack(words[~found])

    def received(self, ranks: bytes, others: bytes) -> np.ndarray:
        numbers = unpack(ranks, np.uint16).astype(np.int64)
        words = self.common[np.maximum(numbers, 1) - 1]
        words[numbers == 0] = unpack(others, np.uint64)
        return words

    def order(self, contexts: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the n-grams by part, equal contexts side by side, with the parts there are and where each begins."""
        key = np.where(np.isin(contexts, self.heavy), grams, contexts) if len(self.heavy) else contexts
        part = (hashing.mix(key) % np.uint64(self.parts)).astype(np.int32)
        places = np.argsort(part, kind="stable")
        found, begins = np.unique(part[places], return_index=True)
        return places, found, np.append(begins, len(places))


def extended(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of contexts with one word more."""
    return hashing.mix(contexts * _NEXT + words)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)


@dataclass
class Level:
    """The distinct n-grams of one order in a group, ascending by context and last word."""

    hashes: np.ndarray
    context: np.ndarray
    last: np.ndarray
    suffix: np.ndarray
    counts: np.ndarray
    #: Number of the n-gram that ends at each place, -1 where none does.
    ends: np.ndarray
    totals: np.ndarray = field(default_factory=lambda: np.empty(0))
    #: Of contexts of this order: total and number of the n-grams kept one order up.
    sums: np.ndarray = field(default_factory=lambda: np.empty(0))
    kinds: np.ndarray = field(default_factory=lambda: np.empty(0))


class Group:
    """The texts of a group as one sequence, a start before each, with their n-grams."""

    def __init__(self, row: dict) -> None:
        self.row = row
        hashes = np.append(unpack(row["words"], np.uint64), np.uint64(START))
        self.start = len(hashes) - 1
        self.ids = unpack(row["ids"], np.uint32).astype(np.int64)
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        begins = np.cumsum(self.sizes) - self.sizes
        self.sequence = np.insert(self.ids, begins, self.start)
        self.training = np.repeat(np.array(row["training"], dtype=bool), self.sizes + 1)
        seen = self.training & (self.sequence != self.start)
        counts = np.bincount(self.sequence[seen], minlength=len(hashes))
        number = np.arange(len(hashes))
        self.levels = [Level(hashes, np.zeros(len(hashes), np.int64), number, number, counts, self.sequence)]

    def grow(self, least: int) -> None:
        """The next order: from three words on, only n-grams whose two parts occur often enough.

        A context of which a text needs no n-gram has one that ends with the start and occurs nowhere,
        since what the context leaves free has to be asked for.
        """
        below = self.levels[-1]
        context, last = np.append(-1, below.ends[:-1]), self.sequence
        fits, real = (context >= 0) & (last != self.start), np.ones(len(last), dtype=bool)
        if len(self.levels) > 1:
            kept = np.append(below.totals >= least, False)
            fits &= kept[context]
            real = kept[below.ends]
            last = np.where(real, last, self.start)
        places = np.flatnonzero(fits)
        keys, first, number = np.unique(context[places] << 32 | last[places], return_index=True, return_inverse=True)
        ends = np.full(len(last), -1)
        ends[places] = np.where(real[places], number, -1)
        context, last = keys >> 32, keys & 0xFFFFFFFF
        hashes = extended(below.hashes[context], self.levels[0].hashes[last])
        counts = np.bincount(number[(self.training & real)[places]], minlength=len(keys))
        self.levels.append(Level(hashes, context, last, below.ends[places[first]], counts, ends))

    def _keys(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Context and key of each n-gram; a single word is its own context, and the start is not asked for."""
        level = self.levels[order - 1]
        if order == 1:
            return level.hashes[:-1], level.hashes[:-1]
        return self.levels[order - 2].hashes[level.context], level.hashes

    def questions(self, order: int, deal: Deal) -> Iterator[tuple]:
        contexts, grams = self._keys(order)
        places, parts, begins = deal.order(contexts, grams)
        for part, a, b in zip(parts.tolist(), begins[:-1], begins[1:], strict=True):
            at = places[a:b]
            runs = _runs(contexts[at])
            sizes = np.diff(np.append(runs, len(at))).astype(np.uint32)
            last = deal.sent(self.levels[0].hashes[self.levels[order - 1].last[at]]) if order > 1 else (None, None)
            yield part, self.row["group"], pack(contexts[at][runs]), pack(sizes), *last, pack(self.levels[order - 1].counts[at].astype(np.uint64))

    def answered(self, order: int, deal: Deal, answers: dict[int, dict], split: dict[str, np.ndarray]) -> None:
        """Take in the totals of one order and what its contexts keep."""
        contexts, grams = self._keys(order)
        places, parts, begins = deal.order(contexts, grams)
        level = self.levels[order - 1]
        level.totals = np.zeros(len(level.hashes), np.int64)
        below = self.levels[order - 2] if order > 1 else None
        if below is not None:
            below.sums, below.kinds = np.zeros(len(below.hashes)), np.zeros(len(below.hashes))
        for part, a, b in zip(parts.tolist(), begins[:-1], begins[1:], strict=True):
            at, answer = places[a:b], answers[part]
            level.totals[at] = unpack(answer["totals"], np.uint64).astype(np.int64)
            if below is not None:
                asked = level.context[at][_runs(level.context[at])]
                below.sums[asked], below.kinds[asked] = unpack(answer["sums"], np.uint64), unpack(answer["kinds"], np.uint64)
        if below is not None and len(split["context"]):
            at = np.minimum(np.searchsorted(split["context"], below.hashes), len(split["context"]) - 1)
            found = split["context"][at] == below.hashes
            below.sums[found], below.kinds[found] = split["total"][at[found]], split["kinds"][at[found]]


def _asking(order: int, deal: Deal):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                group = Group(row)
                for _ in range(order - 1):
                    group.grow(0)
                yield _questions(group, order, deal).to_batches()[0]

    return run


def _questions(group: Group, order: int, deal: Deal) -> pa.Table:
    columns = list(zip(*group.questions(order, deal), strict=True)) or [()] * 7
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "group", "contexts", "runs", "last", "others", "counts"])
    return pa.Table.from_batches([batch])


def _counting(order: int, deal: Deal, least: int, heavy_from: float):
    """A part: totals of its n-grams, those seen too rarely as 0, for each group that asked."""

    def run(asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        part = rows[0]["part"]
        heads = [unpack(r["contexts"], np.uint64) for r in rows]
        sizes = [unpack(r["runs"], np.uint32) for r in rows]
        grams = heads
        if order > 1:
            grams = [extended(np.repeat(h, k), deal.received(r["last"], r["others"])) for h, k, r in zip(heads, sizes, rows, strict=True)]
        runs = np.concatenate(sizes)
        counts = np.concatenate([unpack(r["counts"], np.uint64) for r in rows]).astype(np.int64)
        keys, first, number = np.unique(np.concatenate(grams), return_index=True, return_inverse=True)
        totals = np.zeros(len(keys), np.int64)
        np.add.at(totals, number, counts)
        contexts, head = np.unique(np.concatenate(heads), return_inverse=True)
        own = np.repeat(head, runs)[first]
        kept = totals >= least
        sums = np.zeros(len(contexts), np.int64)
        np.add.at(sums, own[kept], totals[kept])
        kinds = np.bincount(own[kept], minlength=len(contexts))
        given = np.where(kept, totals, 0)
        out, a, c = [], 0, 0
        for row, asked_grams, asked_heads in zip(rows, grams, heads, strict=True):
            b, d = a + len(asked_grams), c + len(asked_heads)
            out.append((row["group"], part, pack(given[number[a:b]].astype(np.uint64)), pack(sums[head[c:d]].astype(np.uint64)),
                        pack(kinds[head[c:d]].astype(np.uint64)), None, None, None))
            a, c = b, d
        # Heavy contexts are summed over all parts; of single words the most frequent are told.
        shared = np.flatnonzero(np.isin(contexts, deal.heavy)) if order > 1 else np.argsort(-sums, kind="stable")[: -(-COMMON // deal.parts)]
        if order == 1 and deal.parts > COMMON:
            shared = shared[sums[shared] >= heavy_from]
        split = [{"context": int(contexts[k].astype(np.int64)), "total": int(sums[k]), "kinds": int(kinds[k])} for k in shared]
        out.append((None, part, None, None, None, int((totals > 0).sum()), keys[totals >= heavy_from].astype(np.int64).tolist(), split))
        kind = pa.struct([("context", pa.int64()), ("total", pa.int64()), ("kinds", pa.int64())])
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 3, pa.int64(), pa.list_(pa.int64()), pa.list_(kind)]
        names = ["group", "part", "totals", "sums", "kinds", "seen", "heavy", "split"]
        return pa.table([pa.array(x, k) for x, k in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return run


@dataclass
class Counted:
    """What the parts answered about one order."""

    deal: Deal
    answers: DataFrame
    heavy: np.ndarray
    split: dict[str, np.ndarray]

    @staticmethod
    def of(asked: DataFrame, order: int, deal: Deal, least: int, heavy_from: float) -> Counted:
        found = asked.groupBy("part").applyInArrow(_counting(order, deal, least, heavy_from), _ANSWERS)
        found = stored(found, f"totals-{order}", tidy=True)
        notes = found.where("group is null")
        heavy = notes.select(F.explode("heavy").alias("key")).toArrow().column("key").to_numpy()
        split = notes.select(F.inline("split")).groupBy("context").agg(F.sum("total").alias("total"), F.sum("kinds").alias("kinds")).toArrow()
        columns = {c: split.column(c).to_numpy().astype(np.int64) for c in split.column_names}
        columns["context"] = columns["context"].view(np.uint64)
        by = np.argsort(columns["context"])
        return Counted(deal, found, np.sort(heavy.astype(np.int64).view(np.uint64)), {c: v[by] for c, v in columns.items()})


@dataclass
class Automaton:
    """States are contexts, 0 the empty one, and arcs the n-grams kept.

    A state with a context of n words is left by an n-gram of n + 1 words that ends with the next word. The texts are
    known, so the arcs are laid out by place: ``gains[n]`` has the logarithm of the only arc that such a state can take there,
    not a number where it has none, and ``after`` the state that any arc at this place leads to.
    """

    sequence_base: np.ndarray
    gains: list[np.ndarray]
    after: np.ndarray
    length: list[int]
    fail: list[int]
    toll: list[float]

    def traverse(self, begin: int, end: int) -> float:
        """Log10 probability of the text whose start and tokens are at these places."""
        state, total = int(self.after[begin]), 0.0
        length, fail, toll = self.length, self.fail, self.toll
        base, after = self.sequence_base[begin:end].tolist(), self.after[begin:end].tolist()
        gains = [g[begin:end].tolist() for g in self.gains]
        for place in range(1, end - begin):
            while state:
                gain = gains[length[state]][place]
                if gain == gain:
                    total += gain
                    break
                total += toll[state]
                state = fail[state]
            else:
                total += base[place]
            state = after[place]
        return total


def build(group: Group, least: int, size: float, starts: int) -> Automaton:
    """All states and arcs that the texts of the group can reach; ``size`` is what unigrams are divided by."""
    levels, sequence = group.levels, group.sequence
    chance = [(levels[0].totals + 1) / size]
    fail, toll, length = [np.zeros(1, np.int64)], [np.zeros(1)], [0]
    gains: list[np.ndarray] = [np.empty(0)]
    target: list[np.ndarray] = []
    after = np.zeros(len(sequence), np.int64)
    occurs_below = weight_below = np.empty(0)
    for n, level in enumerate(levels):
        # States of this order: contexts that keep n-grams one order up.
        last = n + 1 == len(levels)
        is_state = np.zeros(len(level.hashes), dtype=bool) if last else level.kinds > 0
        shorter = target[n - 1][level.suffix] if n else np.zeros(len(level.hashes), np.int64)
        target.append(np.where(is_state, len(length) + np.cumsum(is_state) - 1, shorter))
        length += [n + 1] * int(is_state.sum())
        there = level.ends >= 0
        after[there] = target[n][level.ends[there]]
        occurs = level.totals.astype(float)
        if n == 0:
            occurs[group.start] = starts
        weight = np.ones(len(level.hashes))
        if not last:
            weight[is_state] = 1 - (level.sums[is_state] - DISCOUNT * level.kinds[is_state]) / occurs[is_state]
        fail.append(shorter[is_state])
        toll.append(np.log10(weight[is_state]))
        if n:
            kept = level.totals >= least
            own = np.zeros(len(kept))
            own[kept] = (level.totals[kept] - DISCOUNT) / occurs_below[level.context[kept]]
            chance.append(own + weight_below[level.context] * chance[n - 1][level.suffix])
            found = np.full(len(kept) + 1, np.nan)
            found[:-1][kept] = np.log10(chance[n][kept])
            gains.append(found[level.ends])
        occurs_below, weight_below = occurs, weight
    return Automaton(np.log10(chance[0])[sequence], gains, after, length, np.concatenate(fail).tolist(), np.concatenate(toll).tolist())


def _taken_in(chunk: pa.Table, answers: pa.Table, known: list[tuple[Deal, dict[str, np.ndarray]]], first: int, least: int) -> Group:
    """The group with its answers of the orders ``first``, ``first + 1`` and so on."""
    group = Group(chunk.to_pylist()[0])
    found: dict[int, dict[int, dict]] = {}
    for row in answers.to_pylist():
        found.setdefault(row["order"], {})[row["part"]] = row
    for order, (deal, split) in enumerate(known, 1):
        if order > 1:
            group.grow(least)
        if order >= first:
            group.answered(order, deal, found.get(order, {}), split)
    return group


def _asking_on(order: int, deal: Deal, known: list, least: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        group = _taken_in(chunk, answers, known, 2, least)
        group.grow(least)
        return _questions(group, order, deal)

    return run


def _scoring(known: list, least: int, size: float, starts: int, tokens: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        group = _taken_in(chunk, answers, known, 1, least)
        model = build(group, least, size, starts)
        base, seen = model.sequence_base[group.sequence != group.start], (group.levels[0].totals > 0)[group.ids]
        begins = np.cumsum(group.sizes) - group.sizes
        ends = np.cumsum(group.sizes + 1)
        paths = [model.traverse(b - n - 1, b) for b, n in zip(ends.tolist(), group.sizes.tolist(), strict=True)]
        columns = [pa.array(group.row["doc_ids"], pa.int64()), pa.array(group.sizes), pa.array(np.add.reduceat(seen.astype(np.int64), begins)),
                   pa.array(np.full(len(paths), tokens, np.int64)), pa.array(np.add.reduceat(base, begins)), pa.array(paths, pa.float64())]
        return pa.table(columns, names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def _met(chunks: DataFrame, counted: list[Counted], first: int, work: Callable, schema: str) -> DataFrame:
    """The groups with their answers of the orders from ``first`` on."""
    answers = [c.answers.where("group is not null").select("group", F.lit(k).alias("order"), "part", "totals", "sums", "kinds") for k, c in enumerate(counted, 1)]
    both = answers[first - 1]
    for more in answers[first:]:
        both = both.union(more)
    return chunks.groupBy("group").cogroup(both.groupBy("group")).applyInArrow(work, schema)


def _ranked(split: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The common words by rank, by hash, and the ranks by hash; the start is the first of all."""
    common = np.append(np.uint64(START), split["context"][np.argsort(-split["total"], kind="stable")][:COMMON])
    order = np.argsort(common)
    return common, common[order], order


def scores(docs: DataFrame, training: Column, order: int = ORDER, least: int = LEAST, group_tokens: int = GROUP, heavy: int = HEAVY) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from the rows for which ``training`` holds. Texts that are null or empty
    are one end token. ``score`` is the model's log10 probability of the text,
    ``base_score`` that of add-one unigrams. Without training rows all scores are 0.
    Rows that repeat are scored alike and count as often as they occur in training. Extra
    columns are ignored; an empty table gives no rows.
    """
    ready_for_python(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(training, F.lit(False)).alias("training"), "text")
    chunks = stored(source.mapInArrow(_chunked(group_tokens), _CHUNKS), "groups", tidy=True)
    total = chunks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "trained", "starts")]).first()
    parts = max(partitions_for(docs), -(-total.tokens // PART))
    heavy_from = max(heavy, HEAVY_SHARE * total.trained)
    counted: list[Counted] = []
    for n in range(1, order + 1):
        apart = counted[-1].heavy if n > 1 else np.empty(0, np.uint64)
        deal = Deal(parts, np.sort(np.append(apart, np.uint64(START))) if n == 2 else apart, *(_ranked(counted[0].split) if n > 1 else ()))
        if n < 3:
            asked = chunks.mapInArrow(_asking(n, deal), _ASKED)
        else:
            known = [(c.deal, c.split) for c in counted]
            asked = _met(chunks, counted, 2, _asking_on(n, deal, known, least), _ASKED)
        counted.append(Counted.of(asked, n, deal, 1 if n == 1 else least, heavy_from))
    distinct = counted[0].answers.agg(F.coalesce(F.sum("seen"), F.lit(0))).first()[0]
    known = [(c.deal, c.split) for c in counted]
    work = _scoring(known, least, float(total.trained + distinct + 1), total.starts, total.trained)
    return _met(chunks, counted, 1, work, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")

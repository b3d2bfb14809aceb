"""A wavelet matrix over token ids: one compressed file per shard.

The ids of a shard are numbered by rank among its distinct ids and stored as bit-planes,
the highest bit first; after each plane the ids with a 0 come before those with a 1, in
their order. Counts of ones per block, kept in the file, answer rank and select on a plane, and so
access to any position, the number of times a token occurs before a position, and
the place of its k-th occurrence, without unpacking the ids. Planes are compressed in pieces, and a look-up
unpacks only the piece it falls in.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Sequence

import numpy as np
import zstandard

MAGIC = b"WMTX0002"
#: Bits between two stored counts of ones.
BLOCK = 512
#: Bytes of a plane compressed together, a multiple of a block's.
PIECE = 1 << 15


class Plane:
    """Bits of one plane with counts of ones; pieces and counts are unpacked when they are asked for."""

    def __init__(self, size: int, zeros: int, counts: bytes, pieces: list[bytes]) -> None:
        self.size, self.zeros = size, zeros
        self._counts, self._pieces = counts, pieces
        self._before: np.ndarray | None = None
        self._open: dict[int, np.ndarray] = {}

    @staticmethod
    def pack(bits: np.ndarray, press: zstandard.ZstdCompressor) -> tuple[int, list[bytes]]:
        """Number of zeros; the compressed counts of ones before each block, and the compressed pieces."""
        packed = np.packbits(bits, bitorder="little")
        step = BLOCK // 8
        padded = np.zeros(-(-len(packed) // step) * step, dtype=np.uint8)
        padded[: len(packed)] = packed
        ones = np.bitwise_count(padded).reshape(-1, step).sum(axis=1, dtype=np.uint16)
        pieces = [press.compress(packed[at : at + PIECE].tobytes()) for at in range(0, len(packed), PIECE)]
        return len(bits) - int(ones.sum(dtype=np.int64)), [press.compress(ones.astype("<u2").tobytes()), *pieces]

    @property
    def before(self) -> np.ndarray:
        if self._before is None:
            ones = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._counts), dtype="<u2")
            self._before = np.concatenate([[0], np.cumsum(ones, dtype=np.int64)])
        return self._before

    def _piece(self, number: int) -> np.ndarray:
        if number not in self._open:
            self._open[number] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._pieces[number]), dtype=np.uint8)
        return self._open[number]

    def _block(self, block: int) -> np.ndarray:
        """The bytes of a block; none past the end."""
        at = block * (BLOCK // 8)
        if at // PIECE >= len(self._pieces):
            return np.empty(0, dtype=np.uint8)
        return self._piece(at // PIECE)[at % PIECE : at % PIECE + BLOCK // 8]

    def unpacked_pieces(self) -> int:
        return len(self._open)

    def bits(self) -> np.ndarray:
        unpack = zstandard.ZstdDecompressor()
        whole = np.frombuffer(b"".join(unpack.decompress(p) for p in self._pieces), dtype=np.uint8)
        return np.unpackbits(whole, count=self.size, bitorder="little")

    def bit(self, at: int) -> int:
        return int(self._block(at // BLOCK)[at % BLOCK >> 3]) >> (at & 7) & 1

    def ones(self, end: int) -> int:
        """Ones before a position."""
        block, last = end // BLOCK, end % BLOCK >> 3
        found = int(self.before[block])
        if end % BLOCK:
            own = self._block(block)
            found += int(np.bitwise_count(own[:last]).sum(dtype=np.int64))
            found += (int(own[last]) & ((1 << (end & 7)) - 1)).bit_count() if end & 7 else 0
        return found

    def select(self, bit: int, k: int) -> int:
        """Position of the k-th bit of a kind, from 0."""
        marks = self.before if bit else np.arange(len(self.before)) * BLOCK - self.before
        block = int(np.searchsorted(marks, k, side="right")) - 1
        start = block * BLOCK
        part = np.unpackbits(self._block(block), bitorder="little")[: self.size - start]
        return start + int(np.flatnonzero(part == bit)[k - int(marks[block])])


class WaveletMatrix:
    """The tokens of a shard and the documents they belong to, read from one file's bytes."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        (size,) = struct.unpack("<Q", data[8:16])
        head = json.loads(data[16 : 16 + size])
        at = 16 + size

        def take(length: int) -> bytes:
            nonlocal at
            at += length
            return data[at - length : at]

        unpack = zstandard.ZstdDecompressor()
        parts = [unpack.decompress(take(length)) for length in head["lengths"]]
        self.size = head["tokens"]
        self.alphabet = np.frombuffer(parts[0], dtype="<u4")
        ids, known = np.frombuffer(parts[1], dtype="<i8"), np.frombuffer(parts[2], dtype=np.uint8)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        self.starts = np.frombuffer(parts[3], dtype="<i8")
        self.planes = [
            Plane(self.size, zeros, take(counts), [take(length) for length in pieces]) for zeros, counts, *pieces in head["planes"]
        ]

    @staticmethod
    def pack(doc_ids: Sequence[int | None], documents: Sequence[np.ndarray]) -> bytes:
        """The file of a shard: its documents in order, each the array of its ids."""
        tokens = np.concatenate([*documents, np.empty(0, np.uint32)]).astype(np.uint32)
        if len(tokens) and int(tokens.max()) < max(1 << 20, len(tokens)):
            ranks = np.bincount(tokens) > 0  # the ids of a tokenizer: counted, not sorted
            alphabet = np.flatnonzero(ranks).astype(np.uint32)
            codes = (np.cumsum(ranks) - 1)[tokens]
        else:
            alphabet, codes = np.unique(tokens, return_inverse=True)
        codes = codes.astype(np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
        press, planes, heads = zstandard.ZstdCompressor(level=3), [], []
        for place in reversed(range(max(0, len(alphabet) - 1).bit_length())):
            bits = (codes >> place & 1).astype(bool)
            zeros, packed = Plane.pack(bits, press)
            heads.append([zeros, *map(len, packed)])
            planes += packed
            codes = np.concatenate([codes[~bits], codes[bits]])
        starts = np.concatenate([[0], np.cumsum([len(d) for d in documents])]).astype("<i8")
        ids = np.array([i or 0 for i in doc_ids], dtype="<i8")
        known = np.array([i is not None for i in doc_ids], dtype=np.uint8)
        parts = [press.compress(bytes(p)) for p in (alphabet.astype("<u4").tobytes(), ids.tobytes(), known.tobytes(), starts.tobytes())]
        head = json.dumps({"tokens": len(tokens), "lengths": [len(p) for p in parts], "planes": heads}).encode()
        return b"".join([MAGIC, struct.pack("<Q", len(head)), head, *parts, *planes])

    def tokens(self) -> np.ndarray:
        """All ids in order: the planes are undone from the last to the first."""
        codes = np.zeros(self.size, dtype=np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32)
        for place, plane in enumerate(reversed(self.planes)):
            bits = plane.bits().astype(bool)
            earlier = np.empty_like(codes)
            earlier[~bits] = codes[: plane.zeros]
            earlier[bits] = codes[plane.zeros :] | codes.dtype.type(1 << place)
            codes = earlier
        return self.alphabet[codes] if self.size else np.empty(0, np.uint32)

    def documents(self) -> list[tuple[int | None, int, np.ndarray]]:
        """Id, first position and tokens of each document."""
        found = self.tokens()
        return [(i, int(a), found[a:b]) for i, a, b in zip(self.doc_ids, self.starts[:-1], self.starts[1:], strict=True)]

    def access(self, at: int) -> int:
        """The id at a position."""
        code = 0
        for plane in self.planes:
            bit, ones = plane.bit(at), plane.ones(at)
            code, at = code << 1 | bit, plane.zeros + ones if bit else at - ones
        return int(self.alphabet[code])

    def _code(self, token: int) -> int | None:
        code = int(np.searchsorted(self.alphabet, token))
        return code if code < len(self.alphabet) and int(self.alphabet[code]) == token else None

    def rank(self, token: int, end: int) -> int:
        """Occurrences of a token before a position."""
        code = self._code(token)
        if code is None:
            return 0
        first = 0
        for place, plane in zip(reversed(range(len(self.planes))), self.planes, strict=True):
            if code >> place & 1:
                first, end = plane.zeros + plane.ones(first), plane.zeros + plane.ones(end)
            else:
                first, end = first - plane.ones(first), end - plane.ones(end)
        return end - first

    def count(self, token: int) -> int:
        return self.rank(token, self.size)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence of a token, from 0."""
        if not 0 <= k < self.count(token):
            raise IndexError("no such occurrence")
        code, first = self._code(token), 0
        for place, plane in zip(reversed(range(len(self.planes))), self.planes, strict=True):
            first = plane.zeros + plane.ones(first) if code >> place & 1 else first - plane.ones(first)
        at = first + k
        for place, plane in enumerate(reversed(self.planes)):
            bit = code >> place & 1
            at = plane.select(bit, at - plane.zeros if bit else at)
        return at

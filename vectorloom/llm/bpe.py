"""Byte-level BPE encoding and decoding with length-bucketed padded numpy matrices.

Texts are split by the public pattern; distinct pieces of a batch are encoded
together. Pieces of similar length form a padded matrix of token ids with one piece
a row. In each round every row merges its leftmost pair of minimum rank; the pair's
rank comes from a hashed table of all pairs whose concatenation is a token, and rows
are compacted after the merge. Rows without a pair left leave the matrix.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from vectorloom.llm.common import narrow, rows

NONE = np.int32(2**31 - 1)
#: Pieces over this many bytes are merged one at a time with a heap instead of in a matrix.
LONG_PIECE = 512


class Vocabulary:
    """Ranks of a byte-level BPE, and a hashed table from pairs of tokens to the rank of their merge."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        left, right, merged = [], [], []
        get = self.ranks.get
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a = get(token[:cut])
                if a is not None and (b := get(token[cut:])) is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.pairs = dict(zip(zip(left, right, strict=True), merged, strict=True))
        self._fill(np.array(left, np.int64) << 32 | np.array(right, np.int64), np.array(merged, np.int32))

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open addressing: each round places the keys whose slot is still free; the others try the next slot."""
        self.bits = max(10, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(left):
            self.probes += 1
            free = left[self.keys[slot[left]] == -1]
            self.keys[slot[free]] = keys[free]
            placed = free[self.keys[slot[free]] == keys[free]]
            self.values[slot[placed]] = values[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def merge_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's concatenation, NONE where it is no token."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot = self._slot(keys)
        out = self.values[slot]
        wrong = self.keys[slot] != keys
        out[wrong] = NONE
        todo = np.flatnonzero(wrong & (self.keys[slot] != -1))
        for _ in range(1, self.probes):
            if not len(todo):
                break
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[todo]] == keys[todo]
            out[todo[found]] = self.values[slot[todo[found]]]
            todo = todo[~found & (self.keys[slot[todo]] != -1)]
        return out

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[i] = [whole]
            elif len(piece) > LONG_PIECE:
                out[i] = self._encode_long(piece)
            elif piece:
                buckets.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for members in buckets.values():
            width = max(len(pieces[i]) for i in members)
            step = max(1, 2_000_000 // width)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for i, ids in zip(part, self._encode_bucket([pieces[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def _encode_bucket(self, pieces: list[bytes]) -> list[list[int]]:
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max())
        ids = np.full((len(pieces), width), -1, dtype=np.int32)
        inside = np.arange(width) < lengths[:, None]
        ids[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        ranks = np.full((len(pieces), width), NONE, dtype=np.int32)
        pair = inside[:, 1:]
        ranks[:, :-1][pair] = self.merge_ranks(ids[:, :-1][pair], ids[:, 1:][pair])
        out: list[list[int]] = [[]] * len(pieces)
        alive, row = np.arange(len(pieces)), np.arange(len(pieces))
        while True:
            at = ranks.argmin(axis=1)  # the leftmost of the minima
            least = ranks[row, at]
            over = least == NONE
            if over.any():
                for i, k, n in zip(alive[over].tolist(), ids[over], lengths[over].tolist(), strict=True):
                    out[i] = k[:n].tolist()
                go = ~over
                ids, ranks, lengths, alive, at, least = ids[go], ranks[go], lengths[go], alive[go], at[go], least[go]
                if not len(alive):
                    return out
                width = int(lengths.max())
                ids, ranks, row = ids[:, :width], ranks[:, :width], np.arange(len(alive))
            ids[row, at] = least
            # compaction: everything right of the merged pair moves one place to the left
            shift = np.arange(width - 1) > at[:, None]
            ids[:, :-1] = np.where(shift, ids[:, 1:], ids[:, :-1])
            ranks[:, :-1] = np.where(shift, ranks[:, 1:], ranks[:, :-1])
            lengths = lengths - 1
            ids[row, lengths] = -1
            ranks[row, lengths] = NONE
            ranks[row, np.maximum(lengths - 1, 0)] = NONE
            has = at + 1 < lengths
            ranks[row[has], at[has]] = self.merge_ranks(ids[row[has], at[has]], ids[row[has], at[has] + 1])
            has = at > 0
            ranks[row[has], at[has] - 1] = self.merge_ranks(ids[row[has], at[has] - 1], ids[row[has], at[has]])

    def _encode_long(self, piece: bytes) -> list[int]:
        """The same merges for one very long piece: a heap of (rank, place) over a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n, pairs = len(ids), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (r := pairs.get((rank, ids[after[j]]))) is not None:
                    heapq.heappush(heap, (r, i, rank, ids[after[j]]))
            if (h := before[i]) >= 0 and (r := pairs.get((ids[h], rank))) is not None:
                heapq.heappush(heap, (r, h, ids[h], rank))
        return [x for x in ids if x >= 0]


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary at path, read once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


class Encoder:
    """Encodes texts; keeps the ids of pieces that it has met, MOST of them at most."""

    MOST = 300_000

    def __init__(self, path: str, pattern: str):
        self.words, self.pattern, self.met = vocabulary(path), regex.compile(pattern), {}

    def encode(self, texts: list[str]) -> Iterator[list[list[int]]]:
        """For each text the ids of its pieces, as one list a piece."""
        if len(self.met) > self.MOST:
            self.met.clear()
        split = [self.pattern.findall(text) for text in texts]
        new = list({piece for pieces in split for piece in pieces}.difference(self.met))
        self.met.update(zip(new, self.words.encode_pieces([p.encode() for p in new]), strict=True))
        for pieces in split:
            yield [self.met[p] for p in pieces]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.words.tokens.__getitem__, ids))


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def slices(pairs: Iterator[tuple], chars: int = 1_000_000) -> Iterator[list[tuple]]:
    """Groups (key, text) rows so that a group has about so many characters: bounded memory."""
    group, size = [], 0
    for key, text in pairs:
        group.append((key, text or ""))
        size += len(group[-1][1])
        if size >= chars or len(group) >= 4096:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids: token ids of every text. Null texts are empty; an empty text has no ids. Repeated rows stay."""

    def run(batches):
        coder = encoder(path, pattern)
        for group in slices(rows(batches, key, text)):
            ids = [[i for piece in pieces for i in piece] for pieces in coder.encode([t for _, t in group])]
            yield pa.record_batch({key: pa.array([k for k, _ in group], pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32()))})

    return narrow(docs, **{key: "long", text: "string"}).mapInArrow(run, f"{key} long, ids array<int>")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, bytes: what the ids stand for. Null ids are an empty list."""

    def run(batches):
        tokens = vocabulary(path).tokens
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = [b"".join(map(tokens.__getitem__, x or ())) for x in part.column(1).to_pylist()]
                yield pa.record_batch({key: part.column(0), "bytes": pa.array(made, pa.binary())})

    return narrow(encoded, **{key: "long", ids: "array<int>"}).mapInArrow(run, f"{key} long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, then decodes the ids again, in one pass.

    The digest of the ids is over their decimal forms joined by commas.
    """

    def run(batches):
        coder = encoder(path, pattern)
        tokens = coder.words.tokens.__getitem__
        decimal = [str(i) for i in range(max(coder.words.tokens) + 1)].__getitem__
        for group in slices(rows(batches, "doc_id", "text")):
            n, ids_digest, text_digest = [], [], []
            for pieces in coder.encode([t for _, t in group]):
                ids = [i for piece in pieces for i in piece]
                n.append(len(ids))
                ids_digest.append(sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                text_digest.append(sha256(b"".join(map(tokens, ids))).hexdigest())
            yield pa.record_batch({"doc_id": pa.array([k for k, _ in group], pa.int64()), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": ids_digest, "decoded_sha256": text_digest})

    return narrow(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

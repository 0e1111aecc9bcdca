"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Only the number of pieces of each length matters to a packing, so the plan is made on
that histogram (capacity + 1 numbers at most, whatever the input), and pieces find
their place by their rank among the pieces of their length. Large pieces, above a
third of the capacity, are matched greedily, at most two to a sequence: the largest
left with the largest that still fits. Smaller pieces, longest first, then go to the
tightest gap that holds them, and open new sequences only where none does.
"""

from __future__ import annotations

import bisect
import re
from collections import defaultdict
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from tokenizers import Tokenizer

from vectorloom.llm.bpe import slices
from vectorloom.llm.common import narrow, rows, stored

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
LONG_RUN = 20_000
RUN = re.compile(rf"\s{{{LONG_RUN}}}|\S{{{LONG_RUN}}}")
_coders: dict[str, tuple] = {}


class Ids:
    """Ids as the tokenizers library gives them for the vocabulary file at path (add_special_tokens=False).

    Where the file is a plain byte-level BPE with the public split, tiktoken makes the
    same ids from the same vocabulary several times faster. Texts that hold the string
    of an added token, or a run of LONG_RUN characters that are all white space or all
    none, go through the tokenizers library itself: the other fails on very long runs.
    """

    def __init__(self, path: str, pattern: str):
        import json

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        self.slow = Tokenizer.from_file(path)
        self.added = [x["content"] for x in said.get("added_tokens", [])]
        back = _byte_letters()
        ranks = {bytes(back[c] for c in token): i for token, i in said["model"]["vocab"].items() if token not in self.added}
        split = said.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True) and not said.get("normalizer") and not said["model"].get("ignore_merges")
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) if plain else None

    def of(self, text: str) -> np.ndarray:
        if self.fast is None or any(x in text for x in self.added) or (len(text) >= LONG_RUN and RUN.search(text)):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(self.fast.encode_ordinary(text), dtype="<u4")


def _byte_letters() -> dict[str, int]:
    """The published byte-level alphabet: printable Latin-1 bytes stand for themselves, others for U+0100 upwards."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ids_of(path: str, pattern: str) -> Ids:
    if path not in _coders:
        _coders[path] = Ids(path, pattern)
    return _coders[path]


def pieces(docs: DataFrame, path: str, pattern: str, end_id: int, capacity: int) -> DataFrame:
    """One row a piece: documents' ids and end_id, cut to capacity where longer; the first piece takes the remainder.

    task and nth number the pieces of one length within a task, from 0.
    """

    def run(batches):
        coder, seen, task = ids_of(path, pattern), defaultdict(int), TaskContext.get().partitionId()
        for group in slices(rows(batches, "doc_id", "text")):
            out = []
            for doc_id, text in group:
                ids = np.append(coder.of(text), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    out.append((doc_id, k, a, b - a, crc32(ids[a:b].tobytes()), task, seen[b - a]))
                    seen[b - a] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return narrow(docs, doc_id="long", text="string").mapInArrow(run, SCHEMA)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places for counts[length] pieces of each length.

    Rows (length, rank, count, sequence, each, offset): the pieces of this length ranked
    rank .. rank + count - 1 go `each` to a sequence, from `sequence` on, at `offset`.
    A row covers any number of equal sequences, so their number depends on the lengths
    and not on the counts.
    """
    left, used, out = dict(counts), defaultdict(int), []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: ranges of sequences (first, number)
    sizes: list[int] = []  # the gaps that there are, ascending
    made = 0

    def place(length: int, n: int, sequence: int, each: int, offset: int) -> None:
        out.append((length, used[length], n, sequence, each, offset))
        used[length] += n
        left[length] -= n

    def gap(size: int, first: int, number: int) -> None:
        if number and size:
            if size not in gaps or not gaps[size]:
                bisect.insort(sizes, size)
            gaps[size].append((first, number))

    large = sorted((s for s in left if 3 * s > capacity and left[s]), reverse=True)
    waiting = sorted(large)
    for size in large:
        while left[size]:
            at = bisect.bisect_right(waiting, min(capacity - size, size)) - 1
            while at >= 0 and not left[waiting[at]]:
                waiting.pop(at)
                at -= 1
            other = waiting[at] if at >= 0 else 0
            n = left[size] if not other else left[size] // 2 if other == size else min(left[size], left[other])
            if not n:  # a single one of its size, of which two would fit: the next smaller one joins it
                at -= 1
                while at >= 0 and not left[waiting[at]]:
                    waiting.pop(at)
                    at -= 1
                other, n = (waiting[at], 1) if at >= 0 else (0, 1)
            place(size, n, made, 1, 0)
            if other:
                place(other, n, made, 1, size)
            gap(capacity - size - other, made, n)
            made += n
    for size in sorted((s for s in left if 3 * s <= capacity and left[s]), reverse=True):
        while left[size]:
            at = bisect.bisect_left(sizes, size)
            if at == len(sizes):
                each = capacity // size
                gap(capacity, made, -(-left[size] // each))
                made += -(-left[size] // each)
                continue
            room = sizes[at]
            first, number = gaps[room].pop()
            if not gaps[room]:
                sizes.pop(at)
            each = room // size
            full = min(number, left[size] // each)
            if full:
                place(size, full * each, first, each, capacity - room)
                gap(room - each * size, first, full)
            rest = left[size] if full < number else 0
            if rest:
                place(size, rest, first + full, rest, capacity - room)
                gap(room - rest * size, first + full, 1)
            gap(room, first + full + bool(rest), number - full - bool(rest))
    return out


def pack(docs: DataFrame, path: str, pattern: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Packs every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset, one row a piece.

    A null or empty text is end_id alone; repeated rows are packed each; an empty table
    gives no rows.
    """
    cut = stored(pieces(docs, path, pattern, end_id, capacity))
    spark = docs.sparkSession
    # ranks: what a task has of a length follows what the tasks before it have
    by_task = cut.groupBy("length", "task").agg(F.count("*").alias("n")).selectExpr("length", "task", "sum(n) over (partition by length order by task) - n as before")
    # capacity rows at most
    counts = {int(r.length): int(r.n) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    steps = defaultdict(list)
    for length, *step in plan(counts, capacity):
        steps[length].append(step)
    places = spark.sparkContext.broadcast({k: np.array(v, dtype=np.int64) for k, v in steps.items()})

    @pandas_udf("sequence_id long, offset long")
    def place_of(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sizes, ranks = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        order = np.argsort(sizes, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1) if len(sizes) else []:
            size = int(sizes[own[0]])
            rows_ = places.value[size]
            at = np.searchsorted(rows_[:, 0], ranks[own], side="right") - 1
            nth = ranks[own] - rows_[at, 0]
            sequence[own] = rows_[at, 2] + nth // rows_[at, 3]
            offset[own] = rows_[at, 4] + nth % rows_[at, 3] * size
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return (
        cut.join(by_task, ["length", "task"])
        .withColumn("at", place_of("length", F.col("nth") + F.col("before")))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
    )

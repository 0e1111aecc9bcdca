"""Shared by the operators that find repeated windows: a merged count-min sketch, and removal by runs.

Sketch: a window counts once a document. In each of the ROWS rows another gram of the
window stands for it (of least and of greatest hash), so that a window's estimate, the
least of its cells, asks both to be repeated. The sketch needs to tell only "once" from
"twice or more": partitions send the cells that they touched (at most twice each),
tasks merge them by block of cells, and what comes back is one bit a cell. Estimates
are never below the true count: no repeated window is lost. The sketch grows with the
input, about six cells an item. Up to MOST_BITS (64 MB) a row its bit maps are broadcast.
A larger one stays where it was merged: each chunk of texts sends its cells to the shards
of the sketch, and gets back those that are repeated (exchanged()).

Fragments: neighbouring windows that may be repeated and share a minimiser are one row.
Equal rows of a task are settled there, before the shuffle, so that copies of a
passage, however many, cost one row a task: all but those of the smallest document are
removed, and its places, as in text that repeats a few words on and on, are one row. The others go on to the exact grouping of their windows, dealt by minimiser.

Heavy keys: the first pass also sends a sample of fragments, by content, so that the
minimisers with many different ones around them (a line that is everywhere) are known
before anything is dealt. Their windows are dealt one by one, by their own hash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import binary_column, mixed, rows, runs_of, shared_windows, shuffles, written

ROWS, BLOCK_BITS, MOST_BITS = 2, 16, 29
#: Cells of a shard of a sketch that is not broadcast (a byte each while it is merged), and bytes of the texts that ask it together;
#: both grow with the sketch, by GROWTH doublings of the texts first and then by SHARD_GROWTH of the shards.
SHARD_BITS, CHUNK, GROWTH, SHARD_GROWTH = 24, 1_000_000, 5, 2
#: Items that a task holds before it sends their cells.
FLUSH = 3_000_000
#: Bytes of fragments that are solved at a time.
SLICE = 8_000_000
#: Bytes of fragments that a task combines before it sends them.
HELD = 24_000_000
#: Of the fragments of a table one in SAMPLE, by content, tells which keys are heavy; a key with less than HEAVY different ones in the sample is none.
SAMPLE, HEAVY = 64, 8


#: Low bits of an item that are not used, so that they can hold the number of its text.
SPARE = np.uint64(0xFFF)


def cells(items: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of each item (a mixed 64-bit hash) in a row of the sketch."""
    items = items & ~SPARE
    turned = items if row == 0 else (items << np.uint64(32) | items >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    return (turned >> np.uint64(64 - bits)).astype(np.uint32 if bits <= 32 else np.uint64)


def once_a_text(items: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The distinct items of each text (numbers under 4096)."""
    return np.unique(items & ~SPARE | text.astype(np.uint64))


def full_bits(items: float) -> int:
    """About six cells for each item that a row expects."""
    return int(max(BLOCK_BITS, np.ceil(np.log2(6 * max(items, 1)))))


def sketch_bits(items: float) -> int:
    """full_bits() of a sketch that is broadcast."""
    return min(MOST_BITS, full_bits(items))


class Maps(list):
    """Byte strings that are sent compressed: few cells are set, so bit maps shrink to a fraction."""

    def __reduce__(self):
        return unpacked, ([(len(x), pa.compress(x, codec="zstd", asbytes=True) if x else x) for x in self],)


def unpacked(packed: list[tuple[int, bytes]]) -> Maps:
    return Maps(pa.decompress(x, size, codec="zstd", asbytes=True) if x else x for size, x in packed)


def at_most_twice(found: np.ndarray) -> np.ndarray:
    """The values in order, none more than twice."""
    found = np.sort(found)
    third = np.concatenate([[False, False], found[2:] == found[:-2]])[: len(found)]
    return found[~third]


def reach(counts: np.ndarray, found: np.ndarray) -> None:
    """Adds sorted cells to counts that stop at two."""
    again = found[1:][found[1:] == found[:-1]]
    counts[found] = np.minimum(counts[found] + np.uint8(1), 2)
    counts[again] = 2


def often(packed: list[bytes], least: int) -> np.ndarray:
    """The keys of sampled fragments with so many contents; a content counts once for each time it is sent."""
    keys, number = np.unique(np.concatenate([np.frombuffer(x, dtype=np.uint64)[::2] for x in packed]), return_counts=True)
    return keys[number >= least]


def merged_sketch(df: DataFrame, items_of: Callable, bits: int, heavy: int = HEAVY) -> Broadcast:
    """Bit maps (ROWS x 2^bits) of the cells that two or more documents reach, then the sorted heavy keys.

    items_of(batches) yields ROWS arrays of hashes with one entry a document, and may
    yield a sample of fragments, rows of key and content, as one more: keys with `heavy`
    contents or more, each counted once a sending, are heavy.
    """
    spark = df.sparkSession

    def touched(batches):
        held, size = [], 0
        for items in items_of(batches):
            held.append(items)
            size += sum(map(len, items[:ROWS]))
            if size >= FLUSH:
                yield sent(held)
                held, size = [], 0
        if size:
            yield sent(held)

    def sent(held):
        blocks, packed = [], []
        for row in range(ROWS):
            found = at_most_twice(np.concatenate([cells(items[row], row, bits) for items in held]))
            number = found >> np.uint32(BLOCK_BITS)
            starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])[: len(found)])
            low = (found & np.uint32(2**BLOCK_BITS - 1)).astype("<u2")
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(found)], strict=len(found) > 0):
                blocks.append(row << 24 | int(number[a]))
                packed.append(low[a:b].tobytes())
        if len(held[0]) > ROWS:
            told = np.unique(np.concatenate([items[ROWS] for items in held]), axis=0)
            for k in range(64):
                if len(own := told[told[:, 0] >> np.uint64(58) == k]):
                    blocks.append(-1 - k)
                    packed.append(own.tobytes())
        return pa.record_batch({"block": pa.array(blocks, pa.int32()), "cells": pa.array(packed, pa.binary())})

    def merge(batches):
        counts: dict[int, np.ndarray] = {}
        told: dict[int, list[bytes]] = {}
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if block < 0:
                    told.setdefault(block, []).append(packed)
                    continue
                own = counts.get(block)
                if own is None:
                    own = counts[block] = np.zeros(2**BLOCK_BITS, dtype=np.uint8)
                reach(own, np.frombuffer(packed, dtype="<u2"))
        for block, found in told.items():
            if len(keys := often(found, heavy)):
                yield pa.record_batch({"block": pa.array([block], pa.int32()), "bits": pa.array([keys.tobytes()], pa.binary())})
        for block, own in counts.items():
            twice = np.packbits(own > 1)
            if twice.any():
                yield pa.record_batch({"block": pa.array([block], pa.int32()), "bits": pa.array([twice.tobytes()], pa.binary())})

    found = df.mapInArrow(touched, "block int, cells binary").repartition(shuffles(spark), "block").mapInArrow(merge, "block int, bits binary")
    maps = np.zeros((ROWS, 2**bits // 8), dtype=np.uint8)
    size, keys = 2**BLOCK_BITS // 8, []
    for block, packed in found.toLocalIterator():  # ROWS * 2^MOST_BITS bits at most, and as many keys as heavy_limit() says
        if block < 0:
            keys.append(np.frombuffer(packed, dtype=np.uint64))
            continue
        at = (block & 0xFFFFFF) * size
        maps[block >> 24, at : at + size] = np.frombuffer(packed, dtype=np.uint8)
    keys = np.sort(np.concatenate([np.empty(0, np.uint64), *keys]))
    return spark.sparkContext.broadcast(Maps([*(row.tobytes() for row in maps), keys.tobytes()]))


def heavy_limit(spark, items: float) -> int:
    """A key is heavy with a tenth of an even share of all fragments, so that there are ten heavy keys a partition at most."""
    return max(HEAVY, int(items / (10 * SAMPLE * shuffles(spark))))


def heavy_of(keys: np.ndarray, maps: list[bytes]) -> np.ndarray:
    """Whether the keys are heavy."""
    return within(keys, np.frombuffer(maps[ROWS], dtype=np.uint64))


class Marks(list):
    """The sorted repeated cells of a chunk for each row (None: not known, all pass), then the heavy keys as in Maps."""

    def __init__(self, parts, bits: int) -> None:
        super().__init__(parts)
        self.bits = bits


def within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether the values are among the sorted known ones."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values if len(known) else np.zeros(len(values), dtype=bool)


def estimated_repeated(items: np.ndarray, maps: list, row: int) -> np.ndarray:
    """Whether the items' cells in a row were reached twice or more."""
    if isinstance(maps, Marks):
        return within(cells(items, row, maps.bits).astype(np.uint64), maps[row]) if maps[row] is not None else np.ones(len(items), dtype=bool)
    bits = np.frombuffer(maps[row], dtype=np.uint8)
    cell = cells(items, row, (len(bits) * 8).bit_length() - 1)
    return (bits[cell >> np.uint32(3)] >> (np.uint8(7) - (cell & np.uint32(7)).astype(np.uint8)) & np.uint8(1)).astype(bool)


def window_items(grams: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """What the rows of a sketch count for the windows of a group of texts, and the sample of fragments."""
    out, sample = [], None
    for row in range(ROWS):
        at, low, high, text = shared_windows(grams, bounds, window, gram, most=row == 1)
        out.append(once_a_text(grams[at], text))
        if row == 0:
            content = mixed(grams[low] ^ mixed(grams[high + window - gram - 1] + (high - low).astype(np.uint64)))
            some = content % np.uint64(SAMPLE) == 0
            sample = np.stack([grams[at][some], content[some]], axis=1)
    return *out, sample


def repeated_runs(grams: np.ndarray, bounds: np.ndarray, window: int, gram: int, maps: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of windows whose estimate is two or more, among a group of texts."""
    flags = np.ones(max(0, len(grams)), dtype=bool)
    for row in range(ROWS):
        at, low, high, _ = shared_windows(grams, bounds, window, gram, most=row == 1)
        good = estimated_repeated(grams[at], maps, row)
        edges = np.zeros(len(grams) + 1, dtype=np.int32)
        edges[low[good]] += 1
        edges[high[good]] -= 1  # ranges of a row do not overlap, but one may end where another starts
        flags &= np.cumsum(edges[:-1]) > 0
    return runs_of(flags)


def pieces(grams: np.ndarray, bounds: np.ndarray, window: int, gram: int, runs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """shared_windows(), cut down to the windows of runs."""
    edges = np.zeros(len(grams) + 1, dtype=np.int32)
    edges[runs[0]] += 1
    edges[runs[1]] -= 1
    flags = np.cumsum(edges[:-1]) > 0
    if not flags.any():
        none = np.empty(0, np.int64)
        return none, none, none, none
    at, low, _, number = shared_windows(grams, bounds, window, gram)
    new = np.zeros(len(grams), dtype=bool)
    new[low] = True
    start = np.flatnonzero(flags & (new | ~np.concatenate([[False], flags[:-1]])))
    end = np.flatnonzero(flags & (np.concatenate([new[1:], [True]]) | ~np.concatenate([flags[1:], [False]]))) + 1
    own = np.searchsorted(low, start, side="right") - 1
    return at[own], start, end, number[own]


def one_by_one(keys: np.ndarray, low: np.ndarray, high: np.ndarray, number: np.ndarray, heavy: np.ndarray, key_of: Callable) -> tuple[np.ndarray, ...]:
    """Keys, first windows, ends and texts of fragments, with each window of a heavy one by itself under the key of key_of(windows)."""
    if not heavy.any():
        return keys, low, high, number
    size = (high - low)[heavy]
    windows = np.repeat(low[heavy] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    rest = ~heavy
    return np.concatenate([keys[rest], key_of(windows)]), np.concatenate([low[rest], windows]), np.concatenate([high[rest], windows + 1]), np.concatenate([number[rest], np.repeat(number[heavy], size)])


#: at: the places of a fragment in its document, 4 bytes each.
FRAGMENTS = "key long, doc_id long, at binary, windows int, part binary"


def exchange_sizes(bits: int) -> tuple[int, int]:
    """Bytes of texts that ask a sketch of 2^bits cells a row together, and the bits of its shards.

    A row of the exchange is what one chunk asks one shard. Chunks that double with the number
    of shards keep such rows long (some 650 cells) up to 2^35 cells, larger shards up to 2^37;
    beyond, rows halve with each doubling, to a few cells at 2^45 (140 TB). Both are bounded
    by memory: 32 MB of texts, 64 MB of counts. A row of the sketch has 64 shards at least.
    """
    over = max(0, bits - MOST_BITS - 1)
    return CHUNK << min(GROWTH, over), max(min(SHARD_BITS, BLOCK_BITS, bits), min(SHARD_BITS + min(SHARD_GROWTH, max(0, over - GROWTH)), bits - 6))


def exchanged(texts: DataFrame, groups_of: Callable, items_of: Callable, fragments_of: Callable, bits: int, heavy: int) -> DataFrame:
    """FRAGMENTS by a sketch of any size, whose shards are counted in tasks and sent to no one.

    groups_of(batches) yields lists of (doc_id, bytes); items_of(groups) as for merged_sketch();
    fragments_of(pairs of group and maps) yields batches of FRAGMENTS. A chunk is named by
    what it holds: one that a task which runs again puts together in another way finds no
    marks, and all its windows pass.
    """
    spark, (size, shard_bits) = texts.sparkSession, exchange_sizes(bits)
    key_bits = 6 + max(0, bits - MOST_BITS)

    def chunks(batches):
        held, total = [], 0
        for group in groups_of(batches):
            held.append(group)
            total += sum(len(text) for _, text in group)
            if total >= size:
                yield name(held), held
                held, total = [], 0
        if held:
            yield name(held), held

    def name(held):
        digest = xxhash.xxh3_128()
        for group in held:
            for doc_id, text in group:
                digest.update(np.array([doc_id, len(text)], dtype="<i8").tobytes())
                digest.update(text)
        return digest.digest()

    def asked(batches):
        for chunk, held in chunks(batches):
            found = list(items_of(held))
            for row in range(ROWS):
                own = at_most_twice(np.concatenate([cells(items[row], row, bits) for items in found]).astype(np.uint64))
                yield from split(chunk, (own & np.uint64(2**shard_bits - 1)).astype("<u4"), (own >> np.uint64(shard_bits)).astype(np.int64) | row << 56)
            told = np.unique(np.concatenate([items[ROWS] for items in found]), axis=0)
            number = (mixed(told[:, 0]) >> np.uint64(64 - key_bits)).astype(np.int64)  # keys are minima, so that their own high bits are low
            order = np.argsort(number, kind="stable")
            yield from split(chunk, told[order], -1 - number[order])

    def split(chunk, values, shards):
        """A row for each shard, with its values; those of a shard stand together."""
        if len(values):
            first = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]]))
            yield made(shards[first], pa.repeat(pa.scalar(chunk, pa.binary()), len(first)), values, np.append(first, len(values)))

    def made(shards, names, values, bounds):
        offsets = (bounds * (values.nbytes // max(1, len(values)))).astype(np.int32)
        return pa.record_batch({"shard": pa.array(shards, pa.int64()), "chunk": names, "cells": pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])})

    def answered(batches):
        held, number = [], None
        for batch in batches:
            shards = batch.column(0).to_numpy()
            cuts = np.flatnonzero(shards[1:] != shards[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shards)], strict=True):
                if held and b > a and shards[a] != number:
                    yield from answer(number, held)
                    held = []
                if b > a:
                    number = int(shards[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield from answer(number, held)

    def answer(shard, held):
        """To each chunk those of its cells that are repeated (none, too, is an answer); of sampled fragments the heavy keys."""
        if shard < 0:
            if len(keys := often([binary_column(x.column(2))[0].tobytes() for x in held], heavy)):
                yield made([shard], pa.array([b""], pa.binary()), keys, np.array([0, len(keys)]))
            return
        counts = np.zeros(2**shard_bits, dtype=np.uint8)
        for x in held:
            reach(counts, np.sort(cells_of(x.column(2))[0]))
        for x in held:
            own, bounds = cells_of(x.column(2))
            new = np.concatenate([[True], own[1:] != own[:-1]])
            new[bounds[:-1]] = True  # no row is empty
            kept = new & (counts[own] > 1)
            yield made(x.column(0), x.column(1), own[kept], np.concatenate([[0], np.cumsum(kept)])[bounds])

    def cells_of(column):
        """The cells of all rows, and the bounds of each row among them."""
        data, bounds = binary_column(column)
        return np.frombuffer(data.tobytes(), dtype="<u4"), bounds // 4

    def texts_of(batches):
        """A chunk's ids and sizes, and its texts, compressed."""
        for chunk, held in chunks(batches):
            every = [pair for group in held for pair in group]
            whole = b"".join(text for _, text in every)
            places = np.array([[doc_id, len(text)] for doc_id, text in every], dtype="<i8")
            yield pa.record_batch({"chunk": pa.array([chunk], pa.binary()), "shard": pa.array([-1], pa.int64()), "cells": pa.array([pa.compress(whole, codec="zstd", asbytes=True) if whole else b""], pa.binary()), "places": pa.array([places.tobytes()], pa.binary())})

    def marked(batches):
        """The groups of each chunk with its marks, which come before its texts."""
        name, known = None, []
        for batch in batches:
            names, shards = np.frombuffer(binary_column(batch.column(0))[0].tobytes(), dtype="S16"), batch.column(1).to_numpy()
            cuts = np.flatnonzero(names[1:] != names[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                if (own := batch.column(0)[a].as_py()) != name:
                    name, known = own, [[] for _ in range(ROWS)]
                told = a + int(np.count_nonzero(shards[a:b] >= 0))
                if told > a:
                    remember(known, shards[a:told], batch.column(2).slice(a, told - a))
                for packed, places in zip(batch.column(2).slice(told, b - told).to_pylist(), batch.column(3).slice(told, b - told).to_pylist(), strict=True):
                    marks = Marks([*(np.sort(np.concatenate(x)) if x else None for x in known), keys.value], bits)
                    yield from ((group, marks) for group in opened(packed, places))

    def remember(known, shards, column):
        own, bounds = cells_of(column)
        number = np.diff(bounds)
        own = own.astype(np.uint64) | np.repeat((shards & (2**56 - 1)).astype(np.uint64) << np.uint64(shard_bits), number)
        for row in range(ROWS):
            if (theirs := shards >> 56 == row).any():
                known[row].append(own[np.repeat(theirs, number)])

    def opened(packed, places):
        where = np.frombuffer(places, dtype="<i8").reshape(-1, 2)
        ends = np.cumsum(where[:, 1])
        whole = pa.decompress(packed, int(ends[-1]), codec="zstd", asbytes=True) if packed else b""
        own = [(int(d), whole[end - n : end]) for (d, n), end in zip(where.tolist(), ends.tolist(), strict=True)]
        return groups_of([pa.record_batch({"doc_id": pa.array([d for d, _ in own], pa.int64()), "text": pa.array([t for _, t in own], pa.binary())})])

    schema = "shard long, chunk binary, cells binary"
    marks = written(texts.mapInArrow(asked, schema).repartition(shuffles(spark), "shard").sortWithinPartitions("shard").mapInArrow(answered, schema))
    # as many keys as heavy_limit() says
    found = [np.frombuffer(r.cells, dtype=np.uint64) for r in marks.filter("shard < 0").toLocalIterator()]
    keys = spark.sparkContext.broadcast(np.sort(np.concatenate([np.empty(0, np.uint64), *found])).tobytes())
    both = texts.mapInArrow(texts_of, "chunk binary, shard long, cells binary, places binary").unionByName(marks.filter("shard >= 0"), allowMissingColumns=True)
    dealt = both.repartition(shuffles(spark), "chunk").sortWithinPartitions("chunk", F.col("shard").desc())
    return dealt.mapInArrow(lambda batches: fragments_of(marked(batches)), FRAGMENTS)


def parts_of(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """values[low:high] of each pair, as bytes."""
    size = high - low
    taken = values[np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())]
    offsets = (np.concatenate([[0], np.cumsum(size)]) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(low), [None, pa.py_buffer(offsets), pa.py_buffer(taken)])


def places_of(column) -> tuple[np.ndarray, np.ndarray]:
    """The places of all rows of an `at` column, and the bounds of each row among them."""
    data, bounds = binary_column(column)
    return np.frombuffer(data.tobytes(), dtype="<i4"), bounds // 4


def placed(table: pa.Table, row: np.ndarray, start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_id, start, windows of spans within rows, at each place of a row."""
    places, bounds = places_of(table.column("at").combine_chunks())
    number = np.diff(bounds)[row]
    own = np.repeat(np.arange(len(row)), number)
    at = places[np.repeat(bounds[row] - np.cumsum(number) + number, number) + np.arange(number.sum())]
    return table.column("doc_id").to_numpy()[row][own], at + start[own], windows[own]


def combined(table: pa.Table) -> tuple[pa.Table, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of fragments with equal parts one row stays, with all places in the smallest document; the spans of the others.

    Those places wait together for what other documents hold. Rows stay in order.
    """
    code = table.column("part").combine_chunks().dictionary_encode().indices.to_numpy()
    keys, docs = table.column("key").to_numpy(), table.column("doc_id").to_numpy()
    order = np.lexsort((docs, keys, code))
    new = np.concatenate([[True], (code[order][1:] != code[order][:-1]) | (keys[order][1:] != keys[order][:-1])])
    gone = docs[order] > docs[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    lost, kept = np.sort(order[gone]), order[~gone]
    spans = placed(table, lost, np.zeros(len(lost), np.int64), table.column("windows").to_numpy()[lost])
    places, bounds = places_of(table.column("at").combine_chunks().take(pa.array(kept)))
    low = np.flatnonzero(new[~gone])  # of each part the first row is kept
    turn = np.argsort(kept[low])
    at = parts_of(places, bounds[low][turn], bounds[np.append(low[1:], len(kept))][turn])
    table = table.take(pa.array(kept[low][turn])).combine_chunks()
    return table.set_column(2, "at", at), spans


class Settled:
    """Fragments of a task, combined before they are sent: what a smaller document has too becomes spans to remove (no part), joined where they meet."""

    def __init__(self) -> None:
        self.held: list[pa.RecordBatch] = []
        self.size = 0

    def add(self, keys: np.ndarray, docs: np.ndarray, at: np.ndarray, windows: np.ndarray, parts: pa.Array) -> bool:
        """Whether they should be sent now."""
        each = np.arange(len(at))
        self.held.append(pa.record_batch([keys, docs, parts_of(at.astype("<i4"), each, each + 1), windows.astype(np.int32), parts], names=["key", "doc_id", "at", "windows", "part"]))
        self.size += self.held[-1].nbytes
        return self.size >= HELD

    def batches(self):
        if not self.held:
            return
        table, (doc, at, windows) = combined(pa.Table.from_batches(self.held).combine_chunks())
        yield from table.to_batches()
        if len(doc):
            order = np.lexsort((at, doc))
            doc, at, end = doc[order], at[order], (at + windows)[order]
            new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (at[1:] != end[:-1])])
            first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(doc)) - 1
            doc, at, size = doc[first], at[first], (end[last] - at[first]).astype(np.int32)
            anywhere = mixed(doc.view(np.uint64) ^ mixed(at.astype(np.uint64))).view(np.int64)
            each = np.arange(len(first))
            yield pa.record_batch([anywhere, doc, parts_of(at.astype("<i4"), each, each + 1), size, pa.nulls(len(first), pa.binary())], schema=table.schema)
        self.__init__()


def matched(fragments: DataFrame, spans_of: Callable, windows_of: Callable) -> DataFrame:
    """doc_id, start, windows: windows that also occur in a smaller document.

    fragments has FRAGMENTS: neighbouring windows with one bucket
    key; rows without a part are spans to remove already. The others are shuffled by key and solved in slices of whole keys by spans_of(table),
    which gives rows, starts within their parts, and windows. A key that outgrows a slice is put aside; the windows of such keys, as rows (window, doc_id, at)
    by windows_of(key, part), are grouped by themselves, with partial minima, instead.
    """
    schema = "hot long, doc_id long, start int, windows int"
    dealt = fragments.repartition(shuffles(fragments.sparkSession), "key").sortWithinPartitions("key")

    def solve(batches):
        held, size, hot = [], 0, None
        for batch in batches:
            whole = pc.is_valid(batch.column(4))
            done, batch = batch.filter(pc.invert(whole)), batch.filter(whole)
            if done.num_rows:
                yield from made(*spans_in(done))
            if hot is not None:
                batch = batch.filter(pc.not_equal(batch.column(0), hot))
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size < SLICE:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = table.column(0).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], side="left"))
            if cut:
                yield from solved(table.slice(0, cut))
                rest = table.slice(cut)
                held, size = rest.to_batches(), rest.nbytes
            elif size >= 4 * SLICE:
                hot, held, size = int(keys[-1]), [], 0
                yield pa.record_batch({"hot": pa.array([hot], pa.int64()), "doc_id": pa.nulls(1, pa.int64()), "start": pa.nulls(1, pa.int32()), "windows": pa.nulls(1, pa.int32())})
        if held:
            yield from solved(pa.Table.from_batches(held).combine_chunks())

    def solved(table):
        table, spans = combined(table)
        yield from made(*spans)
        yield from made(*placed(table, *spans_of(table)))

    def spans_in(done):
        return done.column(1).to_numpy(), places_of(done.column(2))[0], done.column(3).to_numpy()

    def settled(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch(list(spans_in(batch)), names=["doc_id", "start", "windows"])

    def every_window(batches):
        for key, doc_id, at, part in rows(batches, "key", "doc_id", "at", "part"):
            own = windows_of(key, part)
            for place in np.frombuffer(at, dtype="<i4").tolist():
                yield pa.record_batch({"window": pa.array(own, pa.binary()), "doc_id": np.full(len(own), doc_id, np.int64), "at": np.arange(place, place + len(own), dtype=np.int32)})

    def made(doc_id, start, number):
        if len(doc_id):
            yield pa.record_batch({"hot": pa.nulls(len(doc_id), pa.int64()), "doc_id": doc_id, "start": start.astype(np.int32), "windows": number.astype(np.int32)})

    found = written(dealt.mapInArrow(solve, schema))
    spans = found.filter("hot is null").drop("hot")
    hot = found.filter("hot is not null").select(F.col("hot").alias("key")).distinct()
    if not hot.limit(1).count():
        return spans
    # fragments are made anew here; should a task find its rows in another order, its spans may differ too
    spans = spans.unionByName(fragments.filter("part is null").mapInArrow(settled, "doc_id long, start int, windows int"))
    every = fragments.filter("part is not null").join(hot, "key", "left_semi").mapInArrow(every_window, "window binary, doc_id long, at int")
    least = every.groupBy("window").agg(F.min("doc_id").alias("least"))
    return spans.unionByName(every.join(least, "window").filter("least < doc_id").select("doc_id", F.col("at").alias("start"), F.lit(1).alias("windows")))


def spans_of_flags(row: np.ndarray, place: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first place and number of each run of flags within a row."""
    apart = np.concatenate([[True], row[1:] != row[:-1]])
    start = np.flatnonzero(gone & (apart | ~np.concatenate([[False], gone[:-1]])))
    end = np.flatnonzero(gone & (np.concatenate([apart[1:], [True]]) | ~np.concatenate([gone[1:], [False]]))) + 1
    return row[start], place[start], end - start


def spans_by_document(*spans: DataFrame) -> DataFrame:
    """doc_id, spans: starts and numbers of windows to remove; a document has no more spans than windows."""
    both = spans[0]
    for more in spans[1:]:
        both = both.unionByName(more)
    return both.groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))

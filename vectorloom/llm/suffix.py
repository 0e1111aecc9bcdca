"""Suffix-array dedup on bytes: a depth-limited radix sort.

Suffixes are ordered only through their first `window` bytes, by passes over digits
from the most significant one; a suffix that is alone in its group after a pass is
finished. Groups that are left after the last digit are exactly the repeated windows.

The first pass deals all suffixes to buckets without moving them: a suffix's bucket is
the minimiser of its window (the 16-byte gram of least hash, the same for equal
windows), and a merged count-min histogram of the buckets, and of those by the gram of
greatest hash, finishes suffixes that only one document reaches (see repeats.py).
The windows that stay are shuffled by bucket, one row for the neighbours that share a
minimiser, and each bucket is sorted by the digits. Rows that a task has twice or more
are settled before the shuffle, so that copies cost a bucket one row a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import BYTE_VALUES, binary_column, gram_hashes, groups, narrow, rows, runs_of, utf8
from vectorloom.llm.repeats import FRAGMENTS, MOST_BITS, Settled, exchanged, full_bits, heavy_limit, heavy_of, matched, merged_sketch, one_by_one, parts_of, pieces, repeated_runs, spans_by_document, spans_of_flags, window_items
from vectorloom.llm.substring import removed

GRAM, DIGIT = 16, 8


def grouped_bytes(texts: list[bytes], gram: int) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All texts one after another, the hashes of their grams, and the bounds of each text."""
    data = b"".join(texts)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    return data, gram_hashes(BYTE_VALUES[np.frombuffer(data, dtype=np.uint8)], gram), np.concatenate([[0], np.cumsum(sizes)])


def groups_by_radix(data: np.ndarray, start: np.ndarray, width: int, bucket: np.ndarray) -> np.ndarray:
    """Group number of each window (width bytes of data from start), equal windows of a bucket alike; -1 where one is alone.

    Each pass sorts what is left by (group, next digit of 8 bytes) and splits the groups;
    a digit is read from the text where it is needed, windows are never laid out.
    """
    group = bucket.astype(np.int64)
    left = np.arange(len(start))
    digits = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(DIGIT, np.uint8)]), DIGIT)
    for at in range(0, width, DIGIT):
        digit = digits[start[left] + at].view(">u8").ravel().astype(np.uint64) >> np.uint64(8 * max(0, at + DIGIT - width))
        order = np.lexsort((digit, group[left]))
        left, digit = left[order], digit[order]
        own = group[left]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (digit[1:] != digit[:-1])])
        label = np.cumsum(new) - 1
        alone = new & np.concatenate([new[1:], [True]])
        group[left] = label
        group[left[alone]] = -1
        left = left[~alone]
        if not len(left):
            break
    return group


def repeated_windows(docs: DataFrame, window: int = 50, most_bits: int = MOST_BITS) -> DataFrame:
    """doc_id, spans: windows (start, number of windows) of UTF-8 bytes that also start in a document with a smaller id.

    Null texts are empty; rows with a null doc_id take no part; documents without such
    windows have no row. A prefilter of more than 2^most_bits cells a row is exchanged, not
    broadcast; the result is the same.
    """
    texts = narrow(docs, doc_id="long", text="string").filter("doc_id is not null")
    length = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    gram = min(GRAM, window)

    def texts_of(batches):
        return groups(((doc_id, utf8(text)) for doc_id, text in rows(batches, "doc_id", "text")), 100_000)

    def items(found):
        for group in found:
            _, grams, bounds = grouped_bytes([text for _, text in group], gram)
            yield window_items(grams, bounds, window, gram)

    def window_hashes(data, windows):
        return gram_hashes(BYTE_VALUES[np.frombuffer(data, dtype=np.uint8)], window)[windows]

    def buckets(found):
        settled = Settled()
        for group, maps in found:
            data, grams, bounds = grouped_bytes([text for _, text in group], gram)
            at, low, high, number = pieces(grams, bounds, window, gram, repeated_runs(grams, bounds, window, gram, maps))
            if not len(at):
                continue
            ids = np.array([doc_id for doc_id, _ in group], dtype=np.int64)
            keys = grams[at]
            keys, low, high, number = one_by_one(keys, low, high, number, heavy_of(keys, maps), lambda windows, data=data: window_hashes(data, windows))
            part = parts_of(np.frombuffer(data, dtype=np.uint8), low, high + window - 1)
            # a bucket's number needs no more than 32 bits: the digits tell its windows apart
            if settled.add((keys >> np.uint64(32)).view(np.int64), ids[number], low - bounds[number], high - low, part):
                yield from settled.batches()
        yield from settled.batches()

    def spans_of(table):
        keys = table.column("key").to_numpy()
        twice = np.zeros(len(keys), dtype=bool)
        same = keys[1:] == keys[:-1]
        twice[1:] |= same
        twice[:-1] |= same  # other buckets hold one row
        table = table.filter(pa.array(twice)).combine_chunks()
        if not table.num_rows:
            none = np.empty(0, np.int64)
            return none, none, none
        docs_ = table.column("doc_id").to_numpy()
        data, offsets = binary_column(table.column("part").chunk(0))
        number = np.diff(offsets) - window + 1
        row = np.repeat(np.arange(len(number)), number)
        place = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
        keys = np.unique(table.column("key").to_numpy(), return_inverse=True)[1]
        group = groups_by_radix(data, offsets[row] + place, window, keys[row])
        keep = np.flatnonzero(group >= 0)
        own = docs_[row[keep]]
        least = np.full(int(group.max(initial=-1)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, group[keep], own)
        gone = np.zeros(len(row), dtype=bool)
        gone[keep] = least[group[keep]] < own
        i, at, size = spans_of_flags(row, place, gone)
        return np.flatnonzero(twice)[i], at, size

    def windows_of(key, part):
        return [part[i : i + window] for i in range(len(part) - window + 1)]

    expected = 2.5 * length / (window - gram + 2)
    bits, heavy = full_bits(expected), heavy_limit(docs.sparkSession, expected)
    if bits > most_bits:
        found = exchanged(texts, texts_of, items, buckets, bits, heavy)
    else:
        maps = merged_sketch(texts, lambda batches: items(texts_of(batches)), bits, heavy)
        found = texts.mapInArrow(lambda batches: buckets((group, maps.value) for group in texts_of(batches)), FRAGMENTS)
    return spans_by_document(matched(found, spans_of, windows_of))


def kept_bytes(docs: DataFrame, window: int = 50) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: each document's bytes that no repeated window covers.

    The first document (smallest id) keeps a passage. Null and empty texts have no bytes;
    texts shorter than a window stay whole. Cuts may fall inside a character, so kept is
    binary. Rows that share a doc_id are judged each by the windows of other ids.
    """
    spans = repeated_windows(docs, window)
    texts = narrow(docs, doc_id="long", text="string")

    def run(batches):
        out, size = [], 0
        for doc_id, text, own in rows(batches, "doc_id", "text", "spans"):
            data = kept = utf8(text)
            gone, pieces = 0, 0
            if own:
                flags = removed(len(data), own, window)
                gone, pieces = int(flags.sum()), len(runs_of(flags)[0])
                kept = np.frombuffer(data, dtype=np.uint8)[~flags].tobytes()
            out.append((doc_id, len(data), gone, pieces, kept))
            size += len(kept)
            if size > 2_000_000:
                yield made(out)
                out, size = [], 0
        if out:
            yield made(out)

    def made(out):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return texts.join(spans, "doc_id", "left").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(docs: DataFrame, window: int = 50) -> DataFrame:
    """kept_bytes() with the SHA-256 of the kept bytes in place of them."""
    return kept_bytes(docs, window).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

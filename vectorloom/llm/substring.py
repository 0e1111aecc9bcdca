"""Substring dedup on word windows: count-min prefilter, then exact groups.

First pass: partition sketches of what windows hold, merged (see repeats.py). What is
counted for a window are its 7-word grams of least and of greatest hash: equal windows
have equal ones, so their counts are at least the window's, and there are four times
fewer of them than windows. Second pass: only windows whose estimate is
two or more are kept, and grouped exactly by their minimiser and a hash of their words:
two 64-bit hashes over word hashes with two seeds of their own, new in each run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import BASES, binary_column, gram_hashes, grouped_words, groups, narrow, new_seed, replaced, rows, slices, utf8
from vectorloom.llm.repeats import FRAGMENTS, MOST_BITS, Settled, exchanged, full_bits, heavy_limit, heavy_of, matched, merged_sketch, one_by_one, parts_of, pieces, repeated_runs, spans_by_document, spans_of_flags, window_items

GRAM = 7


def repeated_windows(docs: DataFrame, window: int = 13, most_bits: int = MOST_BITS) -> DataFrame:
    """doc_id, spans: windows (start, number of windows) of each document that also start in a document with a smaller id.

    Documents without such windows have no row. Null texts have no words; rows with a
    null doc_id are in no order and take no part. A prefilter of more than 2^most_bits
    cells a row is exchanged, not broadcast; the result is the same.
    """
    texts = narrow(docs, doc_id="long", text="string").filter("doc_id is not null")
    gram, seeds = min(GRAM, window), (new_seed(), new_seed())
    length = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def texts_of(batches):
        return groups(((doc_id, utf8(text)) for doc_id, text in rows(batches, "doc_id", "text")), 250_000)

    def items(found):
        for group in found:
            (hashes,), bounds = grouped_words([text for _, text in group], seeds[:1])
            yield window_items(gram_hashes(hashes, gram), bounds, window, gram)

    def fragments(found):
        """Windows with one minimiser: its hash, and the hashes of the windows."""
        settled = Settled()
        for group, maps in found:
            (hashes, others), bounds = grouped_words([text for _, text in group], seeds)
            grams = gram_hashes(hashes, gram)
            at, low, high, number = pieces(grams, bounds, window, gram, repeated_runs(grams, bounds, window, gram, maps))
            if not len(at):
                continue
            own = gram_hashes(others, window, BASES[1])
            ids = np.array([doc_id for doc_id, _ in group], dtype=np.int64)
            keys, one = grams[at], gram_hashes(hashes, window)
            keys, low, high, number = one_by_one(keys, low, high, number, heavy_of(keys, maps), lambda windows, one=one: one[windows])
            if settled.add(keys.view(np.int64), ids[number], low - bounds[number], high - low, parts_of(own, low, high)):
                yield from settled.batches()
        yield from settled.batches()

    def spans_of(table):
        """Two windows are one if both the hashes of their minimisers and their own agree."""
        data, offsets = binary_column(table.column("part").chunk(0))
        number = np.diff(offsets) // 8
        row = np.repeat(np.arange(len(number)), number)
        place = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
        keys, docs_ = table.column("key").to_numpy()[row], table.column("doc_id").to_numpy()
        windows = data.view(np.uint64) if data.ctypes.data % 8 == 0 else data.copy().view(np.uint64)
        order = np.lexsort((windows, keys))
        new = np.concatenate([[True], (keys[order][1:] != keys[order][:-1]) | (windows[order][1:] != windows[order][:-1])])
        own = docs_[row[order]]
        least = np.minimum.reduceat(own, np.flatnonzero(new))[np.cumsum(new) - 1]
        gone = np.zeros(len(row), dtype=bool)
        gone[order] = own > least
        i, at, size = spans_of_flags(row, place, gone)
        return i, at, size

    def windows_of(key, part):
        return [key.to_bytes(8, "little", signed=True) + part[i : i + 8] for i in range(0, len(part), 8)]

    bits, heavy = full_bits(length / 24), heavy_limit(docs.sparkSession, length / 24)
    if bits > most_bits:
        found = exchanged(texts, texts_of, items, fragments, bits, heavy)
    else:
        maps = merged_sketch(texts, lambda batches: items(texts_of(batches)), bits, heavy)
        found = texts.mapInArrow(lambda batches: fragments((group, maps.value) for group in texts_of(batches)), FRAGMENTS)
    return spans_by_document(matched(found, spans_of, windows_of))


def removed(n: int, spans: list | None, window: int) -> np.ndarray:
    """Which of n places a span of windows covers."""
    edges = np.zeros(n + 1, dtype=np.int32)
    for span in spans or ():
        edges[span["start"]] += 1
        edges[min(n, span["start"] + span["windows"] + window - 1)] -= 1
    return np.cumsum(edges[:-1]) > 0


def kept_words(docs: DataFrame, window: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text: each document's words that no repeated window covers, joined by one space.

    The first document (smallest id) keeps a passage. Null and empty texts have no words;
    documents shorter than a window stay whole. Rows that share a doc_id are judged each
    by the windows of other ids.
    """
    spans = repeated_windows(docs, window)
    texts = narrow(docs, doc_id="long", text="string")

    def run(batches):
        out, size = [], 0
        for doc_id, text, own in rows(batches, "doc_id", "text", "spans"):
            words = utf8(text).split()
            gone = removed(len(words), own, window) if own else np.zeros(0, bool)
            kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if own else words)
            out.append((doc_id, len(words), int(gone.sum()), kept.decode("utf-8", "surrogatepass")))
            size += len(kept)
            if size > 2_000_000:
                yield made(out)
                out, size = [], 0
        if out:
            yield made(out)

    def made(out):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "n_words", "n_removed", "kept_text"])

    return texts.join(spans, "doc_id", "left").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")


def without_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """The rows of docs, with all columns, with kept_words() as text where words are removed."""
    names = docs.columns

    def run(batches):
        for part in slices(batches):
            texts = part.column(part.schema.get_field_index("text")).to_pylist()
            for i, spans in enumerate(part.column(part.schema.get_field_index("spans")).to_pylist()):
                if spans:
                    words = utf8(texts[i]).split()
                    kept = [w for w, g in zip(words, removed(len(words), spans, window).tolist(), strict=True) if not g]
                    texts[i] = b" ".join(kept).decode("utf-8", "surrogatepass") if len(kept) < len(words) else texts[i]
            yield replaced(part, "text", texts).select(names)

    return docs.join(repeated_windows(docs, window), "doc_id", "left").select(*names, "spans").mapInArrow(run, docs.schema)


def digest(docs: DataFrame, window: int = 13) -> DataFrame:
    """kept_words() with the SHA-256 of the kept text in place of it."""
    return kept_words(docs, window).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))

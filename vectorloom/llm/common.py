"""Helpers that several corpus operators share: stored stages, word and window hashes, minimisers."""

from __future__ import annotations

import secrets
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Odd multipliers of the two polynomial hashes, and the constants of the final mixer.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: A random-looking 64-bit value for each byte.
BYTE_VALUES = np.array([xxhash.xxh3_64_intdigest(bytes([i])) for i in range(256)], dtype=np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Computes df once and cuts its lineage with a reliable checkpoint.

    The folder is the session's spark.checkpoint.dir; only where that is unset
    (local tests) a temporary one is made.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp())
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Computes df once and cuts its lineage with a table in the session's spark.checkpoint.dir.

    For rows with texts: compressed by column, it takes a fraction of a checkpoint's disk,
    and readers that need no texts don't read them.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    path = f"{spark.conf.get('spark.checkpoint.dir', None) or context.getCheckpointDir() or tempfile.mkdtemp()}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, rows_each: int = 50_000) -> DataFrame:
    """stored(), in about rows_each rows a partition: small tables then cost few files in the shuffles that follow."""
    df = stored(df)
    return df.coalesce(df.count() // rows_each + 1)


def shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mixed(x: np.ndarray) -> np.ndarray:
    """Final mixer, so that every bit of a hash depends on every bit of x."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x ^= x >> np.uint64(27)
    x = x * _MIX2
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(x: np.ndarray, k: int, base: np.uint64 = BASES[0]) -> np.ndarray:
    """Hash of every k consecutive values of x, by doubling: log2(k) passes over the array."""
    if len(x) < k:
        return np.empty(0, dtype=np.uint64)
    done, length, part, span, power = None, 0, x, 1, base
    rest = k
    while rest:
        if rest & 1:
            if done is None:
                done, length = part, span
            else:
                n = len(x) - length - span + 1
                done = done[:n] * power + part[length : length + n]
                length += span
        rest >>= 1
        if rest:
            n = len(part) - span
            part = part[:n] * power + part[span:]
            span, power = 2 * span, np.uint64(int(power) ** 2 % 2**64)
    return mixed(done)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    if len(x) < w:
        return x[:0]
    span, out = 1, x
    while 2 * span <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if span < w:
        out = np.minimum(out[: len(x) - w + 1], out[w - span :])
    return out


def minimizers(h: np.ndarray, w: int, rightmost: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Positions chosen as minimum of some window of w values, and the first window of each.

    Window i holds h[i:i+w]; position p is chosen by windows first[p] .. first[next]-1.
    Ties go to the leftmost position, or to the rightmost one.
    """
    if len(h) < w:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = sliding_min(h, w)
    # h[p] is the minimum of some window exactly if it equals the largest of the minima of its windows
    padded = np.concatenate([np.zeros(w - 1, h.dtype), low, np.zeros(w - 1, h.dtype)])
    most = ~sliding_min(~padded, w)
    at = np.flatnonzero(h == most)
    values = h[at]
    first = np.zeros(len(at), dtype=np.int64)
    if len(at) > 1:
        reach = np.maximum(at[1:] - w + 1, 0)
        first[1:] = np.where(values[1:] < values[:-1], reach, at[:-1] + 1)
        if rightmost:  # in a chain of ties each takes over as soon as a window reaches it, but not before the chain's start
            tie = np.concatenate([[False], values[1:] == values[:-1]])
            start = np.maximum.accumulate(np.where(tie, 0, np.arange(len(at))))
            first[1:] = np.where(tie[1:], np.maximum(reach, first[start[1:]]), first[1:])
    # a position that ties with an earlier one may lose all its windows to a later one
    ends = np.minimum.accumulate(np.append(first[1:], len(low))[::-1])[::-1]
    keep = ends > first
    return at[keep], first[keep]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_BLOCK = 1 << 22
#: Words of more bytes than this are hashed one at a time.
LONG_WORD = 64
#: _TAILS[n]: the lowest n bytes of a lane.
_TAILS = np.array([2 ** (8 * n) - 1 for n in range(9)], dtype=np.uint64)


def new_seed() -> int:
    """A seed for the word hashes of one run: texts made to collide under one seed don't under another."""
    return secrets.randbits(63)


def word_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of bytes other than space and 9 to 13."""
    return runs_of(~_SPACE[np.frombuffer(data, dtype=np.uint8)])


def hashed_words(data: bytes, folded: bool = False, seeds: tuple[int, ...] = (0,)) -> tuple[list[np.ndarray], np.ndarray]:
    """A 64-bit hash of each word of data for each seed, and the words' starts; folded: A-Z count as a-z.

    A word is read in lanes of 8 bytes; each is mixed into a state that starts from the
    seed and the word's length, for all words at once. Words over LONG_WORD bytes are
    hashed by xxh3 with the same seed. Long texts go by blocks that end at white space.
    """
    data = data.lower() if folded else data
    parts, places, at = [[] for _ in seeds], [], 0
    while at < len(data):
        end = len(data)
        if end - at > _BLOCK:
            white = _SPACE[np.frombuffer(data, dtype=np.uint8, count=end - at - _BLOCK, offset=at + _BLOCK)]
            end = at + _BLOCK + (int(white.argmax()) if white.any() else len(white))
        block = data[at:end]
        start, stop = word_places(block)
        for own, seed in zip(parts, seeds, strict=True):
            own.append(_hashes(block, start, stop - start, seed))
        places.append(start + at)
        at = end
    none = np.empty(0, np.uint64)
    return [np.concatenate([none, *own]) for own in parts], np.concatenate([np.empty(0, np.int64), *places])


def _hashes(block: bytes, start: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    key = np.uint64(xxhash.xxh3_64_intdigest(b"word", seed))
    lanes = np.lib.stride_tricks.sliding_window_view(np.frombuffer(block + bytes(8), dtype=np.uint8), 8)
    out = mixed(size.astype(np.uint64) + key)
    left, at = np.flatnonzero(size <= LONG_WORD), 0
    while len(left):
        lane = lanes[start[left] + at].view("<u8").ravel() & _TAILS[np.minimum(size[left] - at, 8)]
        out[left] = mixed((out[left] ^ lane) + key)
        at += 8
        left = left[size[left] > at]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(block[start[i] : start[i] + size[i]], seed)
    return out


def word_hashes(data: bytes, folded: bool = False, seed: int = 0) -> np.ndarray:
    return hashed_words(data, folded, (seed,))[0][0]


def grouped_words(texts: list[bytes], seeds: tuple[int, ...] = (0,), folded: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the words of all texts, one after another, for each seed, and the bounds of each text among them."""
    hashes, starts = hashed_words(b"\n".join(texts), folded, seeds)
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    return hashes, np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))


def shared_windows(grams: np.ndarray, bounds: np.ndarray, window: int, gram: int, most: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For several texts one after another: windows that lie in one text, by the gram that stands for them.

    That gram is the one of least hash (or, if most, of greatest) among those of a window, leftmost on
    ties, so equal windows have equal ones. Returns positions of the grams, their first
    windows and ends (exclusive), and the number of their text.
    """
    wide = window - gram + 1
    at, first = minimizers(~grams if most else grams, wide)
    if not len(at):
        return at, at, at, at
    text = np.searchsorted(bounds, at, side="right") - 1
    low = np.maximum(first, bounds[text])
    high = np.minimum(np.append(first[1:], len(grams) - wide + 1), bounds[text + 1] - window + 1)
    keep = high > low
    return at[keep], low[keep], high[keep], text[keep]


def groups(items: Iterator[tuple], size: int = 1_000_000, most: int = 4096) -> Iterator[list[tuple]]:
    """Lists of rows whose second values have about `size` bytes together."""
    group, total = [], 0
    for item in items:
        group.append(item)
        total += len(item[1])
        if total >= size or len(group) >= most:
            yield group
            group, total = [], 0
    if group:
        yield group


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values."""
    padded = np.zeros(len(flags) + 2, dtype=np.int8)
    padded[1:-1] = flags
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    return edges[::2], edges[1::2]


def utf8(text: str | bytes | None) -> bytes:
    return text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")


def binary_column(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow binary array."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def rows(batches: Iterator, *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of Python values, one small slice at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield from zip(*(part.column(part.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def slices(batches: Iterator, size: int = 512) -> Iterator:
    """Arrow batches in small slices."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def replaced(batch, name: str, values: list):
    """The batch with other values in a column."""
    at = batch.schema.get_field_index(name)
    return batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast: extra columns, whatever their names, go no further."""
    return df.select(*(F.col(f"`{c}`").cast(kind).alias(c) for c, kind in columns.items()))

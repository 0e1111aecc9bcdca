"""Quality classifier: a factorisation machine.

Features of a text: its distinct hashed words (each weighted by its share of the words,
scaled), structure statistics of the whole text, and its length as metadata. A score is
sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)): all pairwise
interactions in time linear in the number of features. Labels, lang, source and doc_id
are never features.

The model is fitted on at most `most` labelled documents and MOST_BYTES bytes of their
features (documented bounds; those of least hash of their doc_id, one text an id). Tasks read the whole
texts and send features, of which a text has no more than there are buckets. The fit is on the driver, with
Adagrad in numpy; its size is fixed by the number of buckets. Scores then cover every row of the table in tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import grouped_words, groups, narrow, rows, slices, utf8, written

BUCKET_BITS, RANK = 15, 8
BUCKETS = 1 << BUCKET_BITS
#: Labelled documents that a fit takes at most, and the bytes of their features; those of one feature.
MOST, MOST_BYTES, FEATURE_BYTES = 8_000, 64_000_000, 12
STATISTICS = 14
_KIND = np.full(256, 0, dtype=np.uint8)
_KIND[list(b" \t\n\r\x0b\x0c")] = 1
_KIND[list(b"0123456789")] = 2
_KIND[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 3
_KIND[list(b"#*$%&|<>")] = 4
_KIND[list(b"!?\"'()[]{}/\\@^_~`+=;:")] = 5
_KIND[list(b".,")] = 6


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, parts: tuple) -> np.ndarray:
        """One margin for each text of features()."""
        index, value, starts = parts
        if not len(starts):
            return np.empty(0)
        v = self.factors[index] * value[:, None]
        total = np.add.reduceat(v, starts, axis=0)
        return self.bias + np.add.reduceat(self.weights[index] * value, starts) + 0.5 * (total**2 - np.add.reduceat(v * v, starts, axis=0)).sum(axis=1)


def statistics(data: bytes, words: list[bytes], distinct: int) -> list[float]:
    """STATISTICS numbers about 0 to 1 for a whole text; an empty one has zeros."""
    n, size = max(1, len(words)), max(1, len(data))
    kinds = np.bincount(_KIND[np.frombuffer(data, dtype=np.uint8)], minlength=7) / size
    lines = [x for x in data.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        *kinds[1:].tolist(),
        min(1.0, np.log1p(len(words)) / 10),
        min(1.0, np.log1p(len(data)) / 12),
        min(1.0, (size - n) / n / 20),
        distinct / n,
        pairs / max(1, len(words) - 1),
        len(set(lines)) / max(1, len(lines)),
        min(1.0, n / max(1, len(lines)) / 200),
        1.0,
    ]


def features(texts: list[str]) -> tuple:
    """index, value, starts of the features of each text; every text has STATISTICS at least."""
    index, value, starts, at = [], [], [], 0
    fixed, coded = np.arange(BUCKETS, BUCKETS + STATISTICS), [utf8(text) for text in texts]
    (hashes,), bounds = grouped_words(coded)
    for data, a, b in zip(coded, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        words = data.split()
        buckets, counts = np.unique(hashes[a:b] >> np.uint64(64 - BUCKET_BITS), return_counts=True)
        norm = np.sqrt(float((counts.astype(np.float64) ** 2).sum())) or 1.0
        index += [buckets.astype(np.int64), fixed]
        value += [counts / norm, np.array(statistics(data, words, len(buckets)))]
        starts.append(at)
        at += len(buckets) + STATISTICS
    return (np.concatenate(index) if index else np.empty(0, np.int64), np.concatenate(value).astype(np.float32) if value else np.empty(0, np.float32), np.array(starts, dtype=np.int64))


def fit(texts: list[str], labels: list[int], **options) -> Model:
    return fit_features(features(texts), labels, **options)


def fit_features(parts: tuple, labels: list[int], epochs: int = 6, batch: int = 64, rate: float = 0.05, decay: float = 1e-5, seed: int = 7) -> Model:
    """Logistic loss, Adagrad; classes weigh the same. Without both labels the model says 1 for all."""
    random = np.random.default_rng(seed)
    model = Model(0.0, np.zeros(BUCKETS + STATISTICS, np.float32), random.normal(0, 0.02, (BUCKETS + STATISTICS, RANK)).astype(np.float32))
    y = np.array(labels, dtype=np.float32)
    if len(set(labels)) < 2:
        model.bias = 4.0 if not labels or labels[0] else -4.0
        return model
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    index, value, starts = parts
    ends = np.append(starts[1:], len(index))
    g_bias, g_w, g_v = 1e-8, np.full_like(model.weights, 1e-8), np.full_like(model.factors, 1e-8)
    for _ in range(epochs):
        order = random.permutation(len(y))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            sizes = ends[own] - starts[own]
            row = np.repeat(np.arange(len(own)), sizes)
            take = np.arange(sizes.sum()) + np.repeat(starts[own] - (np.cumsum(sizes) - sizes), sizes)
            i, x = index[take], value[take]
            first = np.cumsum(sizes) - sizes
            v = model.factors[i] * x[:, None]
            total = np.add.reduceat(v, first, axis=0)
            margin = model.bias + np.add.reduceat(model.weights[i] * x, first) + 0.5 * (total**2 - np.add.reduceat(v * v, first, axis=0)).sum(axis=1)
            slope = (weight[own] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[own]) / len(own)).astype(np.float32)
            which, inverse = np.unique(i, return_inverse=True)
            order_ = np.argsort(inverse, kind="stable")
            cut = np.searchsorted(inverse[order_], np.arange(len(which)))
            by_w = slope[row] * x
            by_v = by_w[:, None] * (total[row] - v)
            step_w = np.add.reduceat(by_w[order_], cut) + decay * model.weights[which]
            step_v = np.add.reduceat(by_v[order_], cut, axis=0) + decay * model.factors[which]
            g_w[which] += step_w**2
            g_v[which] += step_v**2
            step = slope.sum()
            g_bias += float(step) ** 2
            model.bias -= rate * float(step) / np.sqrt(g_bias)
            model.weights[which] -= rate * step_w / np.sqrt(g_w[which])
            model.factors[which] -= rate * step_v / np.sqrt(g_v[which])
    return model


def learning_rows(docs: DataFrame, labels: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, text, quality, turn: labelled documents whose crc32(doc_id) mod 3 is not 1, the `most` of least hash at most.

    They are chosen on the narrow label table; of several texts or labels of a document
    the least counts; labels other than 0 and 1 are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter((held_out("doc_id") == F.lit(False)) & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.withColumn("turn", F.xxhash64("doc_id")).orderBy("turn", "doc_id").limit(most)
    found = narrow(docs, doc_id="long", text="string").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("quality").alias("quality"), F.first("turn").alias("turn"))


def held_out(doc_id: str):
    """crc32 of the doc_id as text, mod 3, is 1; null ids are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def feature_rows(found: DataFrame) -> DataFrame:
    """turn, doc_id, quality, size and the features (bytes) of learning_rows(): made in tasks, FEATURE_BYTES each, however long the text."""

    def run(batches):
        for own in groups(rows(batches, "doc_id", "text", "quality", "turn")):
            index, value, starts = features([r[1] for r in own])
            ends = np.append(starts[1:], len(index))
            yield pa.record_batch({
                "turn": pa.array([r[3] for r in own], pa.int64()), "doc_id": pa.array([r[0] for r in own], pa.int64()), "quality": pa.array([r[2] for r in own], pa.int32()),
                "size": pa.array((ends - starts) * FEATURE_BYTES, pa.int64()),
                "buckets": pa.array([index[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()), "shares": pa.array([value[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
            })

    return found.mapInArrow(run, "turn long, doc_id long, quality int, size long, buckets binary, shares binary")


def fitted(docs: DataFrame, labels: DataFrame, most: int = MOST, most_bytes: int = MOST_BYTES) -> Model:
    """A model of labels.quality from the features of at most `most` documents, with most_bytes bytes together.

    They are taken in the order of their ids' hashes. One that does not fit is left out, and the next are tried.
    """
    found = written(feature_rows(learning_rows(docs, labels, most)))
    ids, total = [], 0
    for r in sorted(found.select("turn", "doc_id", "size").collect()):  # `most` rows of three numbers
        if total + r.size <= most_bytes:
            total += r.size
            ids.append(r.doc_id)
    chosen = docs.sparkSession.createDataFrame([(i,) for i in ids], "doc_id long")
    own = sorted((r.doc_id, r.quality, bytes(r.buckets), bytes(r.shares)) for r in found.join(F.broadcast(chosen), "doc_id").toLocalIterator())
    index, value = (np.frombuffer(b"".join(r[k] for r in own), kind) for k, kind in ((2, np.int64), (3, np.float32)))
    starts = np.cumsum([0, *(len(r[3]) // 4 for r in own)])[:-1].astype(np.int64)
    return fit_features((index, value, starts), [r[1] for r in own])


def accepted(docs: DataFrame, labels: DataFrame, most: int = MOST) -> DataFrame:
    """The rows of docs, with all columns, whose own text scores 0.5 or more."""
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, most))

    def run(batches):
        for part in slices(batches):
            texts = [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]
            score = 1 / (1 + np.exp(-np.clip(model.value.margins(features(texts)), -30, 30)))
            yield part.filter(pa.array(score >= 0.5, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def scored(docs: DataFrame, labels: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text; nulls and empty texts are scored as empty."""
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, most))

    def run(batches):
        ids, texts, size = [], [], 0
        for doc_id, text in rows(batches, "doc_id", "text"):
            ids.append(doc_id)
            texts.append(text)
            size += len(text or "")
            if size > 500_000 or len(ids) >= 2000:
                yield made(ids, texts)
                ids, texts, size = [], [], 0
        if ids:
            yield made(ids, texts)

    def made(ids, texts):
        margin = model.value.margins(features(texts))
        return pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "score": (1 / (1 + np.exp(-np.clip(margin, -30, 30)))).astype(np.float64)})

    out = narrow(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

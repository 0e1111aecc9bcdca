"""Document fingerprints by winnowing.

Every k consecutive code points hash to 32 bits; from every w consecutive hashes the
minimum is chosen, the rightmost one on ties, and chosen positions are kept once.
Two texts that share k + w - 1 consecutive code points share a chosen hash. A text
with fewer than w grams has one window of all of them; one with fewer than k code
points is a single gram; an empty (or null) text has none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from vectorloom.llm.common import gram_hashes, minimizers, mixed, narrow, rows, shuffles

K, W = 16, 32
LEAST = -(2**63)


def winnow(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes (uint32) and their positions, in order of position."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if not len(points):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    h = (gram_hashes(mixed(points + np.uint64(1)), min(k, len(points))) >> np.uint64(32)).astype(np.uint32)
    at, _ = minimizers(h, min(w, len(h)), rightmost=True)
    return h[at], at


def as_string(chosen: np.ndarray) -> str:
    """The chosen hashes in order, 8 hex digits each."""
    return chosen.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of the sets of chosen hashes; two empty fingerprints are alike."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """doc_id, hashes, positions of every whole text; repeated rows stay, nulls are empty texts."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = [winnow(t or "", k, w) for t in part.column(1).to_pylist()]
                yield pa.record_batch({"doc_id": part.column(0), "hashes": pa.array([m[0].astype(np.int64) for m in made], pa.list_(pa.int64())), "positions": pa.array([m[1] for m in made], pa.list_(pa.int64()))})

    return narrow(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, hashes array<bigint>, positions array<bigint>")


def with_next(docs: DataFrame, function, schema: str) -> DataFrame:
    """Applies function(doc_id, text, next text) to every document; next by ascending doc_id, after the last the first.

    Null ids come before all others; rows with equal ids are in order of their texts.
    Documents are dealt to ranges of ids. The first document of each range goes to the
    range before it as well, so every task has what follows its last document, whatever
    the size of a range, and texts are shuffled once. A range holds about 1/16 of a
    shuffle partition; a single id with many rows is one range.
    """
    spark = docs.sparkSession
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))
    n = min(20_000, 16 * shuffles(spark))
    row = docs.agg(F.percentile_approx(ids, [i / n for i in range(1, n)], 10 * n).alias("p")).first()
    bounds = np.unique(np.array(row.p or [], dtype=np.int64))

    @pandas_udf("int")
    def range_of(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, x.to_numpy(np.int64), side="left").astype(np.int32))

    firsts = sorted((r.part, r.first) for r in docs.select(ids.alias("id")).withColumn("part", range_of("id")).groupBy("part").agg(F.min("id").alias("first")).collect())
    before = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]  # one a range, n at most
    before = F.broadcast(spark.createDataFrame(before, "first long, before int"))
    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), ids.alias("id"))
        .withColumn("part", range_of("id"))
        .join(before, F.col("id") == F.col("first"), "left")
        .withColumn("to", F.explode(F.when(F.col("before").isNull(), F.array(F.struct("part", F.lit(False).alias("halo")))).otherwise(F.array(F.struct("part", F.lit(False).alias("halo")), F.struct(F.col("before").alias("part"), F.lit(True).alias("halo"))))))
        .select("doc_id", "text", "id", F.col("to.part").alias("part"), F.col("to.halo").alias("halo"))
        .repartition(shuffles(spark), "part")
        .sortWithinPartitions("part", "halo", "id", F.col("text").asc_nulls_first())
        .drop("id")
    )

    def run(batches):
        held, out, size = None, [], 0
        for doc_id, text, part, halo in rows(batches, "doc_id", "text", "part", "halo"):
            if held is not None:
                out.append(function(held[0], held[1], text or ""))
                size += len(held[1])
            held = None if halo else (doc_id, text or "")
            if size > 2_000_000:
                yield made(out)
                out, size = [], 0
        if out:
            yield made(out)

    names = [c.split()[0] for c in schema.split(",")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "array<bigint>": pa.list_(pa.int64())}[c.split()[1]] for c in schema.split(",")]

    def made(out):
        return pa.record_batch([pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return dealt.mapInArrow(run, schema)


def edited_pairs(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Edited text: the last floor(n/2) of n code points replaced by the first as many (or
    all) of the next document. Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, and the positions of the chosen hashes:
    positions, edited_positions.
    """
    from hashlib import sha256

    memory: dict = {}

    def compare(doc_id, text, after):
        before, made = memory.get("next", (None, None))  # the next text of the document before is most often this one
        own, at = made if before is text else winnow(text, k, w)
        memory["next"] = (after, winnow(after, k, w))
        following = memory["next"][1][0]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        changed, places = winnow(edited, k, w)
        return doc_id, len(text), sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), as_string(own), as_string(changed), likeness(own, changed), likeness(own, following), at, places

    return with_next(docs, compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, positions array<bigint>, edited_positions array<bigint>")

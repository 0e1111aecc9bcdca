"""Spelling variants by anagram hashing.

A word's key is the sum over its letters of the letter's code point to the power of POWER, so
words of equal letters have equal keys, and a letter added or removed moves the key by that letter's value.
Two words of keys k and l can be near if k less one of its letters' values is l (an addition or
removal), or if k less one letter's value is l less one letter's value (an exchange). Keys are
joined first, on integers alone. Only for letters whose key meets another is the order of the
letters verified: by the place of the letter and a 124-bit hash of the letters around it. Words
that agree in key, place and hash differ by that one letter, so such a group has no more members
than there are letters, and no pair is made that is not a link.
"""

from __future__ import annotations

import re
import secrets
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import narrow, rows, stored, utf8, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
POWER, DIVISOR, SHORTEST, FEWEST = 5, 97, 5, 3
#: Primes of the four 31-bit hashes of letter order; their bases are drawn anew in each run.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
_PIECE, _FLUSH = 1 << 20, 1 << 22


def pieces(text: str, size: int = _PIECE) -> Iterator[str]:
    """The text in pieces of about `size` characters that cut no run."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        while end < len(text) and RUN.match(text, end - 1) and RUN.match(text, end):
            end = RUN.match(text, end).end()
        yield text[at:end]
        at = end


def runs(text: str) -> Iterator[str]:
    """The runs of a text, A-Z lower-cased and no other letter."""
    for piece in pieces(text):
        yield from RUN.findall(utf8(piece).lower().decode("utf-8", "surrogatepass"))


def planted(doc_id: int | None, run: str) -> str:
    """The run, less one letter if DIVISOR divides the crc32 of "<doc_id>:<run>" (a null id is the empty text)."""
    h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DIVISOR:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: words of SHORTEST code points or more with FEWEST occurrences or more in all texts.

    Tasks send counts, flushed by size, so a frequent word is a row a flush at most.
    """

    def count(batches):
        total, size = Counter(), 0
        for doc_id, text in rows(batches, "doc_id", "text"):
            for run, n in Counter(runs(text or "")).items():
                word = planted(doc_id, run) if len(run) >= SHORTEST else ""
                if len(word) >= SHORTEST:
                    size += len(word) + 50 if word not in total else 0
                    total[word] += n
            if size > _FLUSH:
                yield pa.record_batch({"word": pa.array(list(total)), "n": pa.array(list(total.values()), pa.int64())})
                total, size = Counter(), 0
        yield pa.record_batch({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

    found = narrow(docs, doc_id="long", text="string").mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= FEWEST)


def spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, one after another, and the words' bounds."""
    sizes = np.fromiter((len(w) for w in words), dtype=np.int64, count=len(words))
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])


def keys_of(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The anagram key of each word (none is empty), modulo 2**64."""
    return np.add.reduceat(points**POWER, bounds[:-1]) if len(bounds) > 1 else np.empty(0, np.int64)


def probes(words: DataFrame) -> DataFrame:
    """key, id, letter: each word's key (letter 0), and its key less the value of each letter that it has."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            points, bounds = spelled(batch.column("word").to_pylist())
            ids, key = batch.column("id").to_numpy(), keys_of(points, bounds)
            own = np.unique(np.repeat(np.arange(len(ids)), np.diff(bounds)) * 256 + points)
            which, letter = own // 256, own % 256
            yield pa.record_batch({
                "key": np.concatenate([key, key[which] - letter**POWER]), "id": np.concatenate([ids, ids[which]]),
                "letter": np.concatenate([np.zeros(len(ids), np.int32), letter.astype(np.int32)]),
            })

    return words.select("id", "word").mapInArrow(run, "key long, id long, letter int")


def meeting(keys: DataFrame) -> DataFrame:
    """id, letters: of each word the letters (0: none removed) whose key is another word's by an addition, removal or exchange."""
    less = F.col("letter") > 0
    each = keys.groupBy("key").agg(F.min(F.when(less, F.col("id"))).alias("a"), F.max(F.when(less, F.col("id"))).alias("b"), F.max((~less).cast("int")).alias("whole"))
    good = each.filter((F.col("a") < F.col("b")) | (F.col("a").isNotNull() & (F.col("whole") > 0)))
    return keys.join(good, "key", "left_semi").groupBy("id").agg(F.collect_set("letter").alias("letters"))  # 91 letters at most


def order_hashes(points: np.ndarray, bounds: np.ndarray, bases: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each prime: a hash of each word, and for every place one of its word without the letter there."""
    n, sizes = len(points), np.diff(bounds)
    place = np.arange(n) - np.repeat(bounds[:-1], sizes)
    longest = int(sizes.max(initial=0))
    for prime, base in zip(PRIMES, bases, strict=True):
        power = np.ones(longest + 1, np.int64)
        done = 1
        while done <= longest:  # the powers up to `done` make those up to twice as many
            take = min(done, longest + 1 - done)
            power[done : done + take] = power[:take] * pow(base, done, prime) % prime
            done += take
        upto = np.concatenate([[0], np.cumsum(points * power[place] % prime)])
        whole = upto[bounds[1:]] - upto[bounds[:-1]]
        before, after = upto[:-1] - np.repeat(upto[bounds[:-1]], sizes), np.repeat(upto[bounds[1:]], sizes) - upto[1:]
        yield whole % prime, (before + after % prime * pow(base, -1, prime)) % prime


def verification(words: DataFrame) -> DataFrame:
    """key, place, h, c, id, whole of words (id, word, letters) for each place of one of the letters, and for whole words.

    place is the letter's for exchanges. It is -1 for additions and removals, of which equal
    letters in a row give one. A word's memory is its length times a constant.
    """
    bases = [secrets.randbelow(p - 1000) + 500 for p in PRIMES]

    def made(batch) -> pa.RecordBatch:
        points, bounds = spelled(batch.column("word").to_pylist())
        ids, key = batch.column("id").to_numpy(), keys_of(points, bounds)
        wanted = np.zeros((len(ids), 256), bool)
        for i, letters in enumerate(batch.column("letters").to_pylist()):
            wanted[i, letters] = True
        which = np.repeat(np.arange(len(ids)), np.diff(bounds))
        place = np.arange(len(points)) - bounds[which]
        (w1, p1), (w2, p2), (w3, p3), (w4, p4) = order_hashes(points, bounds, bases)
        at = np.flatnonzero(wanted[which, points])
        first = at[(place[at] == 0) | (points[at] != points[at - 1])]
        alone = np.flatnonzero(wanted[:, 0])
        take = np.concatenate([at, first])
        join = lambda a, b: a * 2**31 + b
        own = np.concatenate([which[take], alone])
        return pa.record_batch({
            "key": key[own] - np.concatenate([points[take] ** POWER, np.zeros(len(alone), np.int64)]),
            "place": np.concatenate([place[at], np.full(len(first) + len(alone), -1)]),
            "h": np.concatenate([join(p1, p2)[take], join(w1, w2)[alone]]), "c": np.concatenate([join(p3, p4)[take], join(w3, w4)[alone]]),
            "id": ids[own], "whole": np.concatenate([np.zeros(len(take), bool), np.ones(len(alone), bool)]),
        })

    def run(batches):
        for batch in batches:
            part = np.cumsum(pc.utf8_length(batch.column("word")).to_numpy()) >> 20  # about a million letters at once
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]]) if len(part) else [0]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield made(batch.slice(a, b - a))

    return words.select("id", "word", "letters").mapInArrow(run, "key long, place long, h long, c long, id long, whole boolean")


def neighbours(words: DataFrame) -> DataFrame:
    """id, n_near, best of words (id, word): how many other words are near, and the smallest id among them."""
    keys = stored(probes(words))
    rest = stored(verification(words.join(meeting(keys), "id")))
    same = rest.filter("place >= 0").groupBy("key", "place", "h", "c").agg(F.array_sort(F.collect_list("id")).alias("ids")).filter(F.size("ids") > 1)
    other = F.when(F.col("id") == F.col("ids")[0], F.col("ids")[1]).otherwise(F.col("ids")[0])
    exchanged = same.select(F.explode("ids").alias("id"), "ids").select("id", (F.size("ids") - 1).cast("long").alias("k"), other.alias("best"))
    on = ["key", "h", "c"]
    pairs = rest.filter("place < 0 and not whole").select(*on, F.col("id").alias("longer")).join(rest.filter("whole").select(*on, F.col("id").alias("shorter")), on)
    both = pairs.select(F.explode(F.array(F.struct(F.col("longer").alias("id"), F.col("shorter").alias("best")), F.struct(F.col("shorter").alias("id"), F.col("longer").alias("best")))).alias("x"))
    added = both.select("x.id", F.lit(1).cast("long").alias("k"), "x.best")
    return exchanged.union(added).groupBy("id").agg(F.sum("k").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """id, root of forms (id, next): the last of the chain that begins at id. Every round doubles the steps.

    A form's count is at least twice the word's, so a chain has no more than log2 of the greatest count links.
    """
    now = stored(forms.select("id", F.col("next").alias("root")))
    while True:
        further = now.select(F.col("id").alias("root"), F.col("root").alias("far"))
        after = stored(now.join(further, "root", "left").select("id", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        if not after.filter("moved").limit(1).count():
            return after.select("id", "root")
        now = after.select("id", "root")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts.

    Words are made and counted as in vocabulary(); a word's form is its near word of largest n (of
    equal ones the smallest) if that n is twice its own or more; its root is the last form on the way from
    it. Null and empty texts and those without runs have no words; repeated rows count each; an
    empty table has no rows. Ids are given by falling n and then by word, so the least id is the best.
    """
    counted = written(vocabulary(docs))
    words = stored(counted.orderBy(F.desc("n"), "word").withColumn("id", F.monotonically_increasing_id()))
    near = neighbours(words)
    of = lambda name, *more: words.select(F.col("id").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in more))
    best = words.join(near, "id", "left").join(of("best", "word", "n"), "best", "left")
    best = best.withColumn("fits", F.coalesce(F.col("best_n") >= 2 * F.col("n"), F.lit(False)))
    full = stored(best.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *(F.when(F.col("fits"), F.col(c)).alias(name) for c, name in (("best", "next"), ("best_word", "form"), ("best_n", "form_n")))))
    last = roots(full.filter("next is not null")).join(of("root", "word"), "root").select("id", "root_word")
    return full.join(last, "id", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")

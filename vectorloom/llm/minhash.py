"""MinHash near-dedup with an LSH forest.

A document is the set of its distinct word shingles. Documents with equal sets are one
class from the start. Each class has VALUES minimum hashes; each of TREES sorted orders
reads them from another start. In the sorted order, regions share a prefix of at least
SHORTEST values; a region that is no larger than NEAR is compared within, larger ones
are read at greater depths, adaptively: at each depth every member is compared with
its NEAR neighbours of longest common prefix and with the region's centres. A centre is
the member that agrees most with the region's most common values, so that the origin
of a family of copies is found, not just some copy. Pairs whose signatures agree far
less than the threshold asks are let go; all others are confirmed on the full sets.

A pair that reaches the threshold shares a region of some tree but for a chance of
(1 - 0.8^3)^21 = 3e-7; it is compared there unless the region is crowded (over NEAR + 1
rows, or cut between tasks). What crowded regions leave apart is settled exactly: the
members of those that hold several components are joined by prefix filter. Each set is
ordered by its shingles' frequency, rarest first; two sets that reach the threshold
share one of the first n - need + 1, with enough left after it in both (length and
positional filters), and their parity bits differ no more than they may. Pairs of different components that pass are confirmed on the full
sets, so neither caps nor slices of a region change the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import gathered, gram_hashes, grouped_words, groups, mixed, narrow, new_seed, rows, shuffles, stored, utf8, written
from vectorloom.llm.components import components
from vectorloom.llm.repeats import BLOCK_BITS, FLUSH, Maps, cells, estimated_repeated, merged_sketch, sketch_bits

VALUES, TREES, SHORTEST, DEEPEST, NEAR = 63, 21, 3, 12, 8
DEPTHS = (3, 4, 5, 7, 9, 12)
#: Five standard deviations of an estimate from VALUES values at a similarity of 0.8.
SLACK = 0.25
#: Rows of one region that are compared at a time.
AT_ONCE = 20_000
#: Ids that are broadcast at most (8 MB); more are joined by a shuffle, with the same result.
SENT = 1_000_000
#: Numbers of 64 bits that hold the parity of a set.
PARITIES = 16
#: Most cells of each of the two rows that hold frequencies, four bits a cell (64 MB together).
MOST_RARITY_BITS = 26
_SEEDS = mixed(np.arange(1, 2 * VALUES + 1, dtype=np.uint64))


def shingle_sets(texts: list[bytes], size: int, seed: int) -> Iterator[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct shingles; of a shorter text the whole sequence, of an empty one nothing."""
    (hashes,), bounds = grouped_words(texts, (seed,), folded=True)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        words = hashes[a:b]
        if len(words):
            words = gram_hashes(words, min(size, len(words))) + np.uint64(min(size, len(words)))
            words.sort()
            words = words[np.concatenate([[True], words[1:] != words[:-1]])]
        yield words


def signature(shingles: np.ndarray) -> np.ndarray:
    out = np.full(VALUES, 2**32 - 1, dtype=np.uint32)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096, None]
        out = np.minimum(out, (((part ^ _SEEDS[:VALUES]) * (_SEEDS[VALUES:] | np.uint64(1))) >> np.uint64(32)).min(axis=0).astype(np.uint32))
    return out


def tree_keys(sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each class and tree: a hash of the tree and the first SHORTEST values, and the values after them, 2 bytes each."""
    n = len(sketches)
    turns = (np.arange(TREES)[:, None] * (VALUES // TREES) + np.arange(DEEPEST)) % VALUES
    values = sketches[:, turns]  # n, TREES, DEEPEST
    key = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), (n, TREES)).copy()
    for i in range(SHORTEST):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + values[:, :, i].astype(np.uint64))
    return key, (values[:, :, SHORTEST:] & 0xFFFF).astype(">u2")


def region_pairs(order: np.ndarray, low: np.ndarray, sizes: np.ndarray, least: float, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Candidates within a region in sorted order: indices of pairs, their estimates, and whether one is a centre.

    low has one byte a value. Sets whose sizes alone rule the similarity out are let go.
    """
    n = len(order)
    left, right = [], []
    for step in range(1, min(NEAR, n - 1) + 1):
        left.append(np.arange(n - step))
        right.append(np.arange(step, n))
    if n > NEAR + 1:
        differs = order[1:] != order[:-1]
        common = SHORTEST + np.where(differs.any(axis=1), differs.argmax(axis=1), order.shape[1])
        for depth in DEPTHS:
            cuts = np.flatnonzero(np.concatenate([[True], common < depth, [True]]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                rest = np.arange(a, b)
                for _ in range(16):
                    if len(rest) <= NEAR + 1:
                        break
                    at = rest[centre(low[rest])[0]]
                    left.append(np.full(len(rest), at))
                    right.append(rest)
                    rest = rest[(low[rest] == low[at]).mean(axis=1) < least]
    near = sum(map(len, left[: min(NEAR, n - 1)]))
    i, j = np.concatenate(left), np.concatenate(right)
    seen, at = np.unique((np.minimum(i, j) * np.int64(n) + np.maximum(i, j))[::-1], return_index=True)
    central = at < len(i) - near  # reversed: a pair that both ways found counts as a centre's
    i, j = seen // n, seen % n
    fits = (i != j) & (100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j]))
    i, j, central = i[fits], j[fits], central[fits]
    if not len(i):
        return i, j, np.empty(0), central
    share = np.concatenate([(low[i[k : k + 50_000]] == low[j[k : k + 50_000]]).mean(axis=1) for k in range(0, len(i), 50_000)])
    good = share >= least
    return i[good], j[good], share[good], central[good]


def centre(low: np.ndarray) -> tuple[int, int]:
    """The row that agrees most with the most common value of each column, and in how many columns."""
    columns = np.arange(low.shape[1]) * 256
    counts = np.bincount((low + columns).ravel(), minlength=256 * low.shape[1]).reshape(-1, 256)
    agree = (low == counts.argmax(axis=1)).sum(axis=1)
    return int(agree.argmax()), int(agree.max())


def candidate_pairs(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs of classes (id, n, sketch), and the members of regions in which not all pairs are compared.

    Pairs: a, b, share, votes, a < b; votes: how often one was a centre for the other. Members: key (of the region), id.
    """
    least = percent / 100 - SLACK
    spark = classes.sparkSession

    def keys(batches):
        for batch in batches:
            if batch.num_rows:
                found = tree_keys(np.array([np.frombuffer(x, "<u4") for x in batch.column(batch.schema.get_field_index("sketch")).to_pylist()]))[0].ravel()
                yield found, found

    maps = merged_sketch(classes.select("sketch"), keys, sketch_bits(classes.count() * TREES))

    def entries(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sketches = np.array([np.frombuffer(x, "<u4") for x in part.column(2).to_pylist()])
                key, order = tree_keys(sketches)
                twice = estimated_repeated(key.ravel(), maps.value, 0) & estimated_repeated(key.ravel(), maps.value, 1)
                doc, tree = np.nonzero(twice.reshape(key.shape))
                low = [x.tobytes() for x in (sketches & 0xFF).astype(np.uint8)]
                yield pa.record_batch({
                    "key": key[doc, tree].view(np.int64),
                    "ordered": pa.array([x.tobytes() for x in order[doc, tree]], pa.binary()),
                    "id": pa.array(part.column(0).to_numpy(zero_copy_only=False)[doc], pa.int64()),
                    "n": pa.array(part.column(1).to_numpy(zero_copy_only=False)[doc], pa.int64()),
                    "low": pa.array([low[i] for i in doc.tolist()], pa.binary()),
                })

    schema = "key long, ordered binary, id long, n long, low binary"
    placed = classes.select("id", "n", "sketch").mapInArrow(entries, schema)
    dealt = placed.repartitionByRange(shuffles(spark), "key", "ordered", "id").sortWithinPartitions("key", "ordered", "id")
    out_schema = "a long, b long, share double, votes long, key long, n long, low binary"

    def compare(batches):
        held, first = [], True
        for row in rows(batches, "key", "ordered", "id", "low", "n"):
            if held and (row[0] != held[0][0] or len(held) >= AT_ONCE):
                yield from found(held, first or row[0] == held[0][0])
                first, held = row[0] == held[0][0], []
            held.append(row)
        if held:
            yield from found(held, True)

    def found(held, edge):
        """The region's pairs; of one that may go on in another task or slice its centre, as a row with a key; of that and of a crowded one all members."""
        low = np.frombuffer(b"".join(r[3] for r in held), dtype=np.uint8).reshape(len(held), -1)
        ids, sizes = np.array([r[2] for r in held], dtype=np.int64), np.array([r[4] for r in held], dtype=np.int64)
        if len(held) > 1:
            order = np.frombuffer(b"".join(r[1] for r in held), dtype=">u2").reshape(len(held), -1)
            i, j, share, central = region_pairs(order, low, sizes, least, percent)
            if len(i):
                none = pa.nulls(len(i), pa.int64())
                yield pa.record_batch({"a": np.minimum(ids[i], ids[j]), "b": np.maximum(ids[i], ids[j]), "share": share, "votes": central.astype(np.int64), "key": none, "n": none, "low": pa.nulls(len(i), pa.binary())})
        if edge:
            at, agree = centre(low)
            yield pa.record_batch({"a": ids[at : at + 1], "b": ids[at : at + 1], "share": np.array([float(agree)]), "votes": np.ones(1, np.int64), "key": pa.array([held[0][0]], pa.int64()), "n": sizes[at : at + 1], "low": pa.array([held[at][3]], pa.binary())})

        if edge or len(held) > NEAR + 1:
            yield pa.record_batch({"a": ids, "b": ids, "share": np.zeros(len(ids)), "votes": np.zeros(len(ids), np.int64), "key": np.full(len(ids), held[0][0], np.int64), "n": sizes, "low": pa.nulls(len(ids), pa.binary())})

    told = written(dealt.mapInArrow(compare, out_schema))
    pairs = told.filter("key is null").select("a", "b", "share", "votes")
    # regions in several tasks: all members meet the best of their centres; two centres a task and slice at most
    best = told.filter("low is not null").groupBy("key").agg(F.count("*").alias("parts"), F.max_by(F.struct("a", "n", "low"), F.struct("share", -F.col("a"))).alias("c"))
    best = best.filter("parts > 1").select("key", F.col("c.a").alias("centre"), F.col("c.n").alias("centre_n"), F.col("c.low").alias("centre_low"))
    if best.limit(1).count():

        def meet(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                one, two, a, b = (batch.column(i).to_pylist() for i in range(4))
                share = (np.frombuffer(b"".join(one), np.uint8) == np.frombuffer(b"".join(two), np.uint8)).reshape(len(one), -1).mean(axis=1)
                a, b = np.array(a, np.int64), np.array(b, np.int64)
                good = (share >= least) & (a != b)
                yield pa.record_batch({"a": np.minimum(a, b)[good], "b": np.maximum(a, b)[good], "share": share[good], "votes": np.ones(int(good.sum()), np.int64)})

        fits = F.expr(f"100 * least(n, centre_n) >= {int(percent)} * greatest(n, centre_n)")
        across = placed.join(best, "key").filter(fits).select("low", "centre_low", "id", "centre").mapInArrow(meet, "a long, b long, share double, votes long")
        pairs = pairs.union(across)
    pairs = pairs.groupBy("a", "b").agg(F.max("share").alias("share"), F.sum("votes").alias("votes"))
    return pairs, told.filter("key is not null and low is null").select("key", F.col("a").alias("id"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets (id, shingles)."""

    def check(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                good = []
                for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                    both = np.concatenate([x, y])
                    both.sort()
                    same = int(np.count_nonzero(both[1:] == both[:-1]))
                    good.append(100 * same >= percent * (len(both) - same))
                yield part.select([0, 1]).filter(pa.array(good, pa.bool_()))

    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    return pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def rarity(sets: DataFrame, sets_of: Callable, items: int) -> Broadcast:
    """A count-min sketch of frequencies as classes: 0 for one set, then one class for each doubling, up to 15.

    sets_of(batches) yields arrays of the shingles of one set or several.
    """
    spark, bits = sets.sparkSession, min(MOST_RARITY_BITS, sketch_bits(items))
    size = 2**BLOCK_BITS

    def touched(batches):
        held, total = [], 0
        for found in sets_of(batches):
            held.append(found)
            total += len(found)
            if total >= FLUSH:
                yield sent(np.concatenate(held))
                held, total = [], 0
        if total:
            yield sent(np.concatenate(held))

    def sent(found):
        blocks, packed = [], []
        for row in range(2):
            cell, count = np.unique(cells(found, row, bits), return_counts=True)
            low, count = (cell & np.uint32(size - 1)).astype("<u2"), np.minimum(count, 255).astype(np.uint8)
            starts = np.flatnonzero(np.concatenate([[True], np.diff(cell >> np.uint32(BLOCK_BITS)) > 0]))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(cell)], strict=True):
                blocks.append(row << 24 | int(cell[a] >> np.uint32(BLOCK_BITS)))
                packed.append(low[a:b].tobytes() + count[a:b].tobytes())
        return pa.record_batch({"block": pa.array(blocks, pa.int32()), "counts": pa.array(packed, pa.binary())})

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own, n = sums.setdefault(block, np.zeros(size, dtype=np.uint32)), len(packed) // 3
                own[np.frombuffer(packed, dtype="<u2", count=n)] += np.frombuffer(packed, dtype=np.uint8, offset=2 * n)
        for block, own in sums.items():
            level = np.minimum(np.ceil(np.log2(np.maximum(own, 1))), 15).astype(np.uint8)
            if level.any():
                yield pa.record_batch({"block": pa.array([block], pa.int32()), "levels": pa.array([(level[::2] | level[1::2] << 4).tobytes()], pa.binary())})

    found = sets.mapInArrow(touched, "block int, counts binary").repartition(shuffles(spark), "block").mapInArrow(merge, "block int, levels binary")
    maps = np.zeros((2, 2**bits // 2), dtype=np.uint8)
    for block, packed in found.toLocalIterator():  # 2^MOST_RARITY_BITS bytes at most
        at = (block & 0xFFFFFF) * size // 2
        maps[block >> 24, at : at + size // 2] = np.frombuffer(packed, dtype=np.uint8)
    return spark.sparkContext.broadcast(Maps(row.tobytes() for row in maps))


def rarity_of(items: np.ndarray, maps: list[bytes]) -> np.ndarray:
    """The frequency class of each item: the least of its cells."""
    out = np.full(len(items), 15, dtype=np.uint8)
    for row in range(2):
        levels = np.frombuffer(maps[row], dtype=np.uint8)
        cell = cells(items, row, (len(levels) * 2).bit_length() - 1)
        out = np.minimum(out, levels[cell >> np.uint32(1)] >> (np.uint8(4) * (cell & np.uint32(1)).astype(np.uint8)) & np.uint8(15))
    return out


def prefixes(members: DataFrame, shingle: int, percent: int, items: int, seed: int) -> DataFrame:
    """key, id, part, n, place, p0...: shingles in the prefix of each member (doc_id, text, part), but those that no other set has, and the set's parity."""

    def sets_of(batches):
        for group in groups(((i, utf8(text), part) for i, text, part in rows(batches, "doc_id", "text", "part")), 250_000):
            for (i, _, part), s in zip(group, shingle_sets([x[1] for x in group], shingle, seed), strict=True):
                if len(s):
                    yield i, part, s

    maps = rarity(members, lambda batches: (s for *_, s in sets_of(batches)), items)

    def run(batches):
        out, size = [], 0
        for i, part, s in sets_of(batches):
            level = rarity_of(s, maps.value)
            upto = len(s) - -(-percent * len(s) // 100) + 1
            alone = int(np.count_nonzero(level == 0))
            if alone < upto:
                out.append((i, part, len(s), alone, s[np.argsort(level, kind="stable")[alone:upto]], parity(s)))
                size += upto - alone
            if size > 100_000:
                yield made(out)
                out, size = [], 0
        if out:
            yield made(out)

    def made(out):
        number = [len(x[4]) for x in out]
        return pa.record_batch({
            "key": np.concatenate([x[4] for x in out]).view(np.int64),
            "id": np.repeat(np.array([x[0] for x in out], np.int64), number),
            "part": np.repeat(np.array([x[1] for x in out], np.int64), number),
            "n": np.repeat(np.array([x[2] for x in out], np.int64), number),
            "place": np.concatenate([np.arange(x[3], x[3] + len(x[4]), dtype=np.int64) for x in out]),
        } | {f"p{k}": np.repeat(np.array([x[5][k] for x in out], np.int64), number) for k in range(PARITIES)})

    return members.mapInArrow(run, "key long, id long, part long, n long, place long" + "".join(f", p{k} long" for k in range(PARITIES)))


def parity(s: np.ndarray) -> np.ndarray:
    """For each of 64 * PARITIES buckets whether an odd number of the shingles fall into it, as int64 numbers."""
    counts = np.bincount((mixed(s) & np.uint64(64 * PARITIES - 1)).astype(np.int64), minlength=64 * PARITIES)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def pairs_apart(placed: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of sets (key, id, part, n, place, parity) of different components that all filters pass.

    Besides lengths and places, the parities of two sets bound their overlap: they differ in
    no more bits than the sets have elements of one's own. Of a key's largest component
    only pairs with the others are looked at, and what the filters stop is never a row.
    """
    parts = placed.groupBy("key", "part").agg(F.count("*").alias("number"))
    several = parts.groupBy("key").agg(F.max_by("part", F.struct("number", "part")).alias("largest"), F.count("*").alias("parts")).filter("parts > 1").select("key", "largest")
    both = written(placed.join(several, "key"))
    fits = f"""a.key = b.key and a.part <> b.part and (b.part = b.largest or a.part < b.part)
        and 100 * least(a.n, b.n) >= {int(percent)} * greatest(a.n, b.n)
        and {100 + int(percent)} * least(a.n - a.place, b.n - b.place) >= {int(percent)} * (a.n + b.n)
        and {100 + int(percent)} * ({" + ".join(f"bit_count(a.p{i} ^ b.p{i})" for i in range(PARITIES))}) <= {100 - int(percent)} * (a.n + b.n)"""
    found = both.filter("part <> largest").alias("a").join(both.alias("b"), F.expr(fits))
    return found.select(F.expr("least(a.id, b.id) as a"), F.expr("greatest(a.id, b.id) as b")).distinct()


def sent(df: DataFrame) -> DataFrame:
    """df, computed; to be broadcast where it has no more than SENT rows."""
    df = gathered(df)
    return F.broadcast(df) if df.count() <= SENT else df


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Documents are linked where 100 * intersection >= percent * union of their shingle
    sets; component_id is the smallest doc_id reachable, kept says that it is the
    document's own. Null and empty texts have no shingles and no links; rows with a null
    doc_id have no links, a null component and are kept; rows with one doc_id count as
    one document with several texts.
    """
    texts, seed = narrow(docs, doc_id="long", text="string"), new_seed()

    def sets_in(batches):
        """doc_id and set of each row."""
        for group in groups(((doc_id, utf8(text)) for doc_id, text in rows(batches, "doc_id", "text")), 250_000):
            yield from zip((doc_id for doc_id, _ in group), shingle_sets([text for _, text in group], shingle, seed), strict=True)

    def signed(batches):
        out = []
        for doc_id, s in sets_in(batches):
            out.append((doc_id, len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None, signature(s).astype("<u4").tobytes() if len(s) else None))
            if len(out) >= 1000:
                yield made(out)
                out = []
        if out:
            yield made(out)

    def made(out):
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "n_shingles", "set_id", "sketch"])

    signatures = stored(texts.mapInArrow(signed, "doc_id long, n_shingles long, set_id binary, sketch binary"))
    whole = signatures.filter("doc_id is not null and set_id is not null")
    classes = stored(whole.groupBy("set_id").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")))
    pairs, crowded = candidate_pairs(classes, percent)
    pairs = gathered(pairs)

    def full(batches):
        for doc_id, s in sets_in(batches):
            yield pa.record_batch({"id": pa.array([doc_id], pa.int64()), "shingles": pa.array([s.astype("<u8").tobytes()], pa.binary())})

    def sets_of(pairs):
        """Full sets, of documents in a candidate pair only."""
        involved = sent(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
        return stored(texts.join(involved, "doc_id", "left_semi").mapInArrow(full, "id long, shingles binary"))

    sets = sets_of(pairs)
    # first each document with the centre that it met most often (else its likeliest partner), then whatever still joins different components
    ends = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "share", "votes"))
    best = ends.groupBy("a").agg(F.max(F.struct("votes", "share", (-F.col("b")).alias("b"))).alias("m"))
    first = gathered(best.select(F.least("a", -F.col("m.b")).alias("a"), F.greatest("a", -F.col("m.b")).alias("b")).distinct())
    links = gathered(confirmed(first, sets, percent))
    parts = gathered(components(links))
    own = lambda side: F.coalesce(F.col(f"component_{side}"), F.col(side))
    placed = pairs.join(parts.select(F.col("id").alias("a"), F.col("component").alias("component_a")), "a", "left").join(parts.select(F.col("id").alias("b"), F.col("component").alias("component_b")), "b", "left")
    apart = placed.filter(own("a") != own("b")).join(first, ["a", "b"], "left_anti")
    more = gathered(confirmed(gathered(apart.select("a", "b")), sets, percent))
    members = whole.select("doc_id", "set_id").join(classes.select("set_id", "id"), "set_id")
    # a document with several texts ties their classes together
    multiple = sent(whole.groupBy("doc_id").agg(F.min("set_id").alias("x"), F.max("set_id").alias("y")).filter("x <> y").select("doc_id"))
    theirs = gathered(members.join(multiple, "doc_id", "left_semi").select("doc_id", "id").distinct())
    ties = theirs.join(theirs.groupBy("doc_id").agg(F.min("id").alias("a")), "doc_id").filter("a <> id").select("a", F.col("id").alias("b"))
    more = gathered(more.union(ties))
    # components of components, over the links found since
    to = lambda side: parts.select(F.col("id").alias(side), F.col("component").alias(f"component_{side}"))
    joined = components(more.join(to("a"), "a", "left").join(to("b"), "b", "left").select(own("a").alias("a"), own("b").alias("b")))
    own_part = members.groupBy("doc_id").agg(F.min("id").alias("id")).join(parts, "id", "left").select("doc_id", F.coalesce("component", "id").alias("part"))
    placed = stored(own_part.join(joined.select(F.col("id").alias("part"), "component"), "part", "left").select("doc_id", F.coalesce("component", "part").alias("part")))
    # what crowded regions left apart: members of those that hold several components
    crowded = crowded.join(placed.select(F.col("doc_id").alias("id"), "part"), "id")
    several = sent(crowded.groupBy("key").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x < y").select("key"))
    members = sent(crowded.join(several, "key", "left_semi").select(F.col("id").alias("doc_id"), "part").distinct())
    if members.limit(1).count():
        items = signatures.join(members, "doc_id", "left_semi").agg(F.sum("n_shingles")).first()[0]
        ordered = written(prefixes(texts.join(members, "doc_id"), shingle, percent, items, seed))
        apart = gathered(pairs_apart(ordered, percent))
        late = confirmed(apart, sets_of(apart), percent)
        to = lambda side: placed.select(F.col("doc_id").alias(side), F.col("part").alias(f"component_{side}"))
        joined = components(late.join(to("a"), "a").join(to("b"), "b").select(F.col("component_a").alias("a"), F.col("component_b").alias("b")))
        placed = placed.join(joined.select(F.col("id").alias("part"), "component"), "part", "left").select("doc_id", F.coalesce("component", "part").alias("part"))
    placed = placed.withColumnRenamed("part", "component_id")
    out = signatures.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))

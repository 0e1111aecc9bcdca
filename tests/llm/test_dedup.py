import random

import numpy as np
import pytest

from tests.llm import cases
from vectorloom.llm import common, components, minhash, repeats, substring, suffix

DOCS = cases.texts()


def test_near_duplicates_match_brute_force(spark):
    for size in (4, 5):
        want = cases.near_components(DOCS, size)
        rows = minhash.near_duplicates(cases.frame(spark, DOCS), size, 80).collect()
        assert {r.doc_id: r.component_id for r in rows} == want
        assert all(r.n_shingles == len(cases.shingles(DOCS[r.doc_id], size)) and r.kept == (want[r.doc_id] == r.doc_id) for r in rows)


def test_near_duplicates_with_odd_rows(spark):
    rows = minhash.near_duplicates(cases.frame(spark, [(5, "a b c d e f"), (5, "a b c d e f"), (5, "other text here"), (9, "a b c d e f"), (None, "a b c d e f"), (None, None), (7, "OTHER text here")]), 4, 80).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id is not None) == [(5, 5, True)] * 3 + [(7, 5, False), (9, 5, False)]
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)] * 2
    assert minhash.near_duplicates(cases.frame(spark, DOCS).limit(0), 4, 80).count() == 0
    rows = minhash.near_duplicates(cases.frame(spark, [(1, "a b c d e f"), (2, "other text here again"), (5, "a b c d e f"), (5, "other text here again")]), 4, 80).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(1, 1), (2, 1), (5, 1)}


def test_family_of_copies_is_one_component(spark):
    """A large family whose copies are like their origin, but not like each other; in slices so that regions span tasks."""
    r = random.Random(4)
    origin = [f"w{r.randint(0, 10**6)}" for _ in range(200)]
    docs = {0: " ".join(origin)}
    for i in range(1, 150):
        words = list(origin)
        for at in r.sample(range(0, 200, 5), 4):
            words[at] = f"x{r.randint(0, 10**6)}"
        docs[i] = " ".join(words)
    want = cases.near_components(docs, 4)
    old, minhash.AT_ONCE = minhash.AT_ONCE, 20
    try:
        rows = minhash.near_duplicates(cases.frame(spark, docs), 4, 80).collect()
    finally:
        minhash.AT_ONCE = old
    assert {r.doc_id: r.component_id for r in rows} == want


def boilerplate_families(families=300, seed=9):
    """Pairs of near copies over one long common text; documents of different pairs are alike, but under the threshold."""
    r = random.Random(seed)
    word = lambda: f"w{r.randint(0, 10**9)}"
    common, docs = [word() for _ in range(170)], {}
    for i in range(families):
        own = [word() for _ in range(14)]
        for j in range(2):
            docs[2 * i + j] = " ".join(common + own + [word() for _ in range(22)])
    return docs


def test_families_over_boilerplate_are_found_whole(spark):
    """One hot region with many families, each far from the region's centres."""
    docs = boilerplate_families()
    want = cases.near_components(docs, 4)
    assert len(set(want.values())) == 300
    rows = minhash.near_duplicates(cases.frame(spark, docs), 4, 80).collect()
    assert {r.doc_id: r.component_id for r in rows} == want


def test_slices_do_not_change_families(spark, monkeypatch):
    """The same with a region that is cut into slices, so that near copies stand on two sides of a cut."""
    monkeypatch.setattr(minhash, "AT_ONCE", 12)
    docs = boilerplate_families(80, 10)
    rows = minhash.near_duplicates(cases.frame(spark, docs), 4, 80).collect()
    assert {r.doc_id: r.component_id for r in rows} == {i: i - i % 2 for i in docs}


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 50), (50, 101), (7, 7), (100, 101)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {50: 50, 100: 50, 101: 50}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def check_words(spark, docs, window, **more):
    words = {k: cases.WORD.findall(t or "") for k, t in docs.items()}
    keep = cases.kept_by_windows(words, window)
    rows = substring.digest(cases.frame(spark, docs), window).collect()
    assert len(rows) == len(docs)
    for r in rows:
        kept = " ".join(w for w, k in zip(words[r.doc_id], keep[r.doc_id], strict=True) if k)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(words[r.doc_id]), keep[r.doc_id].count(False), cases.digest(kept)), r.doc_id


def check_bytes(spark, docs, window):
    data = {k: (t or "").encode() for k, t in docs.items()}
    keep = cases.kept_by_windows({k: list(d) for k, d in data.items()}, window)
    rows = suffix.digest(cases.frame(spark, docs), window).collect()
    assert len(rows) == len(docs)
    for r in rows:
        own = keep[r.doc_id]
        spans = sum(not k and (i == 0 or own[i - 1]) for i, k in enumerate(own))
        kept = bytes(b for b, k in zip(data[r.doc_id], own, strict=True) if k)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(data[r.doc_id]), own.count(False), spans, cases.digest(kept)), r.doc_id


@pytest.mark.parametrize("window", [13, 3])
def test_substring_dedup_matches_brute_force(spark, window):
    check_words(spark, DOCS, window)


@pytest.mark.parametrize("window", [50, 10])
def test_suffix_dedup_matches_brute_force(spark, window):
    check_bytes(spark, {k: (t or "")[:20_000] if t else t for k, t in DOCS.items()}, window)


def test_crowded_buckets_are_grouped_apart(spark, monkeypatch):
    """Buckets that outgrow a slice take the other way, with the same result."""
    monkeypatch.setattr(repeats, "SLICE", 200)
    docs = {i: f"start{i} " + "same words again and again until the end of this very common line of text here now " * 2 + f"end{i}" for i in range(40)}
    docs |= {i: " ".join(f"{i}v{j}" for j in range(9)) + " same words again and again until the end of this very common line" for i in range(40, 80)}
    check_words(spark, docs, 13)
    check_bytes(spark, docs, 50)


def test_removal_with_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = cases.frame(spark, [(3, text), (3, text), (4, text), (None, text), (5, None), (6, "")])
    assert sorted((r.doc_id, r.n_removed) for r in substring.kept_words(docs, 13).collect() if r.doc_id is not None) == [(3, 0), (3, 0), (4, 30), (5, 0), (6, 0)]
    assert sorted((r.doc_id, r.n_removed > 0) for r in suffix.kept_bytes(docs, 50).collect() if r.doc_id is not None) == [(3, False), (3, False), (4, True), (5, False), (6, False)]
    assert [r.n_removed for r in substring.kept_words(docs, 13).filter("doc_id is null").collect()] == [0]
    for operator in (substring.digest, suffix.digest):
        assert operator(docs.limit(0), 13).count() == 0


def test_sketch_never_underestimates(spark):
    items = np.arange(1, 3000, dtype=np.uint64)

    def items_of(batches):
        for batch in batches:
            for start in batch.column(0).to_pylist():
                own = common.mixed(items[start : start + 200])
                yield own, own

    maps = repeats.merged_sketch(spark.createDataFrame([(i,) for i in (0, 100, 1000, 1000)], "a long"), items_of, 16).value
    hashes = common.mixed(items)
    twice = repeats.estimated_repeated(hashes, maps, 0) & repeats.estimated_repeated(hashes, maps, 1)
    assert twice[100:200].all()
    assert twice[1000:1200].all()
    assert twice.sum() < 400


def test_minimizers_match_brute_force():
    r = random.Random(0)
    for _ in range(400):
        top = r.choice([1, 3, 50])
        h, w = np.array([r.randint(0, top) for _ in range(r.randint(0, 60))], dtype=np.uint64), r.randint(1, 12)
        for rightmost in (False, True):
            want: dict[int, int] = {}
            for i in range(len(h) - w + 1):
                own = np.flatnonzero(h[i : i + w] == h[i : i + w].min())
                want.setdefault(i + int(own[-1 if rightmost else 0]), i)
            at, first = common.minimizers(h, w, rightmost)
            assert list(zip(at.tolist(), first.tolist(), strict=True)) == sorted(want.items())


def test_word_hashes_are_of_words(monkeypatch):
    monkeypatch.setattr(common, "_BLOCK", 64)
    data = (" \t".join(f"w{i % 7} Ünï{i}" for i in range(60)) + " " + "z" * 500 + " w1").encode()
    words = data.split()
    hashes = common.word_hashes(data).tolist()
    assert len(hashes) == len(words)
    known: dict = {}
    assert all(known.setdefault(w, h) == h for w, h in zip(words, hashes, strict=True))
    assert len(set(known.values())) == len(known)
    assert (common.word_hashes(b"ABC d", folded=True) == common.word_hashes(b"abc D", folded=True)).all()


def thue_morse(one: str, two: str, size: int = 1024) -> str:
    return "".join((one, two)[bin(i).count("1") % 2] for i in range(size))


def test_long_words_do_not_collide(spark):
    """Words on which every polynomial hash modulo a power of two agrees, whatever its base."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    docs = {k: " ".join(thue_morse(*pair) for pair in zip(letters[0::2], letters[1::2], strict=True)) for k, letters in ((1, letters), (2, "".join(b + a for a, b in zip(letters[0::2], letters[1::2], strict=True))))}
    assert len(set(" ".join(docs.values()).split())) == 26
    check_words(spark, docs, 13)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(cases.frame(spark, docs), 4, 80).collect()} == {1: 1, 2: 2}


def test_words_have_one_hash_for_each_seed():
    words = [b"x" * n for n in range(1, 140)] + [b"x" * n + b"y" for n in range(0, 140)] + [bytes([b]) for b in range(128, 256)]
    one, two = common.hashed_words(b" ".join(words), seeds=(1, 2))[0]
    assert len(set(one.tolist())) == len(set(words)) == len(set(two.tolist()))
    assert not set(one.tolist()) & set(two.tolist())
    again = common.hashed_words(b"\n  ".join(reversed(words)), seeds=(1,))[0][0]
    assert (again[::-1] == one).all()


def test_heavy_keys_are_dealt_window_by_window(spark, monkeypatch):
    """A line that stands in every document, in contexts of which many repeat."""
    r = random.Random(6)
    word = lambda n=400: f"w{r.randint(0, n)}"
    line, ends = "this very common line stands in each and every one of the documents", [" ".join(word() for _ in range(9)) for _ in range(60)]
    docs = {i: " ".join([*(word() for _ in range(3)), r.choice(ends), line, r.choice(ends), *(word() for _ in range(3))]) for i in range(1500)}
    seen, made = [], repeats.merged_sketch
    for module in (substring, suffix):
        monkeypatch.setattr(module, "heavy_limit", lambda *a: 2)
        monkeypatch.setattr(module, "merged_sketch", lambda *a: seen.append(made(*a)) or seen[-1])
    check_words(spark, docs, 13)
    check_bytes(spark, docs, 50)
    assert all(len(maps.value[repeats.ROWS]) for maps in seen) and len(seen) == 2


def test_radix_groups_are_equal_windows():
    r = random.Random(1)
    data = np.array([r.randint(0, 1) for _ in range(600)], dtype=np.uint8)
    for width in (3, 8, 13, 50):
        start = np.array(r.sample(range(len(data) - width), 300))
        bucket = start % 2
        group = suffix.groups_by_radix(data, start, width, bucket)
        own = [(b, data[s : s + width].tobytes()) for s, b in zip(start.tolist(), bucket.tolist(), strict=True)]
        for i, g in enumerate(group.tolist()):
            assert [j for j in range(300) if own[j] == own[i]] == ([i] if g < 0 else np.flatnonzero(group == g).tolist())


def test_exchange_grows_with_the_sketch():
    """Chunks grow before shards do, both stop at a bound of memory, and a row of the sketch has many shards at every size."""
    sizes = [repeats.exchange_sizes(bits) for bits in range(10, 49)]
    assert sizes == sorted(sizes) and sizes[-1] == (32_000_000, 26) and repeats.exchange_sizes(30) == (1_000_000, 24)
    for bits in range(22, 49):
        chunk, shard_bits = repeats.exchange_sizes(bits)
        assert bits - shard_bits >= 6
        # cells that a chunk sends to a shard: about one in 24 bytes
        assert bits < 30 or bits > 37 or chunk / 24 / 2 ** (bits - shard_bits) > 600
        assert bits > 45 or bits < 30 or chunk / 24 / 2 ** (bits - shard_bits) > 2


def test_sketch_that_is_exchanged(spark, monkeypatch):
    """A prefilter too large to be broadcast: same spans, few windows that pass, also where shards, chunks and ids repeat."""
    r = random.Random(12)
    prose = lambda n: " ".join(f"w{r.randint(0, 5000)}" for _ in range(n))
    line = prose(20)
    docs = dict(DOCS) | {1000 + i: prose(60) + (" " + line + " " + prose(30) if i % 3 == 0 else "") for i in range(900)}
    every = cases.frame(spark, docs, [(1003, docs[1003]), (1003, docs[1000]), (None, docs[1006])])
    monkeypatch.setattr(repeats, "CHUNK", 20_000)
    monkeypatch.setattr(repeats, "SHARD_BITS", 14)
    sent = []
    for module, window, limit in ((substring, 13, 2), (suffix, 50, 2), (suffix, 50, 10**9)):
        made = module.matched
        with monkeypatch.context() as m:
            m.setattr(module, "heavy_limit", lambda *a, limit=limit: limit)
            m.setattr(module, "matched", lambda f, *a, made=made: sent.append(f.filter("part is not null and doc_id >= 1000").agg({"windows": "sum"}).first()[0]) or made(f, *a))
            found = [{r.doc_id: sorted((s.start, s.windows) for s in r.spans) for r in module.repeated_windows(every, window, bits).collect()} for bits in (29, 10)]
        covered = [{k: sorted({i for a, n in own for i in range(a, a + n)}) for k, own in x.items()} for x in found]
        assert covered[0] == covered[1] and len(covered[0]) > 250
    # what a sketch of full size lets pass is hardly more than what is repeated
    assert all(abs(a - b) < 0.1 * 900 * 90 * k for a, b, k in zip(sent[0::2], sent[1::2], (1, 5, 5), strict=True))
    none = every.limit(0)
    assert substring.repeated_windows(none, 13, 10).count() == suffix.repeated_windows(none, 50, 10).count() == 0


def test_words_that_repeat_on_and_on_are_few_rows(spark, monkeypatch):
    """Every place of an equal fragment in a document is in one row; also where its key outgrows a slice."""
    docs = {i: f"start{i} " + "is one " * (150 + i) + f"end{i} " + "or two three " * 40 for i in range(24)}
    for module in (substring, suffix):
        sent, made = [], module.matched
        with monkeypatch.context() as m:
            m.setattr(module, "matched", lambda f, *a, sent=sent, made=made: sent.append(f.filter("part is not null").groupBy("key", "doc_id").count().agg({"count": "max"}).first()[0]) or made(f, *a))
            check_words(spark, docs, 13) if module is substring else check_bytes(spark, docs, 50)
        assert sent[0] <= 8
    monkeypatch.setattr(repeats, "SLICE", 200)
    check_words(spark, docs, 13)
    check_bytes(spark, docs, 50)

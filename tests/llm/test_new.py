"""Spelling variants, sharding and whitening."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from vectorloom.llm import queries, sharding, spelling, whitening


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_sharding", "quality_base"])
def test_query_matches_sql(name, same):
    same(queries.QUERIES[name], queries.ORACLES[name])


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(docs: list[tuple]) -> dict:
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 5 and k >= 3}
    close = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(close[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(close[w]), n.get(form[w]))
    return out


def found_variants(frame) -> dict:
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(frame).collect()}


def test_variants_match_brute_force(spark):
    r = random.Random(4)
    docs = list(cases.texts().items())
    bases = ["".join(r.choice("abcé") for _ in range(r.randint(4, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "ababab", "bababa", "ÀÉ×÷ÿÄ", "straße"]
    noisy = []
    for w in bases:
        for _ in range(r.randint(3, 30)):
            at = r.randrange(len(w))
            noisy += r.choice([[w], [w], [w], [w[:at] + r.choice("abcéQ") + w[at + 1 :]], [w[:at] + w[at + 1 :]], [w[:at] + r.choice("abc") + w[at:]]])
    r.shuffle(noisy)
    docs += [(100 + i, " ".join(noisy[i::7])) for i in range(7)]
    # chains, ties, anagrams and long words
    docs += [(200, "chaina " * 40 + "chainb " * 18 + "xhainb " * 8 + "xhayyb xhainbb " * 3), (201, "triple-trible-trifle " * 5), (202, "listen silent enlist tinsel " * 3), (203, ("ab" * 30_000 + " ") * 3 + ("ab" * 29_999 + "aa ") * 7), (204, None), (204, "chaina"), (None, "chaina chaina"), (None, None)]
    assert found_variants(cases.frame(spark, docs)) == brute_variants(docs)


def test_variants_of_one_frequent_word_and_of_nothing(spark):
    hot = [(i, "frequent " * 50 + "frequant " * (i % 3)) for i in range(300)]
    assert found_variants(cases.frame(spark, hot)) == brute_variants(hot)
    for empty in ([(1, None), (2, ""), (3, "1234 漢字")], [(1, "abcdefg")]):
        assert found_variants(cases.frame(spark, empty)) == {}
    assert found_variants(cases.frame(spark, cases.texts()).limit(0)) == {}


def test_pieces_cut_no_run():
    text = "ab1" * 50 + "x" * 90 + " " + "é" * 40
    for size in (1, 7, 64):
        parts = list(spelling.pieces(text, size))
        assert "".join(parts) == text
        assert [m for p in parts for m in spelling.RUN.findall(p)] == spelling.RUN.findall(text)


def test_order_hashes_are_of_the_rest():
    words = ["abcab", "bcab", "aabcab", "zzzzz", "z" * 2000]
    points, bounds = spelling.spelled(words)
    for whole, less in spelling.order_hashes(points, bounds, [12345, 67891, 23456, 99991]):
        rest = {(i, p): (w[:p] + w[p + 1 :]) for i, w in enumerate(words) for p in range(len(w))}
        of = {}
        for (i, p), s in rest.items():
            of.setdefault(s, set()).add(int(less[bounds[i] + p]))
        assert all(len(v) == 1 for v in of.values())
        assert of["bcab"] == {int(whole[1])}
        assert len({next(iter(v)) for v in of.values()}) == len(of)


def shard_rows(frame, shards=24):
    return sharding.sharded(frame, shards).collect()


def test_shards_are_nearly_equal_and_gapless(spark):
    r = random.Random(8)
    docs = [(i, "x" * r.choice([0, 10, 100, 1000, 9000])) for i in range(3000)] + [(5000 + i, "copy " * 200) for i in range(1500)]
    rows = shard_rows(cases.frame(spark, docs))
    assert sorted(x.doc_id for x in rows) == sorted(k for k, _ in docs)
    texts = dict(docs)
    assert all((x.size, x.text_crc32, x.law, x.grown_shard) == (len(texts[x.doc_id]) + 8, zlib.crc32(texts[x.doc_id].encode()), "bytes", None) for x in rows)
    loads = Counter()
    for x in rows:
        loads[x.shard] += x.size
    assert sorted(loads) == list(range(24))
    assert max(loads.values()) - min(loads.values()) <= 0.001 * sum(loads.values()) / 24
    for s in range(24):
        own = sorted((x.slot, x.doc_id) for x in rows if x.shard == s)
        assert [a for a, _ in own] == list(range(len(own)))
        assert [b for _, b in own] == sorted(b for _, b in own)


def test_sharding_with_odd_rows(spark):
    odd = [(None, None), (None, "a"), (1, ""), (1, None), (2, "é漢"), (2, "é漢"), (3, "y" * 500_000)]
    rows = shard_rows(cases.frame(spark, odd))
    assert sorted((x.doc_id is None, x.doc_id or 0, x.size) for x in rows) == [(False, 1, 8), (False, 1, 8), (False, 2, 13), (False, 2, 13), (False, 3, 500_008), (True, 0, 8), (True, 0, 9)]
    assert all(x.text_crc32 is not None for x in rows)
    assert len({(x.shard, x.slot) for x in rows}) == len(rows)
    assert shard_rows(cases.frame(spark, odd).limit(0)) == []
    hot = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    same = sharding.sharded(hot, 4)
    assert same.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m"), F.countDistinct("slot").alias("d")).filter("n = m + 1 and n = d").agg(F.sum("n")).first()[0] == 20_000


def test_map_versions(spark, tmp_path):
    path = str(tmp_path / "maps")
    first = sharding.first_map(spark, 5, 200)
    weights = spark.createDataFrame([(i, (i * 7919) % 1000 + (50_000 if i == 3 else 0)) for i in range(0, 200, 2)] + [(3, 9)], "virtual int, bytes long")
    weights = weights.groupBy("virtual").agg(F.sum("bytes").alias("bytes"))
    sharding.save_map(first, path)
    second = sharding.rebalanced(sharding.load_map(spark, path), weights, 5)
    sharding.save_map(second, path)
    third = sharding.grown(sharding.load_map(spark, path), weights, 5)
    sharding.save_map(third, path)
    sharding.save_map(third, path)  # written again: the same
    maps = {v: {r.virtual: r.shard for r in sharding.load_map(spark, path, v).collect()} for v in (1, 2, 3)}
    assert all(sorted(m) == list(range(200)) for m in maps.values())
    assert {r.version for r in sharding.load_map(spark, path).collect()} == {3}
    size = {r.virtual: r.bytes for r in weights.collect()}
    total = sum(size.values())

    def loads(m, shards):
        return [sum(size.get(v, 0) for v, s in m.items() if s == k) for k in range(shards)]

    assert maps[1] == {v: v % 5 for v in range(200)}
    # the plain version of the edit
    full, share, plain = [0] * 5, -(-total // 5), {}
    for v in sorted(range(200), key=lambda v: (-size.get(v, 0), v)):
        s = v % 5 if full[v % 5] + size.get(v, 0) <= share else full.index(min(full))
        plain[v] = s
        full[s] += size.get(v, 0)
    assert maps[2] == plain
    assert max(loads(maps[2], 5)) - min(loads(maps[2], 5)) <= 0.02 * share
    assert all(s in (maps[2][v], 5) for v, s in maps[3].items())
    after = loads(maps[3], 6)
    assert after[5] > 0.9 * total / 6 and max(after) <= 1.1 * total / 6
    empty = sharding.rebalanced(sharding.first_map(spark, 3, 10), spark.createDataFrame([], "virtual int, bytes long"), 3)
    assert {(r.version, r.virtual): r.shard for r in empty.collect()} == {(2, v): v % 3 for v in range(10)}


def vector_rows(seed=3, n=400, d=12):
    r = np.random.default_rng(seed)
    return r.normal(size=(n, d)) @ (r.normal(size=(d, d)) * np.linspace(3, 0.2, d)) * 0.1 + r.normal(size=d)


def vectors(spark, rows, parts=7):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, 2.0, "x") for i, v in rows], "vec_id long, embedding array<float>, n int, id double, x string").repartition(parts)


def test_whitening_matches_eigenvectors(spark):
    v = vector_rows().astype(np.float32)
    odd = [(1000, None), (1001, [None] * 12), (1002, [float("nan")] * 12), (1003, [float("inf")] + [0.0] * 11), (1004, []), (1005, [1.0, 2.0]), (1006, [1e30] * 12)]
    rows = whitening.whitened(vectors(spark, [*enumerate(v), *odd, (7, v[7]), (None, v[9])], 40)).collect()
    x = np.floor(1024 * np.concatenate([v, v[7:8], v[9:10]]).astype(np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    e, u = np.linalg.eigh((x - sums / n).T @ (x - sums / n) / n)
    e, u = e[::-1], u[:, ::-1]
    plain = (x - sums / n) @ u / np.sqrt(e)
    assert len(rows) == 8 * n
    at = {**{i: i for i in range(400)}, None: 401}
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert {k: len(p[1]) for k, p in got.items()} == {k: 2 if k == 7 else 1 for k in at}
    for k in range(1, 9):
        own = np.array([got[i][k][0].whitened for i in at])
        sign = np.sign(own[0] * plain[at[0], k - 1])
        assert np.allclose(own, sign * plain[[at[i] for i in at], k - 1], atol=1e-9)
        assert abs(got[0][k][0].explained / (e[k - 1] / e.sum()) - 1) < 1e-9
    for i, p in got.items():
        assert int(p[1][0].deviation) == int(((n * x[at[i]] - sums).astype(object) ** 2).sum())
        assert p[1][0].n == n and p[1][0].identity_error < 1e-9


def test_merging_is_lossless_in_any_tree():
    x = np.floor(1024 * vector_rows(5, 333, 9)).astype(np.int64) + 100_000
    parts = [whitening.State.of(x[a:b]) for a, b in ((0, 1), (1, 3), (3, 100), (100, 101), (101, 333))]
    left = parts[0].merged(parts[1]).merged(parts[2]).merged(parts[3]).merged(parts[4])
    right = parts[4].merged(parts[3].merged(parts[2])).merged(parts[1].merged(parts[0]))
    c = x - x.mean(axis=0)
    for s in (left, right):
        assert s.n == 333 and s.sums.tolist() == x.sum(axis=0).tolist()
        m = (s.values[:, None] * s.vectors).T @ (s.values[:, None] * s.vectors)
        assert np.allclose(m, c.T @ c, rtol=1e-10, atol=1e-6)
        assert len(s.values) == 9
    again = whitening.State.read(left.row(0))
    assert again.merged(parts[0]).n == 334


def test_deviations_are_exact_when_large():
    x = np.array([[2**40, -(2**40)], [5, 7]])
    sums = np.array([2**40 + 5, 7 - 2**40], dtype=object) * 10**6
    exact = [[10**9 * a - s for a, s in zip(row, sums, strict=True)] for row in x.tolist()]
    assert whitening.deviations(x, 10**9, sums).tolist() == exact


def test_whitening_without_choice(spark):
    assert whitening.whitened(vectors(spark, [])).count() == 0
    assert whitening.whitened(vectors(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whitened(vectors(spark, [(1, [0.5, 0.25])])).count() == 0
    assert whitening.whitened(vectors(spark, [(i, [0.5, 0.25]) for i in range(50)])).count() == 0
    flat = whitening.whitened(vectors(spark, [(i, [i / 64, 0.25, -i / 32]) for i in range(50)])).collect()
    assert {r.component for r in flat} == {1} and len(flat) == 50 and abs(flat[0].explained - 1) < 1e-9

"""All-pairs operators over many blocks and tiles, against products in numpy."""

from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from vectorloom.functions import columns as C
from vectorloom.operators import gram


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(gram, "BLOCK", 7)
    monkeypatch.setattr(gram, "PARTS", 3, raising=False)
    monkeypatch.setattr(gram, "TILE", 5, raising=False)


def vectors(n=60, d=5):
    v = np.random.default_rng(3).normal(size=(n, d))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def frame(spark, v):
    return spark.createDataFrame([(int(i) * 3, v[i].tolist()) for i in np.random.default_rng(4).permutation(len(v))] + [(None, v[0].tolist()), (7, None)], "vec_id long, embedding array<double>").repartition(5)


def products(v):
    return {(3 * i, 3 * j): float(v[i] @ v[j]) for i in range(len(v)) for j in range(i + 1, len(v))}


def test_a_vector_is_sent_to_no_more_groups_when_the_table_grows(spark, monkeypatch):
    monkeypatch.setattr(gram, "BLOCK", 1)
    own = gram.vectors_of(frame(spark, vectors(200)), "vec_id", "embedding")
    blocks = gram._blocks(own)
    assert gram._dealt(own, blocks, "left", blocks, True).count() <= 24 * 200
    monkeypatch.setattr(gram, "LARGEST", 5)
    assert gram._blocks(own) == 40


def test_pairs_over_tiles_with_places(spark, small):
    v = vectors()
    rows = gram.pair_cosines(frame(spark, v), places=6).collect()
    assert len(rows) == 60 * 59 // 2
    assert {(r.i, r.j): r.cos for r in rows} == {k: round(c, 6) for k, c in products(v).items()}
    assert gram.pair_cosines(frame(spark, np.repeat(v[:1], 3, axis=0)).withColumn("vec_id", F.lit(1))).count() == 0


def test_pairs_in_order_are_all_pairs(monkeypatch):
    """Also with lengths that leave few bits for a place, several parts of a group, zeros of either sign and ids of one block between those of the other."""
    monkeypatch.setattr(gram, "TILE", 5)
    monkeypatch.setattr(gram, "HELD", 60)
    monkeypatch.setattr(gram, "MANY", 1)
    v = np.concatenate([vectors(20), -vectors(3), [[1e-9, 0, 0, 0, 0], [-0.5, 0, 0, 0, 0], [0.5, 0, 0, 0, 0]]])
    ids, first = np.arange(len(v)) * 2, np.arange(len(v)) % 3 == 0
    for length, fits in ((1.0, True), (1e4, True), (1e10, False), (np.nan, False)):
        v[7] = vectors(8)[7] * length
        for one in (False, True):
            own = first | one
            tiles = gram.Tiles(ids[own] if one else ids, v[own] if one else v, own[own] if one else own, one)
            assert gram._to_order(tiles, 6) == fits
            if not fits:
                continue
            parts = list(gram._ordered(tiles, 6))
            i, j, cos = (np.concatenate([part[k] for part in parts]) for k in ("i", "j", "cos"))
            assert (np.diff(cos) < 0).sum() < len(cos) // 40 and (i < j).all()
            a, b = ids[own], ids[own if one else ~own]
            c = gram.rounded(v[a // 2] @ v[b // 2].T, 6)
            expected = {(min(x, y), max(x, y)): repr(float(c[m, n])) for m, x in enumerate(a) for n, y in enumerate(b) if not one or x < y}
            assert len(i) == len(expected) and {(x, y): repr(z) for x, y, z in zip(i.tolist(), j.tolist(), cos.tolist(), strict=True)} == expected
    assert not gram._to_order(gram.Tiles(ids, np.eye(len(v)), ids >= 0, True), 6)  # of few cosines, which a dictionary holds


def test_pairs_take_few_bytes(spark, monkeypatch, tmp_path):
    """A cosine is stored once for many pairs of a large group: in order of i and j, a pair took over 8 bytes."""
    from vectorloom.plans import catalogue

    monkeypatch.setattr(gram, "BLOCK", 5000)  # one block
    v = vectors(3000, 64)
    spark.createDataFrame([(i * 3, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    catalogue.gram_pairs(spark, str(tmp_path)).coalesce(1).write.parquet(f"{tmp_path}/pairs")
    rows = pq.read_table(f"{tmp_path}/pairs").to_pandas().sort_values(["i", "j"])
    i, j = np.triu_indices(3000, 1)
    assert (rows["i"].to_numpy() == 3 * i).all() and (rows["j"].to_numpy() == 3 * j).all()
    assert np.abs(rows["cos"].to_numpy() - (v @ v.T)[i, j]).max() <= 5.000001e-7
    assert sum(p.stat().st_size for p in (tmp_path / "pairs").glob("*.parquet")) < 6 * len(rows)


def test_rounding_is_that_of_sql(duck):
    x = [0.5, -0.5, 2.5, 0.0078125, -0.0078125, -1e-9, 1e-9, 0.1234564, -0.1234565, 3.0]
    own = duck.execute("select round(unnest(?::double[]), 6)", [x]).fetchall()
    assert list(map(repr, gram.rounded(np.array(x), 6).tolist())) == [repr(r[0]) for r in own]


def test_extremes_over_tiles(spark, small):
    v = vectors()
    c = v @ v.T
    np.fill_diagonal(c, -9)
    found = {r.id: r for r in gram.row_extremes(frame(spark, v), 0.3).collect()}
    assert len(found) == 60
    for i, row in enumerate(c):
        assert found[3 * i].max_cos == pytest.approx(row.max()) and found[3 * i].n_over == (row > 0.3).sum()
    assert gram.row_extremes(frame(spark, v[:1]), 0.3).count() == 0


def test_counts_of_keys_of_any_width(spark, small, monkeypatch):
    v = vectors()
    found = gram.millionths(frame(spark, v)).collect()
    assert {r.key: r.n for r in found} == Counter(round(c * 1e6) for c in products(v).values()) and len(found) == len({r.key for r in found})
    monkeypatch.setattr(gram, "WIDE", 50)
    keys = [np.array([1.0, 2.0, 2.0]), np.array([-40.0, 1.0]), np.array([]), np.array([30.0]), np.array([1e9, 3.0]), np.array([60.0, 61.0])]
    total = Counter()
    for part in gram.tallied(keys):
        for k, n in zip(part["key"].tolist(), part["n"].tolist(), strict=True):
            total[k] += n
    assert total == Counter(int(x) for k in keys for x in k)


def test_listed_pairs_by_smaller_id(spark, small):
    v, values = vectors(), [-1.0, -0.25, 0.0, 0.5]
    n, k = Counter(), Counter()
    for (i, _), c in products(v).items():
        n[i] += 1
        k[i] += min(abs(round(c, 6) - x) for x in values) <= 0.05
    found = {r.i: (r.n, r.k) for r in gram.listed_by_row(frame(spark, v), values, 0.05).collect()}
    assert found == {i: (n[i], k[i]) for i in n}
    assert {r.k for r in gram.listed_by_row(frame(spark, v), []).collect()} == {0}


@pytest.mark.parametrize("lengths", [1.0, 3.0, 1e5, np.nan])
def test_counts_in_arrays_are_those_of_rounded_products(small, lengths):
    """Also where lengths of vectors, or what is no number, let keys leave the range of an array."""
    v = np.concatenate([vectors(20), vectors(3), -vectors(3), [[0.5, 0, 0, 0, 0], [0.25, 0, 0, 0, 0]]])
    v[7] *= lengths
    ids, first = np.arange(len(v)) * 2, np.arange(len(v)) % 3 == 0
    for one in (False, True):
        own = first | one
        a, b = ids[own], ids[own if one else ~own]
        c = v[a // 2] @ v[b // 2].T
        c = c[a[:, None] < b[None, :]] if one else c.ravel()
        for scale, kind in ((1000, np.float64), (1000, np.float32), (1_000_000, np.float64)):
            total = Counter()
            for part in gram.counted(gram.Tiles(ids[own] if one else ids, v[own] if one else v, own[own] if one else own, one), scale, kind):
                total.update(dict(zip(part["key"].tolist(), part["n"].tolist(), strict=True)))
            with np.errstate(invalid="ignore"):
                assert total == Counter(np.rint(c.astype(kind) * kind(scale)).astype(np.int64).tolist())


def test_entries_are_those_of_the_column_rules(spark, small):
    keys = spark.range(-1_200_000, 1_200_001, 7).union(spark.range(-1_200_500, 1_200_501, 1000)).union(spark.range(460_000, 620_000))
    rows = keys.select("id", F.round(C.snapped_entry(F.col("id") / 1_000_000), 3).alias("entry")).toPandas()
    assert (rows["entry"].to_numpy() == C.snapped_thousandths(rows["id"].to_numpy()) / 1000).all()
    for scale in (1.0, 2000.0):
        v = vectors() * scale
        found = gram.entries(frame(spark, v)).collect()
        assert {r.key: r.n for r in found} == Counter(C.snapped_thousandths(np.array([round(c * 1e6) for c in products(v).values()])).tolist()) and len(found) == len({r.key for r in found})


def test_tasks_have_the_same_number_of_groups(spark, monkeypatch):
    monkeypatch.setattr(gram, "BLOCK", 5)
    monkeypatch.setattr(gram, "TASKS", 8, raising=False)

    def task(tiles):
        from pyspark import TaskContext

        yield {"i": np.array([TaskContext.get().partitionId()])}

    groups = gram.pair_cosines(frame(spark, vectors(60)), shrink=task, schema="i long")
    assert sorted(Counter(r.i for r in groups.collect()).values()) == [9, 9, 10, 10, 10, 10, 10, 10]  # 78 groups of 12 blocks
    copies = gram._dealt(gram.vectors_of(frame(spark, vectors(60)).coalesce(1), "vec_id", "embedding"), 12, "left", 12, True)
    assert copies.rdd.getNumPartitions() == 24


@pytest.mark.parametrize("shape", [(3, 16), (300, 8), (4, 4096), (5, 7)])
def test_ones_are_added(shape):
    marks = np.random.default_rng(1).integers(0, 2, shape).astype(np.uint8)
    for m in (marks, np.ones_like(marks)):
        assert [gram.ones(m, a).tolist() for a in (0, 1)] == [m.sum(axis=a, dtype=int).tolist() for a in (0, 1)]


def test_alphabet_counts_pairs_once(spark, monkeypatch, tmp_path):
    from vectorloom.plans import catalogue

    frame(spark, vectors(40)).filter("vec_id is not null and embedding is not null").write.parquet(f"{tmp_path}/embeddings.parquet")
    plan = catalogue.alphabet_discovery(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" not in plan  # the histogram is stored, both its readers read that


@pytest.mark.parametrize("single", [False, True])
def test_histogram_over_tiles(spark, small, single):
    v, kind = vectors(), np.float32 if single else np.float64
    found = {r.key: r.n for r in gram.histogram(frame(spark, v), single=single).collect()}
    assert found == Counter(int(np.rint(kind(c) * kind(1000))) for c in products(v).values())


def test_contacts_over_tiles(spark, small):
    v = vectors()
    own = frame(spark, v)
    found = {r.id: r for r in gram.contacts(own.filter("vec_id < 60"), own.filter("vec_id >= 60"), 0.2).collect()}
    c = v[:20] @ v[20:].T
    assert len(found) == 20
    for i, row in enumerate(c):
        assert found[3 * i].max_cos == pytest.approx(row.max()) and found[3 * i].overlap == pytest.approx((np.maximum(row - 0.2, 0) ** 2).sum())
    assert gram.contacts(own.filter("vec_id < 0"), own, 0.2).count() == 0

import numpy as np
import pytest

from vectorloom.operators import bounds, gram


def clustered(seed=1, clusters=12, each=40, d=8, spread=0.05):
    r = np.random.default_rng(seed)
    v = np.repeat(r.normal(size=(clusters, d)), each, axis=0) + spread * r.normal(size=(clusters * each, d))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def frame(spark, v, first=0):
    return spark.createDataFrame([(first + i, x.tolist()) for i, x in enumerate(v)] + [(None, None), (first + 9_000, None)], "vec_id long, embedding array<double>").repartition(5)


CASES = {
    "clusters": clustered(),
    "everywhere": clustered(spread=50.0, clusters=4, each=60),
    "ties": np.repeat(np.eye(8), 9, axis=0),
    "lengths": clustered() * np.linspace(0.0, 3.0, 480)[:, None],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_nearest_by_bounds_is_nearest(spark, monkeypatch, name):
    monkeypatch.setattr(gram, "BLOCK", 16)
    v = CASES[name]
    own = frame(spark, v)
    found, pairs = bounds.nearest(own)
    plain = {r.id: (r.neighbour, r.cos) for r in gram.nearest(own).collect()}
    got = {r.id: (r.neighbour, r.cos) for r in found.collect()}
    c = np.round(v @ v.T, 6)
    np.fill_diagonal(c, -9)
    assert got == {i: (int(row.argmax()), row.max()) for i, row in enumerate(c)}
    assert got == plain
    share = bounds.skipped(pairs).first()
    print(name, share)
    assert share.pairs > 20
    if name == "clusters":
        assert share.skipped > 0.5 * share.pairs


@pytest.mark.parametrize("name", sorted(CASES))
def test_contacts_by_bounds_are_contacts(spark, monkeypatch, name):
    monkeypatch.setattr(gram, "BLOCK", 16)
    v = CASES[name]
    left, right = v[::2], v[1::2]
    for least in (0.9, 0.25, -0.5):
        found, pairs = bounds.contacts_within(frame(spark, left), frame(spark, right, 20_000), least)
        most = (left @ right.T).max(axis=1)
        assert {r.id: pytest.approx(r.max_cos) for r in found.collect()} == {i: m for i, m in enumerate(most) if m >= least}
        share = bounds.skipped(pairs).first()
        if name == "clusters" and least == 0.9:
            assert share.skipped > 0.5 * share.pairs
        if least == -0.5 and name == "ties":
            assert share.skipped == 0


def test_nothing_to_bound(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    one = frame(spark, np.eye(3)[:1])
    assert bounds.nearest(none)[0].count() == bounds.nearest(one)[0].count() == 0
    assert bounds.contacts_within(one, none, 0.1)[0].count() == bounds.contacts_within(none, one, 0.1)[0].count() == 0


def test_a_vector_is_sent_to_ranges_and_not_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(gram, "BLOCK", 4)
    monkeypatch.setattr(gram, "PARTS", 3, raising=False)
    v, sent = CASES["everywhere"], []
    run = bounds.products
    monkeypatch.setattr(bounds, "products", lambda left, right, pairs, *rest: (sent.append(pairs.filter("kept" if "kept" in pairs.columns else "true")), run(left, right, pairs, *rest))[1])
    found, pairs = bounds.nearest(frame(spark, v))
    c = np.round(v @ v.T, 6)
    np.fill_diagonal(c, -9)
    assert {r.id: r.neighbour for r in found.collect()} == {i: int(row.argmax()) for i, row in enumerate(c)}
    blocks = {x for r in sent[0].collect() for x in (r.p, r.q)}
    assert len(blocks) >= 60 and len({x >> 32 for x in blocks}) <= 3

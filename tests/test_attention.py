import math

import numpy as np
from pyspark.sql import functions as F

from vectorloom.operators import attention, geometry

SHAPE = attention.Shape(bound=6, actions=4, width=8, heads=2, layers=2)
WEIGHTS = attention.fixed_weights(SHAPE)


def loop(tokens, m):
    """One board, one number after another."""
    w, s = {k: v.tolist() for k, v in WEIGHTS.items()}, SHAPE
    mul = lambda x, a: [sum(x[i] * a[i][j] for i in range(len(x))) for j in range(len(a[0]))]
    add = lambda *x: [sum(y) for y in zip(*x, strict=True)]

    def norm(x):
        mean = sum(x) / len(x)
        scale = math.sqrt(sum((y - mean) ** 2 for y in x) / len(x) + 1e-5)
        return [(y - mean) / scale for y in x]

    h = [*w["own"], *(add(mul(t, w["embed"]), w["embed_bias"][0]) for t in tokens[:m])]
    d = s.width // s.heads
    for k in range(s.layers):
        q, key, value = ([mul(x, w[f"{k}.{n}"]) for x in h] for n in ("query", "key", "value"))
        after = []
        for i, x in enumerate(h):
            joined = []
            for a in range(0, s.width, d):
                e = [math.exp(sum(q[i][a + c] * z[a + c] for c in range(d)) / math.sqrt(d)) for z in key]
                joined += [sum(e[j] * value[j][a + c] for j in range(len(h))) / sum(e) for c in range(d)]
            after.append(norm(add(x, mul(joined, w[f"{k}.out"]))))
        h = [norm(add(x, mul([max(0.0, y) for y in add(mul(x, w[f"{k}.up"]), w[f"{k}.up_bias"][0])], w[f"{k}.down"]), w[f"{k}.down_bias"][0])) for x in after]
    p = [math.exp(z) for z in mul(h[0], w["policy"])]
    return [z / sum(p) for z in p], max(0.0, mul(h[1], w["worth"])[0])


def test_evaluator_matches_a_loop_and_ignores_what_is_masked(spark):
    r = np.random.default_rng(0)
    states = geometry.root_states(spark.createDataFrame([(i, r.normal(size=10).tolist()) for i in range(6)], "vec_id long, embedding array<double>")).withColumn("is_dead", F.col("place") % 2 == 0)
    found = {(x.state, x.place): x for x in attention.evaluated(states, SHAPE, WEIGHTS, "state", "place", rows=7).collect()}
    rows = states.collect()
    assert len(found) == len(rows) == 60
    for s in rows:
        tokens = attention.boards([s.m], [s.gram], [s.partial], [s.is_dead], SHAPE.bound)
        pi, value = loop(tokens[0].tolist(), s.m)
        got = found[s.state, s.place]
        assert np.allclose(got.pi, pi, atol=1e-10) and abs(got.value - value) < 1e-10
        assert np.allclose(got.first, tokens[0, 0] @ WEIGHTS["embed"] + WEIGHTS["embed_bias"][0])
        other = tokens.copy()
        other[:, s.m :] = r.normal(size=other[:, s.m :].shape)
        for a, b in zip(attention.evaluate(WEIGHTS, SHAPE, other, [s.m]), attention.evaluate(WEIGHTS, SHAPE, tokens, [s.m]), strict=True):
            assert np.array_equal(a, b)
    assert len({round(x.value, 6) for x in found.values()}) > 5
    assert attention.evaluated(states.limit(0), SHAPE, WEIGHTS, "state").count() == 0


def test_only_what_is_asked_for_is_computed(spark, monkeypatch):
    states = geometry.root_states(spark.createDataFrame([(0, [0.3, -0.1, 0.7, 0.2, -0.9])], "vec_id long, embedding array<double>")).withColumn("is_dead", F.lit(False))
    whole = {r.place: r for r in attention.evaluated(states, SHAPE, WEIGHTS, "place").collect()}
    seen = []
    monkeypatch.setattr(attention, "attended", lambda w, k, h, masked, heads, f=attention.attended: (seen.append(h.shape[1]), f(w, k, h, masked, heads))[1])
    batch = states.toPandas()
    tasks = []
    monkeypatch.setattr(type(states), "mapInPandas", lambda self, run, schema: tasks.append((run, schema)))
    attention.evaluated(states, SHAPE, WEIGHTS, "place", give=("first",))
    attention.evaluated(states, SHAPE, WEIGHTS, "place", give=("pi", "value"))
    (first, kind), (rest, _) = tasks
    assert kind == "place int, first array<double>"
    found = {r.place: r.first for b in first([batch]) for r in b.itertuples()}
    assert not seen and all(np.allclose(found[k], r.first) for k, r in whole.items())
    assert all(np.allclose(r.pi, whole[r.place].pi) for b in rest([batch]) for r in b.itertuples())
    assert set(seen) == {2 + k for k in set(batch["m"])}

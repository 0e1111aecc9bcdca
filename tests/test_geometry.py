import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectorloom.functions import linear
from vectorloom.operators import geometry, gram, selfplay, simulate
from vectorloom.operators.ranks import drawn, placed

HALF = [-1.0, -0.5, 0.0, 0.5]


def roots(dim):
    out = set()
    for a, b in itertools.combinations(range(dim), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = [0.0] * dim
            v[a], v[b] = s / math.sqrt(2), t / math.sqrt(2)
            out.add(tuple(v))
    return sorted(out)


@pytest.mark.parametrize("dim, number", [(3, 12), (4, 24)])
def test_root_systems_touch_at_sixty_degrees(spark, dim, number):
    vectors = spark.createDataFrame([(i, list(v)) for i, v in enumerate(roots(dim))], "vec_id long, embedding array<double>")
    cos = [r.cos for r in gram.pair_cosines(vectors).collect()]
    assert len(cos) == number * (number - 1) // 2
    assert max(cos) == pytest.approx(0.5)


def test_hexagon(spark):
    vectors = spark.createDataFrame([(i, [math.cos(i * math.pi / 3), math.sin(i * math.pi / 3)]) for i in range(6)], "vec_id long, embedding array<double>")
    cos = sorted(round(r.cos, 6) for r in gram.pair_cosines(vectors).collect())
    assert cos == [-1.0] * 3 + [-0.5] * 6 + [0.5] * 6


def test_pairs_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(gram, "BLOCK", 7)
    r = np.random.default_rng(0)
    v = r.normal(size=(40, 5))
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(99, None)], "vec_id long, embedding array<double>")
    got = {(x.i, x.j): x.cos for x in gram.pair_cosines(vectors).collect()}
    assert set(got) == set(itertools.combinations(range(40), 2))
    assert all(got[i, j] == pytest.approx(v[i] @ v[j]) for i, j in got)
    cross = gram.cross_cosines(vectors.filter("vec_id < 15"), vectors.filter("vec_id >= 15")).collect()
    assert {(x.i, x.j) for x in cross} == {(i, j) for i in range(15) for j in range(15, 40)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert gram.pair_cosines(none).count() == 0
    assert gram.histogram(none).count() == 0
    assert gram.nearest(none).count() == 0


@pytest.mark.parametrize("row, fits", [((-0.5, 0.0), True), ((-0.5, -1.0), False), ((0.5, 0.5), True), ((-0.5, -0.5), True)])
def test_positive_definite_rule(row, fits):
    base = np.array([[1.0, -0.5], [-0.5, 1.0]])
    assert (geometry.finalised(base, np.array(row), 3, np.array(HALF)) is not None) == fits


def test_full_rank_rule_solves_and_lists():
    v = np.array(roots(3))
    basis = next(list(c) for c in itertools.combinations(range(12), 3) if np.linalg.det(v[list(c)] @ v[list(c)].T) > 0.4)
    grown = v[basis] @ v[basis].T
    for i in set(range(12)) - set(basis):
        row = geometry.finalised(grown, v[basis[:3]] @ v[i], 3, np.array(HALF))
        assert row is not None
        assert np.allclose(row, v[basis] @ v[i], atol=1e-6)
    assert geometry.finalised(grown, np.array([0.5, 0.5, -1.0]), 3, np.array(HALF)) is None


def test_packing_has_no_overlap(spark):
    rows = simulate.packed_spheres(spark, 3, rounds=2, most=12).collect()
    for number in (0, 1):
        v = np.array([r.v for r in rows if r.round == number])
        cos = v @ v.T - 2 * np.eye(len(v))
        assert cos.max() <= 0.5 + 1e-4 + 1e-9
        assert 2 < len(v) <= 12 + 9


def test_volume_basis_marks_one_winner(spark):
    rows = [(k, 10 * k + i, np.eye(3)[i % 3].tolist()) for k in range(2) for i in range(5)] + [(2, 50, [1.0, 0.0, 0.0])]
    found = geometry.volume_bases(spark.createDataFrame(rows, "round long, id long, v array<double>"), 3, 200).collect()
    assert sum(r.best for r in found) == 1
    assert {r.round: len(r.ids) for r in found} == {0: 3, 1: 3, 2: 1}
    assert max(r.log_volume for r in found if r.round < 2) == pytest.approx(0.0, abs=1e-5)


def test_selfplay_is_legal_and_repeatable(spark):
    args = {"dim": 3, "upper_bound": 8, "cosines": HALF, "workers": 2, "episodes": 2, "simulations": 12, "seed": 3}
    one, two = (sorted(selfplay.play(spark, **args).collect(), key=lambda r: (r["rank"], r.episode, r.step)) for _ in range(2))
    assert one == two
    for r in one:
        assert sum(r.pi) == pytest.approx(1.0)
        assert -1 <= r.reward <= 1
        g = np.array(r.gram).reshape(r.m, r.m)
        off = g[~np.eye(r.m, dtype=bool)]
        assert all(min(abs(c - x) for x in HALF) <= 2e-3 for c in off)
        assert np.linalg.eigvalsh(g).min() > -1e-5


def test_dead_states_stay():
    game = selfplay.Spheres(3, 8, HALF)
    state = game.after(game.after(game.after(game.start(), 0), 0), 0)
    while not state.is_dead:
        state = game.after(state, 3 if game.valid(state)[3] else 0)
    assert game.after(state, 1) is state
    assert not game.valid(state).any()


def test_volume_basis_draws_over_the_whole_round(spark):
    """Vectors are parallel within each of the two slices that ids were once dealt to, so a basis has to mix them."""
    spheres = spark.range(2001).selectExpr("0L as round", "id", "if(pmod(xxhash64(id), 2) = 0, array(1D, 0D), array(0D, 1D)) as v")
    best = geometry.volume_bases(spheres, 2, 50).collect()[0]
    assert best.log_volume == pytest.approx(0.0, abs=1e-5)


def root_state(v, place, dim):
    """A state of root vectors, one step after another."""
    n = len(v)

    def root(c):
        piece = [v[(c + k) % n] for k in range(dim)]
        top = sorted(range(dim), key=lambda k: (-abs(piece[k]), k))[:2]
        return np.array([(-1.0 if piece[k] < 0 else 1.0) if k in top else 0.0 for k in range(dim)])

    m = dim - 1 + place % 3
    spheres, w = [root(place + dim * j) for j in range(m)], root(place + dim * m)
    return m, [float(x @ y) / 2 for x in spheres for y in spheres], [float(x @ w) / 2 for x in spheres][: min(m, dim) - 1]


@pytest.mark.parametrize("dim", [3, 4])
def test_states_of_roots_and_their_legal_actions(spark, dim):
    r = np.random.default_rng(2)
    rows = [(i, 0, r.normal(size=k).tolist()) for i, k in enumerate([9, 17, 64, 5, 4])] + [(90, 1, None), (91, 1, [0.0] * 8), (92, 2, [1.0]), (92, 2, [])]
    states = geometry.root_states(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), dim)
    own = {(s.state, s.place): s for s in states.collect()}
    assert set(own) == {(i, p) for i, _, v in rows if v and len(v) >= dim for p in range(len(v))}
    for (i, p), s in own.items():
        assert (s.m, s.gram, s.partial) == root_state(dict((k, v) for k, _, v in rows)[i], p, dim)
    found = geometry.legal_actions(states, HALF, dim, bound=dim + 1).collect()
    assert len(found) == 4 * len(own)
    for f in found:
        s = own[f.state, f.place]
        plain = geometry.valid_actions(np.array(s.gram).reshape(s.m, s.m), s.partial, dim, np.array(HALF), False, dim + 1)
        assert bool(plain[f.action]) == f.valid, (f, s)
    assert {(own[f.state, f.place].m >= dim, f.valid) for f in found} == {(a, b) for a in (False, True) for b in (False, True)}


def test_elimination_matches_numpy(spark):
    r = np.random.default_rng(6)
    made = [r.normal(size=(n, n)) for n in (1, 2, 3, 5, 6) for _ in range(6)] + [np.ones((3, 3)), np.zeros((2, 2)), np.array([[0.0, 1.0], [1.0, 0.0]]), np.eye(4)]
    made += [a @ a.T for a in made[:30]] + [np.array([[1.0, 2.0], [2.0, 1.0]])]
    frame = spark.createDataFrame([(i, len(a), a.ravel().tolist()) for i, a in enumerate(made)], "i int, n int, flat array<double>").withColumn("rows", linear.rows_of(F.col("flat"), F.col("n")))
    n = F.col("n")
    out = frame.select("i", linear.inverse(F.col("rows"), n).alias("inverse"), linear.log_determinant(F.col("rows"), n).alias("volume"), linear.definite(F.col("rows"), n).alias("definite")).collect()
    for x in out:
        a = made[x.i]
        det = np.linalg.det(a)
        if abs(det) > 1e-9:
            assert np.allclose(x.inverse, np.linalg.inv(a), rtol=1e-6, atol=1e-8)
        else:
            assert x.inverse is None
        assert x.volume == pytest.approx(np.log(det), abs=1e-8) if det > 1e-9 else x.volume is None
        if np.allclose(a, a.T):
            assert x.definite == (np.linalg.eigvalsh(a).min() > 1e-12), x.i


def test_places_with_all_rows_in_one_key(spark):
    rows = [(0, i * 7 % 20_011) for i in range(20_000)] + [(k, -k) for k in range(1, 5)]
    frame = spark.createDataFrame(rows, "k int, o long").repartition(7)
    out = placed(frame, "k", "o").collect()
    assert len(out) == len(rows)
    assert [r.o for r in sorted(out, key=lambda r: r.place) if r.k == 0] == sorted(o for k, o in rows if k == 0)
    assert sorted(r.place for r in out if r.k == 0) == list(range(20_000))
    assert {r.place for r in out if r.k} == {0}
    assert placed(frame.limit(0), "k", "o").count() == 0


def test_draws_are_subsets(spark):
    n = F.lit(7).cast("long")
    out = [tuple(r.d) for r in spark.range(7000).select(drawn(n, 3, F.lit(5), F.col("id")).alias("d")).collect()]
    assert all(len(set(d)) == 3 and list(d) == sorted(d) and 0 <= d[0] and d[-1] < 7 for d in out)
    counts = Counter(out)
    assert len(counts) == 35 and max(counts.values()) < 1.4 * 200 and min(counts.values()) > 0.6 * 200
    assert [tuple(r.d) for r in spark.range(3).select(drawn(F.lit(3).cast("long"), 3, F.col("id")).alias("d")).collect()] == [(0, 1, 2)] * 3


def test_accepted_matches_a_greedy_loop(spark):
    r = np.random.default_rng(5)
    rows = [(k, i, v.tolist()) for k in range(3) for i, v in enumerate(r.normal(size=(400, 3)))] + [(7, 0, None)]
    offered = spark.createDataFrame(rows, "round long, turn int, v array<double>").repartition(5)
    found = {(x["round"], x.place): x.turn for x in simulate.accepted(offered, "turn", 0.3, 6).collect()}
    for k in range(3):
        own, taken = [np.array(v) for q, _, v in rows if q == k], []
        for i, v in enumerate(own):
            if len(taken) < 6 and all(own[j] @ v <= 0.3 for j in taken):
                taken.append(i)
        assert [found[k, p] for p in range(len(taken))] == taken
    assert {k for k, _ in found} == {0, 1, 2}
    assert simulate.accepted(offered.limit(0), "turn").count() == 0


def test_first_independent_over_many_partitions(spark):
    """One round of 100,000 rows in several tasks; small and empty ones beside it; choices that knock out others."""
    r = np.random.default_rng(9)
    crowd = r.normal(size=(100_000, 3))
    crowd /= np.linalg.norm(crowd, axis=1, keepdims=True)
    rows = [(0, i, v) for i, v in enumerate(crowd.tolist())] + [(1, i, [1.0, 0.0, 0.0]) for i in range(50)] + [(2, 5, None), (3, 8, [0.0, 1.0, 0.0]), (3, 9, None)]
    offered = spark.createDataFrame(rows, "round long, turn int, v array<double>").repartition(6)
    for touch, most in ((0.9, 60), (0.5, 10)):
        found = simulate.first_independent(offered, "turn", touch, most).collect()
        taken = []
        for i, v in enumerate(crowd):
            if len(taken) < most and (not taken or (crowd[taken] @ v <= touch).all()):
                taken.append(i)
        own = {(f["round"], f.place): f.turn for f in found}
        assert [own.get((0, p)) for p in range(len(taken))] == taken
        assert {k: v for k, v in own.items() if k[0]} == {(1, 0): 0, (3, 0): 8}
        assert len(found) == len(own) == len(taken) + 2
    assert simulate.first_independent(offered.limit(0), "turn").count() == 0


def test_packing_is_repeatable_and_ends(spark):
    one, two = (sorted((r["round"], r.sphere_id, tuple(r.v)) for r in simulate.packed_spheres(spark, 2, rounds=2, number=64, steps=80).collect()) for _ in range(2))
    assert one == two
    sizes = simulate.round_sizes(spark.createDataFrame([(k, i) for k, i, _ in one], "round long, i long")).collect()
    assert all(2 <= r.n <= 6 for r in sizes)
    assert {r.total for r in sizes} == {len(one)}


def test_micro_steps_are_the_moves_of_the_game(spark):
    """Every state of the first games, below and at full rank, against the game's own move; dead states stay."""
    game = selfplay.Spheres(3, 8, HALF)
    states, now = [], [game.start()]
    for _ in range(9):
        now = [game.after(s, a) for s in [s for s in now if not s.is_dead][::3][-40:] for a in range(4)]
        states += now
    own = spark.createDataFrame([(i, s.is_dead, s.m, s.gram.ravel().tolist(), list(s.partial)) for i, s in enumerate(states)], "id long, is_dead boolean, m int, gram array<double>, partial array<double>")
    found = geometry.micro_steps(own, HALF).collect()
    assert len(found) == 4 * len(states)
    assert any(s.is_dead for s in states)
    assert max(r.m for r in found) >= 4
    for r in found:
        after = game.after(states[r.id], r.action)
        assert (r.is_dead, r.m, r.partial) == (after.is_dead, after.m, list(after.partial))
        assert r.gram == pytest.approx(after.gram.ravel().tolist())
    seeded = geometry.start_states(spark, [[1.0, 0.5], [0.5, 1.0]]).first()
    assert (seeded.m, seeded.gram, seeded.partial, seeded.is_dead) == (2, [1.0, 0.5, 0.5, 1.0], [], False)

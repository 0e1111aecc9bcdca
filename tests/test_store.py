import numpy as np
import pytest
from pyspark.sql import functions as F

from vectorloom.operators import episodes, learn, selfplay
from vectorloom.sources import tables

HALF = [-1.0, -0.5, 0.0, 0.5]


def test_missing_store_is_a_typed_error(spark, tmp_path):
    with pytest.raises(tables.MissingStore):
        tables.read_replay(spark, str(tmp_path / "none"), 3, 1)
    with pytest.raises(tables.MissingStore):
        tables.load_model(spark, str(tmp_path / "none"), "best")


def test_model_round_trip(spark, tmp_path):
    path = str(tmp_path / "models")
    tables.save_model(spark, path, 1, "best", {"value": [1.0]})
    tables.save_model(spark, path, 2, "best", {"value": [2.0, 3.0]})
    assert tables.load_model(spark, path, "best") == {"value": [2.0, 3.0]}
    with pytest.raises(tables.MissingStore):
        tables.load_model(spark, path, "temp")


def test_training_loop_writes_and_retains(spark, tmp_path):
    path = str(tmp_path)

    def fit(window):
        return learn.evaluator(learn.fit(window, 4, epochs=2)[0])

    game = {"dim": 3, "upper_bound": 6, "cosines": HALF, "workers": 2, "episodes": 1, "simulations": 8, "seed": 1}
    selfplay.training_loop(spark, path, 3, 2, fit, **game)
    assert {r.iter for r in tables.read_replay(spark, f"{path}/replay", 2, 3).select("iter").distinct().collect()} == {2, 3}
    assert spark.read.parquet(f"{path}/metrics").count() == 3


def test_fit_lowers_the_loss_and_predicts(spark):
    played = selfplay.play(spark, dim=3, upper_bound=8, cosines=HALF, workers=2, episodes=2, simulations=12, seed=2)
    weights, history = learn.fit(played, 4, epochs=6)
    assert history[-1][1] <= history[0][1]
    rows = learn.predictions(played, weights, "rank", "step").collect()
    assert all(sum(r.pi) == pytest.approx(1.0) for r in rows)
    empty, none = learn.fit(played.limit(0), 4)
    assert not none
    assert not np.any(empty["policy"])


def test_barrier_fit_takes_the_steps_of_a_plain_loop(spark):
    """All tasks together against one loop over the same minibatches, whatever their number; one of them gets no rows."""
    r = np.random.default_rng(4)
    rows = [(i, r.normal(size=3).tolist(), r.dirichlet(np.ones(2)).tolist(), float(r.normal())) for i in range(300)]
    own = spark.createDataFrame(rows, "id long, x array<double>, pi array<double>, reward double")
    drawn, steps = learn.minibatches(own, 64, 3, 9)
    batches = {}
    for b in drawn.collect():
        batches.setdefault((b.epoch, b.step), []).append(b)
    weights, m, v, t, history = np.zeros(9), np.zeros(9), np.zeros(9), 0, []
    for e in range(3):
        lost = np.zeros(3)
        for s in range(steps):
            b = batches[e, s]
            total = learn.slopes(learn.heads(weights, 3, 2), np.array([x.x for x in b]), np.array([x.pi for x in b]), np.array([x.reward for x in b]))
            slope, t, lost = total[:9] / total[-1], t + 1, lost + total[9:]
            first = slope if t == 1 else first
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
            weights = weights - 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        history.append((e, lost[0] / lost[2], lost[1] / lost[2]))
    for workers in (1, 4):
        found = learn.fit_vectors(own, 3, 2, 3, 0.01, 64, 9, workers)
        assert np.allclose(np.concatenate([found.weights["policy"].ravel(), found.weights["value"]]), weights, atol=1e-10)
        assert np.allclose(found.history, history) and np.allclose(found.gradient, first)
    few = learn.fit_vectors(own.limit(2), 3, 2, 2, workers=4)
    assert len(few.history) <= 2 and np.isfinite(few.weights["policy"]).all()
    assert not np.any(learn.fit_vectors(own.limit(0), 3, 2).weights["policy"])


def test_minibatches_are_drawn_with_replacement(spark):
    drawn, steps = learn.minibatches(spark.range(2000), 256, 3, 5)
    assert steps == 2000 // 256
    rows = drawn.collect()
    sizes = [sum(r.epoch == e and r.step == s for r in rows) for e in range(3) for s in range(steps)]
    assert sum(sizes) == len(rows)
    assert all(170 < n < 350 for n in sizes)
    assert max(sum(r.id == i for r in rows if r.epoch == 0) for i in range(50)) >= 2
    assert learn.minibatches(spark.range(0), 256, 3, 5)[1] == 0
    assert sorted(r.id for r in learn.shuffled(spark.range(50), 1).collect()) == list(range(50))
    assert [r.id for r in learn.shuffled(spark.range(50), 1).collect()] != list(range(50))


def test_progress_and_symmetries(spark):
    gram = [float(i) for i in range(144)]
    results = spark.createDataFrame([(0, 0, 3, gram[:9]), (1, 0, 12, gram)], "rank int, episode int, best_m int, gram array<double>")
    best = episodes.progress(results).first()
    assert (best.best_m, len(best.block), best.block[1]) == (12, 10, gram[12:22])
    assert episodes.progress(results.filter("rank = 0")).first().block == [gram[:3], gram[3:6], gram[6:9]]
    assert episodes.symmetries(results).collect() == results.collect()
    assert episodes.symmetries(results, F.reverse("gram")).count() == 4


def test_minibatches_are_cut_without_a_table_each(monkeypatch):
    import pandas as pd

    rows = pd.DataFrame({"epoch": [0, 0, 0, 0, 1, 1], "step": [0, 0, 2, 2, 2, 3], "x": [[float(i), 1.0] for i in range(6)], "pi": [[float(i)] for i in range(6)], "reward": np.arange(6.0)})
    monkeypatch.setattr(pd.DataFrame, "groupby", None)
    monkeypatch.setattr(pd, "concat", None)
    found = list(learn.by_step([rows.iloc[:3], rows.iloc[:0], rows.iloc[3:5], rows.iloc[5:]]))
    assert [(k, z.tolist()) for k, _, _, z in found] == [((0, 0), [0.0, 1.0]), ((0, 2), [2.0, 3.0]), ((1, 2), [4.0]), ((1, 3), [5.0])]
    assert found[1][1].tolist() == [[2.0, 1.0], [3.0, 1.0]] and found[1][2].tolist() == [[2.0], [3.0]]

"""Canonical states, near entries of an alphabet, and metrics as a stream."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from vectorloom.operators import canonical, geometry, listed
from vectorloom.sources import tables
from vectorloom.streaming import metrics


def permuted(gram, given, p):
    p = list(p)
    return tuple(gram[p][:, p].ravel()), tuple(given[p])


def least_form(m, gram, partial):
    """The least form over all permutations, one by one."""
    given = np.full(m, 9.0)
    given[: len(partial)] = partial
    return min(permuted(np.round(gram.reshape(m, m), 4), np.round(given, 4), p) for p in itertools.permutations(range(m)))


def test_canonical_forms_are_classes_under_permutation():
    r = np.random.default_rng(7)
    states = []
    for m in (1, 2, 3, 4, 5):
        for _ in range(25):
            v = np.sign(r.normal(size=(m, 4))) * (r.random((m, 4)) < 0.6)
            gram, partial = v @ v.T / 2, r.choice([-0.5, 0.0, 0.5], size=int(r.integers(0, m)))
            states.append((m, gram, partial))
            p = r.permutation(m)
            if not len(partial):
                states.append((m, gram[p][:, p], partial))
    states += [(6, np.eye(6), []), (6, np.ones((6, 6)), []), (4, np.array([[1, 0.5, 0, 0.5], [0.5, 1, 0.5, 0], [0, 0.5, 1, 0.5], [0.5, 0, 0.5, 1]]), [])]
    forms, keys = [least_form(*s) for s in states], [canonical.canonical(*s)[0] for s in states]
    assert len(set(forms)) > 40
    assert {(a, b) for a, b in zip(forms, keys, strict=True)} == {(a, keys[forms.index(a)]) for a in forms}
    assert len(set(keys)) == len(set(forms))
    big = np.eye(30)
    assert canonical.canonical(30, big, [])[1]  # twins are not tried again and again


def test_states_are_merged(spark):
    r = np.random.default_rng(1)
    own = geometry.root_states(spark.createDataFrame([(i, r.normal(size=24).tolist()) for i in range(12)], "vec_id long, embedding array<double>"))
    rows = own.collect()
    classes = {}
    for s in rows:
        classes.setdefault((s.m, least_form(s.m, np.array(s.gram), s.partial)), []).append((s.state, s.place))
    found = canonical.merged(own, F.col("state"), F.col("place")).collect()
    assert sorted((f.n, f.first.state, f.first.place) for f in found) == sorted((len(v), *min(v)) for v in classes.values())
    assert canonical.merged(own.limit(0), F.col("state")).count() == 0


def test_listed_matches_brute_force(spark):
    r = np.random.default_rng(3)
    entries = [*r.normal(size=300).round(3).tolist(), 0.5, 0.5, None]
    values = [*r.normal(size=500).tolist(), *(e + d for e in entries[:40] for d in (0.002, -0.002, 0.0019999, 0.0020001, 0.0)), None, 1e9]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double")
    alphabet = spark.createDataFrame([(a,) for a in entries], "a double")
    for within in (0.002, 0.1):
        found = {row.i: row.listed for row in listed.listed(frame, alphabet, within).collect()}
        plain = {i: x is not None and any(a is not None and abs(x - a) <= within for a in entries) for i, x in enumerate(values)}
        edge = {i for i, x in enumerate(values) if x is not None and any(a is not None and abs(abs(x - a) - within) < 1e-12 for a in entries)}
        assert {i for i in found if found[i] != plain[i]} <= edge
        assert len(found) == len(values)
    assert listed.listed(frame, alphabet.limit(0), 0.1).filter("listed").count() == 0


def test_metrics_of_a_stream_are_those_of_the_batch(spark, tmp_path):
    rows = spark.range(600).select((F.col("id") % 5).cast("int").alias("iter"), (F.col("id") * 7 % 101).cast("double").alias("m"))
    folder, path, seen = str(tmp_path / "in"), str(tmp_path / "out"), []
    listener = metrics.Progress(lambda *x: seen.append(x))
    spark.streams.addListener(listener)
    try:
        for part in range(3):
            rows.filter(F.col("m") % 3 == part).coalesce(1).write.mode("append").parquet(folder)
            metrics.follow_metrics(spark.readStream.schema("iter int, m double").parquet(folder), path, str(tmp_path / "check")).awaitTermination()
    finally:
        spark.streams.removeListener(listener)
    each = rows.groupBy("iter").agg(F.max("m").alias("best"), F.avg("m").alias("mean"), F.count("*").cast("double").alias("steps"))
    want = {(r["iter"], name): round(r[name], 9) for r in each.collect() for name in ("best", "mean", "steps")}
    read = lambda: {(r["iter"], r.name): round(r.value, 9) for r in metrics.read_metrics(spark, path).collect()}
    assert read() == want
    assert {f.batch for f in tables.read_store(spark, path).select("batch").distinct().collect()} == {0, 1, 2}
    metrics.batch_writer(path)(rows.filter(F.col("m") % 3 == 1), 1)  # a batch that comes again adds nothing
    assert read() == want
    assert sum(n for _, n, _ in seen) == 600

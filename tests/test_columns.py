import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vectorloom.functions import columns as C


@pytest.mark.parametrize(
    "value, expected",
    [(-1.0, -1.0), (-0.98, -1.0), (-0.866, -math.sqrt(3) / 2), (-0.73, -math.sqrt(0.5)), (-0.68, -math.sqrt(0.5)), (-0.5, -0.5), (-0.26, -0.25), (0.1, None), (0.24, 0.25), (0.31, 1 / 3), (0.54, None), (0.0, 0.0), (0.49, 0.5)],
)
def test_snap_table(spark, value, expected):
    got = spark.range(1).select(C.snapped(F.lit(value)).alias("x")).first().x
    assert got == expected if expected is None else got == pytest.approx(expected, abs=1e-15)


def test_histogram_keys_round_half_to_even(spark):
    rows = spark.createDataFrame([(0.0005,), (0.0015,), (0.0025,), (None,)], "c double").select(C.histogram_key(F.col("c")).alias("k"), C.histogram_key_single(F.col("c")).alias("s")).collect()
    assert [r.k for r in rows] == [0, 2, 2, None]
    assert rows[3].s is None


def test_reward_ends(spark):
    rows = spark.createDataFrame([(0.0,), (37.5,), (75.0,), (1000.0,)], "r double").select(C.reward(F.col("r"), 0.0, 75.0).alias("x")).collect()
    assert [round(r.x, 5) for r in rows] == [-1.0, 0.0, 1.0, 1.0]


def test_masked_prior_sums_to_one(spark):
    frame = spark.createDataFrame([([0.5, 0.5], [True, False]), ([0.0, 1.0], [True, False]), ([0.2, 0.8], [False, False])], "p array<double>, v array<boolean>")
    got = [r.x for r in frame.select(C.masked_prior(F.col("p"), F.col("v")).alias("x")).collect()]
    assert got == [[1.0, 0.0], [1.0, 0.0], [None, None]]


def test_zero_vector_has_no_direction(spark):
    frame = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    got = [r.x for r in frame.select(C.normalised(F.col("v")).alias("x")).collect()]
    assert got == [[None, None], [0.6, 0.8]]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-5, 5), min_size=1, max_size=6))
def test_softmax_is_a_distribution(spark, values):
    got = spark.createDataFrame([(values,)], "x array<double>").select(C.softmax(F.col("x")).alias("p")).first().p
    assert sum(got) == pytest.approx(1.0)
    assert all(p > 0 for p in got)


def test_keys_placement_and_split(spark):
    rows = spark.createDataFrame([([1, 2],), ([12],), ([1, 2],)], "a array<int>").select(C.state_key(F.col("a")).alias("k")).collect()
    assert rows[0].k == rows[2].k != rows[1].k
    assert C.batch_size(100, 64) == 1
    assert C.batch_size(10, 64) == 1
    assert spark.range(1).select(C.placement(F.lit(9), 4).alias("d")).first().d == 1


def test_rounding_keeps_the_sign_of_zero(spark, duck, tmp_path):
    from vectorloom.plans import catalogue

    x = [-1e-9, 1e-9, -0.0, -0.0078125, 0.0078125, 0.25, -4.9e-7, -5.1e-7]
    spark.createDataFrame([(1, x * 2, 3)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = catalogue.board_tokens(spark, str(tmp_path)).first().token
    duck.execute(f"create temp view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    own = duck.execute(catalogue.ORACLES["board_tokens"]).fetchall()[0][2]
    duck.execute("drop view temp.embeddings")
    assert list(map(repr, found)) == list(map(repr, own))

import pytest
from pyspark.errors import AnalysisException

from vectorloom.functions import tables
from vectorloom.operators import geometry
from vectorloom.sources.tables import table

DATA = "/root/testdata/sf0.001"
CALL = "select s.{keys}, x.* from {view} s, lateral legal_actions(s.m, s.gram, s.partial, array({cosines}), {dim}) x"
HALF = "-1.0D, -0.5D, 0.0D, 0.5D"


@pytest.mark.parametrize("make, dim", [(geometry.root_states, 3), (geometry.root_states, 4)])
def test_table_function_equals_expressions(spark, make, dim):
    tables.register(spark)
    states = make(table(spark, DATA, "embeddings").limit(20), dim).cache()
    states.createOrReplaceTempView("states_of_roots")
    got = spark.sql(CALL.format(keys="state, s.place", view="states_of_roots", cosines=HALF, dim=dim))
    want = geometry.legal_actions(states, [-1.0, -0.5, 0.0, 0.5], dim).select(got.columns)
    rows = lambda f: sorted(map(tuple, f.collect()))
    found = rows(got)
    assert found == rows(want)
    assert len({r.valid for r in got.collect()}) == 2
    states.unpersist()


def test_odd_states_have_no_actions(spark):
    tables.register(spark)
    nan = float("nan")
    odd = [(0, None, [1.0], []), (1, 1, None, []), (2, 1, [1.0], None), (3, 2, [1.0], [0.0]), (4, 0, [], []), (5, 1, [nan], []), (6, 1, [1.0], [0.0, 0.0]), (7, 2, [1.0, None, 0.0, 1.0], [0.0])]
    rows = [*odd, (8, 1, [1.0], []), (8, 1, [1.0], [])]
    spark.createDataFrame(rows, "state int, m int, gram array<double>, partial array<double>").createOrReplaceTempView("odd_states")
    got = spark.sql(CALL.format(keys="state", view="odd_states", cosines=HALF, dim=3)).collect()
    assert sorted((r.state, r.action) for r in got) == sorted([(8, a) for a in range(4)] * 2)
    spark.sql("select * from odd_states where false").createOrReplaceTempView("no_states")
    assert spark.sql(CALL.format(keys="state", view="no_states", cosines=HALF, dim=3)).count() == 0


def test_full_states_have_no_legal_action():
    import numpy as np

    half = np.array([-1.0, -0.5, 0.0, 0.5])
    assert tables.legality(np.eye(3), [0.0, 0.0], half, 3, 3).tolist() == [False] * 4
    assert tables.legality(np.eye(3), [0.0], half, 3, 75).tolist() == [True] * 4
    assert tables.legality(np.ones((3, 3)), [0.5, 0.5], half, 3, 75).tolist() == [False] * 4


@pytest.mark.parametrize("cosines, dim", [(HALF, 0), ("null", 3), (HALF, "s.m"), ("s.partial[0]", 3)])
def test_arguments_are_checked_when_a_query_is_analysed(spark, cosines, dim):
    tables.register(spark)
    spark.createDataFrame([(1, 1, [1.0], [0.0])], "state int, m int, gram array<double>, partial array<double>").createOrReplaceTempView("one_state")
    with pytest.raises(AnalysisException):
        spark.sql(CALL.format(keys="state", view="one_state", cosines=cosines, dim=dim)).collect()

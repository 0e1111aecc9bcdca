import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from vectorloom.streaming import state

KIND = "s long, a int, v double, sim long, ts timestamp"
START = datetime.datetime(2024, 1, 1)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def running(rows):
    """By a loop: the rows of follow_running, in order of time and sim."""
    edges, best, out = {}, {}, []
    for s, a, v, sim, ts in sorted((r for r in rows if r[0] is not None and r[4] is not None), key=lambda r: (r[4], r[3] is not None, r[3] or 0)):
        seen = edges.setdefault((s, a), [])
        seen.append(v)
        values = [x for x in seen if x is not None]
        best[s] = max([best.get(s, 1.0)] + ([v] if v is not None else []))
        out.append((s, sim, a, len(seen), round(sum(values) / len(values), 9) if values else None, best[s]))
    return sorted(map(repr, out))


def found(frame):
    return sorted(repr((r.s, r.sim, r.a, r.n, None if r.q is None else round(r.q, 9), r.best)) for r in frame.collect())


def fed(spark, folder, batches, **options):
    """Each batch is a file that a run of its own reads, from where the one before ended."""
    for rows in batches:
        spark.createDataFrame(rows, KIND).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(KIND).parquet(f"{folder}/in")
        query = state.follow_running(stream, f"{folder}/out", f"{folder}/checkpoint", **options)
        query.awaitTermination()
    return state.all_running(spark, f"{folder}/out", f"{folder}/checkpoint")


def examples(n):
    draw = random.Random(5)
    return [(0 if i % 3 == 0 else draw.randrange(6), draw.randrange(3), draw.random() * 5, i, at(i)) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 3])
def test_equals_the_batch_order_after_any_split(spark, tmp_path, parts):
    rows = examples(120)
    batches = [rows[i * len(rows) // parts : (i + 1) * len(rows) // parts] for i in range(parts)]
    # neighbours change places over the borders of files, by less than the watermark waits
    for x, y in zip(batches, batches[1:], strict=False):
        x[-3:], y[:3] = y[:3], x[-3:]
    for b in batches:
        random.Random(1).shuffle(b)
    out = fed(spark, tmp_path, batches, late="10 minutes", slice_ms=600_000)
    assert found(out) == running(rows)
    written = spark.read.parquet(f"{tmp_path}/out").count()
    assert 0 < written < len(rows)


class Held(dict):
    """State of one key without Spark, with the number of calls to it."""

    calls = 0

    def updateValue(self, k, v):
        self.calls += 1
        self[k] = v

    def getValue(self, k):
        self.calls += 1
        return self[k]

    def removeKey(self, k):
        self.calls += 1
        del self[k]


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


@pytest.mark.parametrize("small", [2, 4096])
def test_few_rows_of_many_slices_are_one_part(monkeypatch, small):
    monkeypatch.setattr(state, "SMALL", small, raising=False)
    one, timers = state.Running(60_000), []
    one.held, one.parts, one.sums = Held(), Value(), Value()
    one.handle = type("Handle", (), {"registerTimer": lambda self, t: timers.append(t)})()
    rows = [(1, 0, 1.5 * i % 4, i, at(i)) for i in range(20)]
    micros = lambda t: int((t - datetime.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    table = pd.DataFrame([(micros(t), sim, a, v) for _, a, v, sim, t in rows[::-1]], columns=["at", "sim", "a", "v"])
    list(one.handleInputRows((1,), iter([table.iloc[:12], table.iloc[12:]]), None))
    out = []
    for upto in (10, 15):
        mark = type("Times", (), {"getCurrentWatermarkInMs": lambda self, m=upto: micros(at(m)) // 1000})()
        out += [r for part in one.handleExpiredTimer((1,), mark, None) for r in part.itertuples()]
        assert timers[-1] == micros(at(upto + 1)) // 1000
    assert [r.sim for r in out] == list(range(15)) and sorted(x for p in one.held.values() for x in p[1]) == list(range(15, 20))
    assert sorted(repr((int(r.s), int(r.sim), int(r.a), int(r.n), round(float(r.q), 9), float(r.best))) for r in out) == running(rows[:15])
    assert small == 2 or one.held.calls <= 12


def test_late_rows_are_left_out_and_odd_ones_defined(spark, tmp_path):
    first = [(1, 0, 2.0, 1, at(0)), (1, 0, None, 2, at(1)), (1, None, 4.0, 3, at(2)), (None, 0, 9.0, 4, at(3)), (1, 0, 9.0, 5, None), (2, 1, None, None, at(4)), (2, 1, None, None, at(4)), (1, 0, 3.0, 6, at(60))]
    second = [(1, 0, 9.0, 7, at(20)), (1, 0, 5.0, 8, at(55)), (1, 0, 0.5, 9, at(61))]
    out = fed(spark, tmp_path, [first, second], late="10 minutes", slice_ms=60_000)
    assert found(out) == running(first + second[1:])


def test_empty_stream(spark, tmp_path):
    out = fed(spark, tmp_path, [[(1, 0, 2.0, 1, at(0))]], slice_ms=60_000)
    assert found(out.filter(F.col("s") > 1)) == []
    assert found(out) == running([(1, 0, 2.0, 1, at(0))])

"""Running statistics of edges in event time, as state of a stream: variables, timers, and what is held at the end."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from vectorloom.sources.tables import read_store

OUT = "s long, sim long, a int, n long, q double, best double"
HELD = "at array<long>, sim array<long>, a array<int>, v array<double>"
SUMS = "a array<int>, n array<long>, number array<long>, total array<double>, best double"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


#: Rows of a batch and key that are held in one part, whatever slices they fall in; output rows that are sent at once.
SMALL, SENT = 4096, 10_000


def _whole(column: pd.Series) -> list:
    none = column.isna()
    return [None if n else int(x) for x, n in zip(column.tolist(), none.tolist(), strict=True)] if none.any() else column.astype("int64").tolist()


class Running(StatefulProcessor):
    """Holds rows until the watermark has passed them, then puts them in order and gives each its running values.

    State of a key: held, its rows in parts by the first slice of event time that they fall in, parts, how many there were so far, and
    sums, its edges' counts and totals. A call to the state costs more than many rows, so the few rows of a batch are one part, and
    more are one part a slice. One timer a key fires at the end of its first slice, so a key loads one
    slice at a time and what few rows lie beside it; new rows are parts of their own, and those before are not read again.
    """

    def __init__(self, slice_ms: int):
        self.slice = slice_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "slice long, part long", HELD)
        self.parts = handle.getValueState("parts", "n long")
        self.sums = handle.getValueState("sums", SUMS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, known = None, self.parts.get()
        parts = known[0] if known else 0
        for batch in rows:
            if not len(batch):
                continue
            numbers = batch["at"] // 1000 // self.slice
            for number, part in [(numbers.min(), batch)] if len(batch) <= SMALL else batch.groupby(numbers):
                values = part["v"].astype(object).where(part["v"].notna(), None).tolist()
                self.held.updateValue((int(number), parts), (_whole(part["at"]), _whole(part["sim"]), _whole(part["a"]), values))
                parts += 1
                first = int(number) if first is None else min(first, int(number))
        if first is not None:
            self.parts.update((parts,))
            self.handle.registerTimer((first + 1) * self.slice)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        slices: dict[int, list[tuple]] = {}
        for k in self.held.keys():
            slices.setdefault(k[0], []).append(tuple(k))
        passed = timerValues.getCurrentWatermarkInMs() // self.slice
        later = [k for k in slices if k >= passed]
        if len(later) < len(slices):
            sums = self.sums.get() or ([], [], [], [], 1.0)
            edges, best = {a: [n, k, t] for a, n, k, t in zip(*sums[:4], strict=True)}, sums[4]
            loaded: dict[int, list[tuple]] = {}
            out = []
            while open_ := [k for k in (*slices, *loaded) if k < passed]:
                number = min(open_)
                for part in slices.pop(number, ()):
                    rest = []
                    for row in zip(*self.held.getValue(part), strict=True):
                        own = row[0] // 1000 // self.slice
                        (loaded.setdefault(own, []) if own < passed else rest).append(row)
                    self.held.removeKey(part)
                    if rest:  # goes back under the slice it begins in; a part's number is not given again
                        later.append(min(r[0] for r in rest) // 1000 // self.slice)
                        self.held.updateValue((later[-1], part[1]), tuple(map(list, zip(*rest, strict=True))))
                for _, j, b, x in sorted(loaded.pop(number, ()), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
                    edge = edges.setdefault(b, [0, 0, 0.0])
                    edge[0] += 1
                    if x is not None:
                        edge[1:], best = [edge[1] + 1, edge[2] + x], max(best, x)
                    out.append((key[0], j, b, edge[0], edge[2] / edge[1] if edge[1] else None, best))
                    if len(out) == SENT:
                        yield self._sent(out)
                        out = []
            if out:
                yield self._sent(out)
            self.sums.update((list(edges), *([e[i] for e in edges.values()] for i in range(3)), best))
        if later:
            self.handle.registerTimer((min(later) + 1) * self.slice)

    @staticmethod
    def _sent(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["s", "sim", "a", "n", "q", "best"]).astype({"sim": "Int64", "a": "Int32", "q": "float64"})

    def close(self) -> None:
        pass


def follow_running(stream: DataFrame, path: str, checkpoint: str, late: str = "10 minutes", slice_ms: int = 86_400_000) -> StreamingQuery:
    """Writes s, sim, a, n, q, best for each row (s, a, v, sim, ts) of a stream that the watermark has passed, to path.

    n and q are the count of the edge (s, a) and the mean of its values so far, best the greatest value of s so far, from 1 on; rows are in
    order of ts, then sim (nulls first). A null v counts in n only. Rows without s or ts are left out, and so are
    late ones: not newer than the watermark when their batch begins. However a stream is split into files, the result
    is the same as long as no row is late. What is still held is in `still_held`; a slice of a key is loaded at once.
    """
    session = stream.sparkSession
    timed = stream.filter("s is not null and ts is not null").select(F.col("s").cast("long").alias("s"), F.col("sim").cast("long").alias("sim"), F.col("a").cast("int").alias("a"), F.col("v").cast("double").alias("v"), F.col("ts").cast("timestamp").alias("ts"))
    # the time as a number, which no session's zone changes
    timed = timed.withColumn("at", F.unix_micros("ts"))
    out = timed.withWatermark("ts", late).groupBy("s").transformWithStateInPandas(Running(slice_ms), OUT, "append", "eventTime")
    # a query takes the provider that is set when it starts; other streams of the session keep theirs
    before = session.conf.get(PROVIDER)
    session.conf.set(PROVIDER, ROCKS)
    try:
        return out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        session.conf.set(PROVIDER, before)


def still_held(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The columns of `follow_running` for the rows that its state holds at the end, from the state itself."""
    state = spark.read.format("statestore").option("path", checkpoint)
    held = state.option("stateVarName", "held").load().select(F.col("key.s").alias("s"), F.col("user_map_value").alias("x"))
    rows = held.select("s", F.explode(F.arrays_zip("x.at", "x.sim", "x.a", "x.v")).alias("r")).select("s", "r.*")
    sums = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "sums").load().select(F.col("key.s").alias("s"), "value.*")
    edges = sums.select("s", F.explode(F.arrays_zip("a", "n", "number", "total")).alias("r")).select("s", F.col("r.a").alias("b"), F.col("r.n").alias("n0"), F.col("r.number").alias("k0"), F.col("r.total").alias("t0"))
    own = rows.join(sums.select("s", F.col("best").alias("best0")), "s", "left").alias("x").join(edges.alias("e"), F.expr("x.s = e.s and x.a <=> e.b"), "left").select("x.*", "n0", "k0", "t0")
    edge, key = (W.partitionBy(*c).orderBy("at", "sim").rowsBetween(W.unboundedPreceding, W.currentRow) for c in (("s", "a"), ("s",)))
    none = F.lit(0).cast("long")
    mean = F.try_divide(F.coalesce("t0", F.lit(0.0)) + F.coalesce(F.sum("v").over(edge), F.lit(0.0)), F.coalesce("k0", none) + F.count("v").over(edge))
    best = F.greatest(F.coalesce("best0", F.lit(1.0)), F.max("v").over(key))
    return own.select("s", "sim", "a", (F.coalesce("n0", none) + F.count("*").over(edge)).alias("n"), mean.alias("q"), best.alias("best"))


def all_running(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """What a stream has written and what it still holds."""
    return read_store(spark, path).unionByName(still_held(spark, checkpoint))

"""Places of rows within their keys without a window over the key, which may hold all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectorloom.sources.tables import stored


def placed(frame: DataFrame, key: str, order: str, name: str = "place") -> DataFrame:
    """frame with the place (0, 1, ...) of each row among the rows of its key, by order (values must differ).

    Rows go to partitions by ranges of (key, order). A place is the key's rows in earlier partitions,
    summed over partitions, and the rows before it in its own. Frames should be narrow: they are shuffled and stored.
    """
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = stored(frame.repartitionByRange(parts, key, order).withColumn("_part", F.spark_partition_id()))
    sums = own.groupBy(key, "_part").agg(F.count("*").alias("_n"))  # a row a key and partition
    before = sums.withColumn("_before", F.coalesce(F.sum("_n").over(W.partitionBy(key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    nth = F.row_number().over(W.partitionBy(key, "_part").orderBy(order)) - 1
    return own.withColumn("_nth", nth).join(before, [key, "_part"]).withColumn(name, F.col("_before") + F.col("_nth")).drop("_before", "_nth", "_part")


def drawn(n: Column, size: int, *seed: Column) -> Column:
    """`size` different numbers under n, ascending, drawn by md5 of the seed and the number of the draw.

    The draw j is a number under n - j, moved past those that were drawn before, so every subset is equally likely.
    """

    def draw(state: Column, j: Column) -> Column:
        name = F.concat_ws(":", *(s.cast("string") for s in seed), j.cast("string"))
        first = F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long") % (n - j)
        return F.sort_array(F.concat(state, F.array(F.aggregate(state, first, lambda r, c: F.when(r >= c, r + 1).otherwise(r)))))

    return F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), F.expr("cast(array() as array<bigint>)"), draw)

"""Which values stand near one of an alphabet's, for alphabets too large to be literals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins are a little narrower than the tolerance, so that two values of one bin are surely near.
NARROW = 0.999


def listed(values: DataFrame, alphabet: DataFrame, within: float, value: str = "x", entry: str = "a") -> DataFrame:
    """values with listed: whether an entry of the alphabet is within the tolerance. A null value is not listed.

    Both sides are binned. Of a bin's entries only the least and the greatest can decide for values in the bins
    beside it, and any entry decides for its own, so the alphabet is a row a bin before it is joined, and no pair of a
    value and an entry is made. Bins of many values are split by adaptive execution, as they meet one row each.
    """
    size = within * NARROW
    edges = alphabet.filter(F.col(entry).isNotNull()).groupBy(F.floor(F.col(entry) / size).alias("bin")).agg(F.min(entry).alias("low"), F.max(entry).alias("high"))
    reach = F.explode(F.sequence(F.lit(-2), F.lit(2))).alias("by")  # two bins are the most that the tolerance spans
    spread = edges.select("bin", "low", "high", reach).select((F.col("bin") + F.col("by")).alias("bin"), F.when(F.col("by") > 0, F.col("high")).alias("below"), F.when(F.col("by") < 0, F.col("low")).alias("above"), (F.col("by") == 0).alias("own"))
    near = spread.groupBy("bin").agg(F.max("below").alias("below"), F.min("above").alias("above"), F.max("own").alias("own"))
    named = near.withColumnsRenamed({c: f"_{c}" for c in near.columns})
    x = F.col(value)
    good = F.col("_own") | (x - F.col("_below") <= within) | (F.col("_above") - x <= within)
    return values.join(named, F.floor(x / size) == F.col("_bin"), "left").withColumn("listed", F.coalesce(good, F.lit(False))).drop(*named.columns)

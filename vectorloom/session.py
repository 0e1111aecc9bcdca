"""Session and configuration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Settings:
    """Parameters of a search run; field defaults are the usual ones."""

    dim: int = 6
    upper_bound: int = 75
    iterations: int = 500
    episodes: int = 100
    workers: int = 64
    simulations: int = 600
    temperature_threshold: int = 15
    history: int = 20
    exploration: float = 2.0
    max_depth: int = 1000
    reward_min: float = 0.0
    reward_max: float = 75.0

    def as_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(k, str(v)) for k, v in self.__dict__.items()], "name string, value string")


def session(app: str = "vectorloom", **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; one BLAS thread a worker."""
    builder = SparkSession.builder.appName(app).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC").config("spark.executorEnv.OMP_NUM_THREADS", "1")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

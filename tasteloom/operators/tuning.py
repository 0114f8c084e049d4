"""Hold-out evaluation and the parameter grid."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.operators import solving
from tasteloom.operators.factors import predict, starting_factors, triples, work_store
from tasteloom.schemas import DEFAULTS
from tasteloom.sources import versions
from tasteloom.sources.tables import settled


def random_split(
    ratings: DataFrame, train_ratio: float = DEFAULTS.train_ratio, seed: int = DEFAULTS.seed
) -> tuple[DataFrame, DataFrame]:
    """A split by a hash of the whole row: it does not change when a part is computed again.

    Equal rows stay on one side.
    """
    drawn = F.pmod(F.xxhash64(F.lit(seed), *ratings.columns), F.lit(1 << 30))
    in_train = drawn < F.lit(round(train_ratio * (1 << 30)))
    return ratings.filter(in_train), ratings.filter(~in_train)


def hash_split(
    ratings: DataFrame, train_ratio: float = DEFAULTS.train_ratio, seed: int = DEFAULTS.seed
) -> tuple[DataFrame, DataFrame]:
    """A split that depends on the ``uid, mid`` values alone: a pair keeps its side."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), "uid", "mid"), F.lit(10_000))
    in_train = bucket < F.lit(round(train_ratio * 10_000))
    return ratings.filter(in_train), ratings.filter(~in_train)


def rmse(predictions: DataFrame, label: str = "score", predicted: str = "prediction") -> DataFrame:
    """One row: ``rmse``."""
    error = F.col(label) - F.col(predicted)
    return predictions.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def with_predictions(observed: DataFrame, predicted: DataFrame) -> DataFrame:
    """Observed ratings with the prediction for their ``uid, mid``.

    ``predicted`` has one row per pair, so every observed rating counts once.
    """
    return observed.join(predicted.select("uid", "mid", "prediction"), ["uid", "mid"])


def grid(
    ratings: DataFrame,
    ranks: Sequence[int] = DEFAULTS.grid_ranks,
    regs: Sequence[float] = DEFAULTS.grid_regs,
    max_iter: int = DEFAULTS.iterations,
    train_ratio: float = DEFAULTS.train_ratio,
    seed: int = DEFAULTS.seed,
    blocks: int = DEFAULTS.als_blocks,
    parallelism: int = 4,
) -> DataFrame:
    """Train on one part, measure on the other: ``rank, reg, rmse, is_best``.

    All points share one split. ``parallelism`` points are trained at the same time.
    """
    spark = ratings.sparkSession
    store = work_store(ratings)
    parts = random_split(triples(ratings), train_ratio, seed)
    train, test = (settled(part, store, name) for part, name in zip(parts, ("Train", "Test"), strict=True))
    users, items = solving.sides(train, max(ranks), store)
    starts = {rank: starting_factors(train, rank, seed, blocks, store, f"Start{rank}") for rank in ranks}

    def measure(point: tuple[int, float]) -> tuple[int, float, float]:
        rank, reg = point
        name = f"Factors{rank}x{reg}"
        model = solving.alternated(spark, users, items, starts[rank], max_iter, reg, store, name)
        error = rmse(predict(model, test)).first()["rmse"]
        for side in ("Users", "Items"):
            versions.delete(spark, store.path(f"{name}{side}{max_iter - 1}"))
        return rank, reg, error

    with ThreadPool(parallelism) as pool:
        rows = pool.map(measure, [(rank, reg) for rank in ranks for reg in regs])
    versions.delete(spark, store.location)
    report = spark.createDataFrame(rows, "rank int, reg double, rmse double")
    winner = best(report).select(F.struct("rank", "reg")).scalar()
    return report.withColumn("is_best", F.struct("rank", "reg") == winner)


def best(report: DataFrame) -> DataFrame:
    """The grid point with the lowest error; one without an error is never better."""
    error = F.nanvl("rmse", F.lit(None).cast("double"))
    return report.orderBy(error.asc_nulls_last(), "rank", "reg").limit(1)

"""Gradient-boosted rating models, their metrics and comparison."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import vocabulary as V
from marquee.functions.bins import EqualWidthBins
from marquee.operators.boosting import Boosting, Fit, Trees, grow
from marquee.operators.matrix import is_reliable
from marquee.operators.sampling import sample_n
from marquee.session import ship_package
from marquee.sources.tables import write_record

LABEL = "target_rating"

FIRST_FIT = Boosting()
TUNED_FIT = Boosting(rounds=500, depth=5, rate=0.05, column_share=0.7, min_rows=5,
                     min_gain_total=0.1, l1=0.1)
TUNED_SMALL_FIT = replace(TUNED_FIT, min_rows=3)


@dataclass(frozen=True)
class Version:
    """One generation of the model: its features, titles and settings."""

    name: str
    features: Sequence[str]
    settings: Boosting
    reliable_only: bool = False

    @property
    def rounds(self) -> int:
        return self.settings.rounds

    @property
    def population(self) -> str:
        return "reliable" if self.reliable_only else "all"


VERSIONS = [
    Version("v1", V.BASE_FEATURES, FIRST_FIT),
    Version("v2", V.INTERACTION_FEATURES, TUNED_FIT),
    Version("v3", V.INTERACTION_FEATURES, TUNED_FIT, reliable_only=True),
    Version("v4-full", V.FULL_FEATURES, TUNED_FIT),
    Version("v4-filtered", V.FULL_FEATURES, TUNED_SMALL_FIT, reliable_only=True),
]


@dataclass(frozen=True)
class RatingModel:
    """A fitted model with all that scoring needs: its features and their bins."""

    trees: Trees
    features: list[str]
    bins: EqualWidthBins

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``; missing features count as 0."""
        ship_package(df.sparkSession)
        trees = self.trees

        def predict(*columns: pa.Array) -> pa.Array:
            return pa.array(trees.predict(np.column_stack(
                [c.to_numpy(zero_copy_only=False) for c in columns])))

        filled = df.na.fill(0, list(self.features))
        inputs = [F.col(f"`{f}`").cast("double") for f in self.features]
        return filled.withColumn("prediction", F.arrow_udf(predict, "double")(*inputs))

    def save(self, path: str) -> None:
        """Store the trees, a row each, and the inputs; what is there is overwritten."""
        spark, t = SparkSession.active(), self.trees
        trees = pa.table({
            "tree": pa.array(range(len(t)), pa.int32()), "features": _lists(t.features, pa.int32()),
            "thresholds": _lists(t.thresholds), "gains": _lists(t.gains), "leaves": _lists(t.values)})
        spark.createDataFrame(trees).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        record = spark.createDataFrame(pa.table({
            "features": [list(self.features)], "bins": [self.bins.to_json()], "base": pa.array([t.base], pa.float64()),
            "depth": pa.array([t.depth], pa.int32())}))
        write_record(record, f"{path}/inputs")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RatingModel:
        row = spark.read.schema(_INPUTS).json(f"{path}/inputs").first()
        stored = spark.read.schema(_TREES).parquet(f"{path}/trees").orderBy("tree").collect()
        inner = 2 ** row.depth - 1
        arrays = [np.array([r[n] for r in stored], kind).reshape(len(stored), size) for n, kind, size in (
            ("features", np.int64, inner), ("thresholds", np.float64, inner), ("gains", np.float64, inner),
            ("leaves", np.float64, inner + 1))]
        return cls(Trees(row.base, row.depth, *arrays), list(row.features), EqualWidthBins.from_json(row.bins))


def _lists(values: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """A list for each line. Tables of Arrow become rows without Python tasks."""
    return pa.array(list(values), pa.list_(kind or pa.float64()))


_TREES = "tree int, features array<int>, thresholds array<double>, gains array<double>, leaves array<double>"
_INPUTS = "features array<string>, bins string, base double, depth int"


def fit(train: DataFrame, features: Sequence[str], bins: EqualWidthBins,
        settings: Boosting = FIRST_FIT, watch: str | None = None,
        tolerance: float = 0.01, **dealing: int) -> RatingModel:
    """Fit boosted trees on a training matrix.

    ``watch`` names a boolean column marking validation rows; the fit then stops once
    their error no longer falls by ``tolerance``. ``dealing`` goes to ``boosting.grow``.
    """
    found = grow(train, LABEL, [Fit("model", list(features), settings)], watch=watch, tolerance=tolerance, **dealing)
    return RatingModel(found["model"], list(features), bins)


def learning_curve(model: RatingModel, df: DataFrame) -> DataFrame:
    """The error on ``df`` after each round, without stopping the fit early.

    A task adds up its rows, so a shuffle carries one row per task and round.
    """
    ship_package(df.sparkSession)
    trees, width = model.trees, len(model.features)
    zero = [F.coalesce(F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(0.0)), F.lit(0.0)) for f in model.features]

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(trees)), 0
        for batch in batches:
            matrix = pa.ListArray.flatten(batch.column("x")).to_numpy(zero_copy_only=False).reshape(-1, width)
            label = batch.column("y").to_numpy()
            total += [np.square(p - label).sum() for p in trees.stages(matrix)]
            n += len(label)
        yield pa.RecordBatch.from_pydict({
            "round": pa.array(np.arange(1, len(trees) + 1), pa.int32()), "total": total, "n": np.full(len(trees), n)})

    rows = df.filter(F.col(LABEL).isNotNull()).select(F.array(*zero).alias("x"), F.col(LABEL).cast("double").alias("y"))
    found = rows.mapInArrow(errors, "round int, total double, n long").groupBy("round").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"))
    return found.select("round", F.sqrt(F.try_divide("total", "n")).alias("rmse"))


def regression_metrics(predicted: DataFrame, label: str = LABEL,
                       prediction: str = "prediction") -> DataFrame:
    """RMSE, R², MAE and the rows they rest on, in one pass.

    R² is taken from the variance, which Spark merges without cancellation. It is null where
    the label does not vary.
    """
    y = F.col(label).cast("double")
    error = y - F.col(prediction).cast("double")
    return predicted.agg(
        F.count("*").alias("test_rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(y))).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
    )


def importances(model: RatingModel, n: int | None = None) -> DataFrame:
    """Features by importance, one row each. As many rows as features, at most."""
    weights = model.trees.importances(len(model.features))
    df = SparkSession.active().createDataFrame(pa.table({
        "feature": pa.array(list(model.features), pa.string()), "importance": pa.array(weights, pa.float64())}))
    ordered = df.orderBy(F.desc("importance"), "feature")
    return ordered if n is None else ordered.limit(n)


def predictions(model: RatingModel, df: DataFrame) -> DataFrame:
    """Predictions beside actual ratings."""
    return with_error(
        model.transform(df).select(
            "tconst", "primarytitle", F.col(LABEL).alias("actual"),
            F.col("prediction").alias("predicted"),
        )
    )


def with_error(df: DataFrame) -> DataFrame:
    """Absolute error; null where the actual rating is unknown."""
    return df.withColumn("error", F.abs(F.col("actual") - F.col("predicted")))


def sample_predictions(model: RatingModel, df: DataFrame, n: int = 8) -> DataFrame:
    return sample_n(predictions(model, df), n)


# The columns of a metrics record.
METRICS = ("version string, population string, n_features int, rounds int, train_rows long, "
           "test_rows long, rmse double, r2 double, mae double")


def train_versions(versions: Sequence[Version], matrix: DataFrame, bins: EqualWidthBins,
                   **dealing: int) -> dict[str, tuple[RatingModel, DataFrame]]:
    """Fit versions side by side on the train rows of ``matrix``; each model with its metrics on the test rows.

    The rows are counted in one pass for all versions.
    """
    def taken(version: Version) -> Column:
        return is_reliable() if version.reliable_only else F.lit(True)

    train, test = (matrix.filter(F.col("split") == s) for s in ("train", "test"))
    found = grow(train, LABEL, [Fit(v.name, list(v.features), v.settings, taken(v)) for v in versions], **dealing)
    counts = train.agg(*[F.count_if(taken(v)).alias(f"n{k}") for k, v in enumerate(versions)]).first()
    out = {}
    for k, version in enumerate(versions):
        model = RatingModel(found[version.name], list(version.features), bins)
        metrics = regression_metrics(model.transform(test.filter(taken(version)))).select(
            F.lit(version.name).alias("version"),
            F.lit(version.population).alias("population"),
            F.lit(len(version.features)).alias("n_features"),
            F.lit(version.rounds).alias("rounds"),
            F.lit(counts[k]).cast("long").alias("train_rows"),
            "test_rows", "rmse", "r2", "mae",
        )
        out[version.name] = model, metrics
    return out


def train_version(version: Version, matrix: DataFrame, bins: EqualWidthBins,
                  **dealing: int) -> tuple[RatingModel, DataFrame]:
    """Fit one version; see ``train_versions``."""
    return train_versions([version], matrix, bins, **dealing)[version.name]


def history(metrics: Sequence[DataFrame]) -> DataFrame:
    """The metrics of several versions as one table, in version order."""
    return reduce(DataFrame.unionByName, metrics).orderBy("version")


def best_version(metrics: DataFrame) -> DataFrame:
    """The row with the highest R². Compare versions of the same population only."""
    return metrics.orderBy(F.desc("r2"), "version").limit(1)


def best_record(metrics: DataFrame, first: str = "v1", full: str = "v4-full",
                filtered: str = "v4-filtered") -> DataFrame:
    """One row about the better of the last two versions, and what it gained over the first.

    The filtered version is measured on another population than the others, as published, so
    its gain mixes a better model with easier titles. Where the R² are equal the full one wins.
    """
    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col("version") == name, F.col(column)))

    better = of(filtered, "r2") > of(full, "r2")
    columns = ["rmse", "r2", "mae", "n_features"]
    best = [F.when(better, of(filtered, c)).otherwise(of(full, c)).alias(c) for c in columns]
    chosen = F.when(better, filtered).otherwise(full).alias("best_model")
    row = metrics.agg(chosen, *best, of(full, "r2").alias("full_dataset_r2"),
                      of(filtered, "r2").alias("filtered_dataset_r2"), of(first, "r2").alias("first_r2"))
    return row.withColumn("improvement_over_first", F.col("r2") - F.col("first_r2"))

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from marquee import vocabulary as V
from marquee.functions.bins import EqualWidthBins
from marquee.operators import matrix, models
from marquee.operators.models import Boosting
from marquee.sources import tables

FEATURES = ["a", "b", "noise"]
BINS = EqualWidthBins(2.0, 12.0)


@pytest.fixture(scope="module")
def signal(spark):
    df = spark.range(2000).selectExpr(
        "concat('tt', id) AS tconst", "concat('T', id) AS primarytitle",
        "(id % 7) / 7D AS a", "cast(id % 3 = 0 AS int) AS b", "rand(3) AS noise")
    df = df.withColumn("target_rating", (4 + 3 * F.col("a") + F.col("b")).cast("float"))
    return tables.materialize(matrix.with_split(df), "signal")


@pytest.fixture(scope="module")
def model(signal):
    train = signal.filter("split = 'train'")
    return models.fit(train, FEATURES, BINS, Boosting(rounds=10, depth=3, rate=0.3))


def test_fit_beats_the_mean(signal, model):
    test = model.transform(signal.filter("split = 'test'"))
    row = models.regression_metrics(test).first()
    assert row.r2 > 0.9 and row.rmse < 0.5
    assert test.filter(F.isnan("prediction") | F.col("prediction").isNull()).count() == 0


def test_metrics_equal_the_evaluator(signal, model):
    test = model.transform(signal.filter("split = 'test'"))
    mine = models.regression_metrics(test).first()
    for name in ("rmse", "r2", "mae"):
        evaluator = RegressionEvaluator(labelCol="target_rating", metricName=name)
        assert mine[name] == pytest.approx(evaluator.evaluate(test))
    assert mine.test_rows == test.count()


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(1)
    y, p = rng.uniform(1, 10, 500), rng.uniform(1, 10, 500)
    df = spark.createDataFrame(
        [(float(a), float(b)) for a, b in zip(y, p)], "target_rating double, prediction double")
    row = models.regression_metrics(df).first()
    assert row.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert row.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))
    assert row.mae == pytest.approx(np.mean(np.abs(y - p)))


def test_r2_is_null_for_a_constant_label(spark):
    df = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "target_rating double, prediction double")
    row = models.regression_metrics(df).first()
    assert row.r2 is None and row.rmse == 1.0


def test_stored_model_predicts_the_same(spark, signal, model, tmp_path):
    model.save(str(tmp_path / "m"))
    model.save(str(tmp_path / "m"))  # overwrites
    again = models.RatingModel.load(spark, str(tmp_path / "m"))
    assert again.features == FEATURES and again.bins == BINS
    rows = [models.predictions(m, signal).orderBy("tconst").collect() for m in (model, again)]
    assert rows[0] == rows[1]


def test_importances_are_sorted_and_name_the_signal(model):
    rows = models.importances(model).collect()
    assert [r.feature for r in rows][0] == "a" and len(rows) == 3
    assert sum(r.importance for r in rows) == pytest.approx(1)
    assert models.importances(model, 1).count() == 1


def test_learning_curve_falls(signal, model):
    curve = [r.rmse for r in models.learning_curve(
        model, signal.filter("split = 'test'")).orderBy("round").collect()]
    assert len(curve) == 10 and curve[-1] < curve[0]


def test_watching_a_validation_set_stops_early(signal):
    watched = signal.withColumn("held_out", F.col("split") == "test")
    fitted = models.fit(watched, FEATURES, BINS, Boosting(rounds=40, depth=5, rate=1.0),
                        watch="held_out")
    assert 1 <= len(fitted.trees) < 40


def test_missing_features_count_as_zero(signal, model):
    blank = signal.withColumn("a", F.lit(None).cast("double")).limit(5)
    zero = signal.withColumn("a", F.lit(0.0)).limit(5)
    assert [r.prediction for r in model.transform(blank).collect()] == [
        r.prediction for r in model.transform(zero).collect()]


def test_settings_reach_the_booster(signal):
    settings = Boosting(rounds=1, depth=2, rate=0.05, column_share=0.7, min_rows=600, l1=1e9)
    trees = models.fit(signal, FEATURES, BINS, settings).trees
    assert len(trees) == 1 and trees.depth == 2 and (trees.gains == 0).all()  # so large a penalty leaves nothing


def test_versions():
    assert [(v.name, len(v.features), v.population) for v in models.VERSIONS] == [
        ("v1", 28, "all"), ("v2", 37, "all"), ("v3", 37, "reliable"),
        ("v4-full", 43, "all"), ("v4-filtered", 43, "reliable")]
    first, *_, filtered = models.VERSIONS
    assert (first.settings.rounds, first.settings.depth, first.settings.rate) == (200, 6, 0.1)
    assert filtered.settings.min_rows == 3 and filtered.settings.rounds == 500


def test_the_record_of_the_best(spark):
    rows = spark.createDataFrame(
        [("v1", 28, 1.1, 0.3, 0.8), ("v4-full", 43, 0.8, 0.66, 0.55), ("v4-filtered", 43, 0.7, 0.56, 0.5)],
        "version string, n_features int, rmse double, r2 double, mae double")
    row = models.best_record(rows).first()
    assert (row.best_model, row.rmse, row.filtered_dataset_r2) == ("v4-full", 0.8, 0.56)
    assert row.improvement_over_first == pytest.approx(0.36)


def test_best_version_has_the_highest_r2(spark):
    rows = spark.createDataFrame(
        [("v1", 0.3), ("v4", 0.6), ("v2", 0.5)], "version string, r2 double")
    assert models.best_version(rows).first().version == "v4"
    ordered = models.history([rows.filter("version = 'v4'"), rows.filter("version = 'v1'")])
    assert [r.version for r in ordered.collect()] == ["v1", "v4"]


def test_sample_of_predictions(signal, model):
    rows = models.sample_predictions(model, signal).collect()
    assert len(rows) == 8
    assert all(r.error == pytest.approx(abs(r.actual - r.predicted)) for r in rows)


def test_train_and_test_do_not_overlap(signal):
    parts = [signal.filter(F.col("split") == s).select("tconst") for s in ("train", "test")]
    assert parts[0].join(parts[1], "tconst").count() == 0
    assert parts[0].count() + parts[1].count() == 2000


def test_feature_list_has_no_target():
    assert "target_rating" not in V.FULL_FEATURES and "is_high_rated" not in V.FULL_FEATURES


def test_a_model_is_stored_without_python_tasks(model, tmp_path, monkeypatch):
    """Each of the small tables would else wait for a Python worker in every core."""
    made = []
    create = SparkSession.createDataFrame
    monkeypatch.setattr(SparkSession, "createDataFrame",
                        lambda self, data, *a, **k: made.append(data) or create(self, data, *a, **k))
    model.save(str(tmp_path))
    models.importances(model).collect()
    assert [type(data) for data in made] == [pa.Table] * 3


def test_the_full_matrix_needs_its_inputs_only(spark):
    titles = spark.createDataFrame(
        [(1, "A", 1999, 100, "Drama", 7.5, 100, 1, 7.0, 2, 0.5, 3.0, 0, 8.0, "more")],
        "tconst long, primarytitle string, startyear int, runtimeminutes int, genres string, averagerating float,"
        " numvotes int, is_high_rated int, director_avg_rating double, director_movie_count long,"
        " director_hit_rate double, director_votes_log double, has_known_director int, director_max_rating float,"
        " originaltitle string")
    bins = EqualWidthBins(0.0, 10.0)
    narrow = matrix.training_matrix_in_one_pass(titles.select(matrix.MATRIX_INPUTS), bins)
    assert narrow.collect() == matrix.training_matrix_in_one_pass(titles, bins).collect()

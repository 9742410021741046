import gzip
import json

import pytest
from pyspark.sql import functions as F
from rows import CREDITS, RATINGS, TITLES, credits, ratings, titles

from marquee import vocabulary as V
from marquee.functions.bins import EqualWidthBins
from marquee.operators import matrix, models, quality
from marquee.plans import lake as plans
from marquee.session import scratch_path, shared_dir
from marquee.sources import tables, tsv


def write_gz(path, header, lines):
    with gzip.open(path, "wt") as f:
        for line in [header, *lines]:
            f.write("\t".join(r"\N" if v is None else v for v in line) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    basics = [(k, kind, name, name, "0", year, None, minutes, genres)
              for k, kind, name, year, minutes, genres in TITLES]
    principals = [(t, o, n, c, None, None) for t, o, n, c in CREDITS]
    lake = plans.Lake(str(base / "out"))
    counts, bins = plans.run_all(
        spark,
        write_gz(base / "t.tsv.gz", tsv.TITLE_COLUMNS, basics),
        write_gz(base / "r.tsv.gz", tsv.RATING_COLUMNS, RATINGS),
        write_gz(base / "c.tsv.gz", tsv.CREDIT_COLUMNS, principals),
        lake,
    )
    return lake, counts, bins


def test_counts_while_writing_equal_the_exact_ones(spark, built):
    exact = dict(quality.stage_counts(titles(spark), ratings(spark), credits(spark)).collect())
    _, counts, _ = built
    assert {k: counts[k] for k in exact if k != "movies"} == {
        k: v for k, v in exact.items() if k != "movies"}
    assert counts["features"] == counts["enriched"] == exact["clean"] == 6


def test_stored_tables(spark, built):
    lake, _, bins = built
    cleaned = tables.read_table(spark, lake.path("cleaned"))
    assert sorted(cleaned.columns) == sorted(V.CLEANED_COLUMNS) and cleaned.columns[-1] == "decade"
    assert len(tables.read_table(spark, lake.path("features")).columns) == 33
    assert len(tables.read_table(spark, lake.path("director_features")).columns) == 22
    training = tables.read_table(spark, lake.path("training"))
    assert training.columns == V.ID_COLUMNS + V.FULL_FEATURES + ["split"]
    assert training.count() == 6
    assert bins.low < bins.high and bins.count == 10


def test_stored_catalog(spark, built):
    assert spark.sql("SELECT sum(movie_count) AS n FROM v_decade_stats").first().n == 6


def test_models_are_fitted_stored_and_used(spark, tmp_path):
    """From the training data to answered requests, with versions small enough for a test."""
    lake = plans.Lake(str(tmp_path))
    rows = spark.range(400).selectExpr(
        "concat('tt', id) AS tconst", "concat('T', id) AS primarytitle", "2000 AS startyear",
        "cast(4 + id % 5 AS float) AS target_rating", "0 AS is_high_rated",
        *[f"cast((id * {k + 3}) % 7 AS double) AS {c}" for k, c in enumerate(V.FULL_FEATURES)])
    rows = rows.withColumn("votes_log", F.log(F.lit(40000.0) + F.expr("cast(substring(tconst, 3) AS int) * 100")))
    tables.write_split(matrix.with_split(rows), lake.path("training"))
    small = models.Boosting(rounds=2, depth=2, rate=0.5)
    versions = [models.Version("v1", V.BASE_FEATURES, small), models.Version("v4-full", V.FULL_FEATURES, small),
                models.Version("v4-filtered", V.FULL_FEATURES, small, reliable_only=True)]
    found = plans.store_models(spark, lake, EqualWidthBins(2.0, 12.0), versions)
    assert [(r.version, r.rounds, r.n_features) for r in found.collect()] == [
        ("v1", 2, 28), ("v4-filtered", 2, 43), ("v4-full", 2, 43)]
    best = spark.read.json(lake.path("metrics/best")).first()
    by_name = {r.version: r for r in found.collect()}
    assert best.r2 == max(by_name["v4-full"].r2, by_name["v4-filtered"].r2) == by_name[best.best_model].r2
    assert best.improvement_over_first == pytest.approx(best.r2 - by_name["v1"].r2)
    both = spark.read.csv(lake.path("training_csv"))
    assert both.count() == 400 and len(both.columns) == 45
    requests = spark.createDataFrame(
        [(1, '{"genres":"Drama"}'), (2, "{"), (3, '{"year":1999}')], "id int, request string")
    answers = {r.id: r for r in plans.answer(requests, plans.best_model(spark, lake)).collect()}
    assert [answers[k].status_code for k in (1, 2, 3)] == [200, 500, 400]
    assert json.loads(answers[1].response)["input"] == {"genres": "Drama"}
    assert json.loads(answers[3].response) == {"error": "genres field required"}


def test_scratch_paths_are_fresh_and_below_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_dir(spark))


class Session:
    """The two things ``shared_dir`` asks of a session."""

    def __init__(self, settings, master="spark://cluster"):
        self.conf = settings
        self.sparkContext = type("Context", (), {
            "master": master, "getCheckpointDir": staticmethod(lambda: None)})


def test_a_named_shared_folder_is_used():
    assert shared_dir(Session({"spark.checkpoint.dir": "/shared/x/"})) == "/shared/x"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError):
        shared_dir(Session({}))

"""Text found by index, genres as tokens, models compared on the same titles."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee import vocabulary as V
from marquee.operators import reports, title_index, tokens, uncertainty
from marquee.session import scratch_path
from marquee.sources import tables


@pytest.fixture(scope="module")
def indexed(spark):
    names = ["The Cat", "The Catalogue", "the cat", "Tü漢字🙂x", "ab", "", None, "aaaa", "a.b%c_d"]
    rows = [(k, names[k % len(names)] if k < 90 else f"The Film {k}") for k in range(2000)]
    titles = tables.materialize(spark.createDataFrame(rows, "tconst long, primarytitle string"), "titles")
    path = scratch_path(spark, "index")
    title_index.write_index(titles, path)
    return titles, path


@pytest.mark.parametrize("text", [
    "The Cat", "cat", "Catal", "The ", "a", "", "ab", "aaa", "aaaaa", "漢字🙂", "Film 777", "b%c_", "zzz", "Film zzz"])
def test_the_index_finds_what_the_scan_finds(spark, indexed, text):
    titles, path = indexed
    found = title_index.search(spark, path, titles, text)
    assert sorted(found.collect()) == sorted(reports.title_search(titles, text).collect())


def test_a_rare_text_reads_no_common_list(spark, indexed):
    titles, path = indexed
    counts = {r.gram: r.titles for r in spark.read.parquet(f"{path}/counts").collect()}
    assert counts["The"] > 1900 and title_index.trigrams("aaaa") == ["aaa"]
    chosen = sorted(title_index.trigrams("The Film 777"), key=lambda g: (counts[g], g))[:title_index.LISTS]
    assert "The" not in chosen
    assert "LeftSemi" in title_index.search(spark, path, titles, "The Film 777")._jdf.queryExecution().toString()


def test_common_lists_fill_several_files(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so short lists are not put together
    titles = spark.range(40_000).selectExpr("id as tconst", "'Same' as primarytitle")
    path = scratch_path(spark, "index")
    title_index.write_index(titles, path)
    files = spark.read.parquet(f"{path}/postings").filter("gram = 'Sam'").select(F.input_file_name()).distinct()
    assert files.count() > 1


def test_tokens(spark, tmp_path):
    titles = spark.createDataFrame(
        [(1, "Drama,War"), (2, " War , Drama,Drama"), (3, None), (4, ""), (5, "Musical"), (6, "Drama")],
        "tconst long, genres string")
    genres = tokens.GenreTokens.fit(titles, 2)
    assert genres.vocabulary == ["Drama", "War"]
    genres.save(str(tmp_path / "genres"))
    again = tokens.GenreTokens.load(spark, str(tmp_path / "genres"))
    assert again == genres
    got = {r.tconst: (r.names, r.unknown_genres) for r in again.transform(titles).select(
        "tconst", again.names().alias("names"), "unknown_genres").collect()}
    assert got == {1: (["Drama", "War"], 0), 2: (["Drama", "War"], 0), 3: ([], 0), 4: ([], 0), 5: ([], 1), 6: (["Drama"], 0)}
    assert tokens.GenreTokens.fit(titles, 9, least=2).vocabulary == ["Drama", "War"]


def test_names_within_others_are_told_apart(spark):
    """A flag finds ``Music`` in ``Musical``; a token does not."""
    titles = spark.createDataFrame([(1, "Musical")], "tconst long, genres string")
    genres = tokens.GenreTokens(["Music"])
    assert genres.transform(titles).select(genres.names().alias("n")).first().n == []


def plain_weight(key, replicate):
    import hashlib

    if replicate == 0:
        return 1
    x = (int(hashlib.md5(f"{V.SEED}:{key}".encode()).hexdigest()[:8], 16) + replicate * uncertainty.STEP) % 2 ** 32
    for _ in range(2):
        x = ((x >> 16) ^ x) * uncertainty.MIX % 2 ** 32
    x ^= x >> 16
    return sum(x >= cut for cut in uncertainty.poisson_cuts())


def test_weights_are_poisson_and_differ_by_replicate(spark):
    keys, replicates = range(3000), range(0, 4)
    got = spark.range(3000).select("id", *[
        uncertainty.weight(uncertainty.key_hash(F.col("id")), F.lit(r).cast("long")).alias(f"w{r}") for r in replicates]).collect()
    table = np.array([[r[f"w{k}"] for k in replicates] for r in sorted(got)])
    assert (table == [[plain_weight(k, r) for r in replicates] for k in keys]).all()
    assert (table[:, 0] == 1).all()
    for k in range(1, 4):
        assert abs((table[:, k] == 0).mean() - math.exp(-1)) < 0.03 and abs(table[:, k].mean() - 1) < 0.06
    assert abs(np.corrcoef(table[:, 1], table[:, 2])[0, 1]) < 0.06


def test_interval_against_numpy(spark):
    rng = np.random.default_rng(2)
    y = rng.uniform(1, 10, 400)
    a, b = y + rng.normal(0, 1.0, 400), y + rng.normal(0, 0.8, 400)
    rows = [(k, *map(float, r)) for k, r in enumerate(zip(y, a, b))] + [(900, None, 1.0, 1.0), (901, 1.0, None, 1.0)]
    table = spark.createDataFrame(rows, "tconst long, y double, a double, b double")
    got = uncertainty.paired_bootstrap(table, "y", "a", "b", replicates=60).first()

    def gain(w):
        mean = (w * y).sum() / w.sum()
        spread = (w * (y - mean) ** 2).sum()
        return ((w * (y - a) ** 2).sum() - (w * (y - b) ** 2).sum()) / spread

    gains = [gain(np.array([plain_weight(k, r) for k in range(400)])) for r in range(61)]
    assert got.rows == 400 and got.gain == pytest.approx(gains[0])
    assert (got.low, got.high) == pytest.approx(tuple(np.quantile(gains[1:], [0.025, 0.975])))
    assert got.share_above == np.mean(np.array(gains[1:]) > 0) and got.low < got.gain < got.high

"""Bucketed tables, daily merges, refused lines, partial aggregates."""

import os
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marquee.operators import cleaning, matrix, reputation, rollups
from marquee.session import scratch_path
from marquee.sources import daily, quarantine, tables

TITLES = [
    "concat('tt', id) as tconst", "'movie' as titletype", "'T' as primarytitle", "'T' as originaltitle",
    "cast(1950 + id % 70 as string) as startyear", "'100' as runtimeminutes", "'Drama' as genres", "'0' as isadult"]


def titles(spark, n=500):
    return spark.range(n).selectExpr(*TITLES)


def ratings(spark, n=500):
    return spark.range(n).selectExpr("concat('tt', id) as tconst", "cast(1 + id % 90 / 10 as float) as averagerating",
                                     "cast(100 + id as int) as numvotes")


def cleaned(spark, n=500):
    return cleaning.clean_titles(titles(spark, n), ratings(spark, n))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def stored(spark, conf, request):
    """Store a table in buckets by title, under a name of its own."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    names = []

    def store(df, key="tconst"):
        names.append(f"t_{uuid.uuid4().hex}")
        return tables.write_bucketed(df, names[-1], scratch_path(spark, "bucketed"), key, 4)

    yield store
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_joins_by_title_shuffle_nothing(spark, stored):
    joined = cleaning.clean_titles(stored(titles(spark)), stored(ratings(spark)))
    assert "Join" in plan(joined) and "Exchange" not in plan(joined)
    assert sorted(joined.collect()) == sorted(cleaned(spark).collect())

    rows = spark.range(900).selectExpr("concat('tt', id % 500) as tconst", "1 as ordering", "id % 20 as director_id")
    stats = reputation.director_stats(stored(rows), stored(ratings(spark)))
    below = plan(stats).split("Join")[-1]
    assert "Exchange" not in below and stats.count() == 20

    features = matrix.feature_matrix(cleaned(spark))
    slim = features.select("tconst").withColumns({c: F.lit(1.0) for c in matrix.V.DIRECTOR_FEATURES})
    merged = matrix.merge_directors(stored(features), stored(slim))
    assert "Exchange" not in plan(merged) and merged.count() == features.count()


def test_bucketed_tables_are_replaced(spark):
    name, path = f"t_{uuid.uuid4().hex}", scratch_path(spark, "bucketed")
    for n in (10, 20):
        assert tables.write_bucketed(spark.range(n), name, path, "id", 2).count() == n
    spark.sql(f"DROP TABLE {name}")


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_two_runs_equal_one(spark, tmp_path):
    path, everything = str(tmp_path / "cleaned"), cleaned(spark)
    old = everything.filter("decade < 2010").withColumn(
        "decade", F.when(F.col("tconst") == "tt3", 1900).otherwise(F.col("decade")))
    tables.write_cleaned(old, path)
    before = files(path)
    changed = everything.filter("decade >= 2010 or tconst in ('tt3', 'tt5')")
    assert daily.merge_cleaned(spark, path, changed) == {1900, 1950, 2010}
    got = tables.read_table(spark, path).select(everything.columns)
    assert sorted(got.collect()) == sorted(everything.collect())
    after = files(path)
    kept = {f for f in before if not f.startswith(("decade=1900", "decade=1950"))}
    assert all(before[f] == after.get(f) for f in kept) and kept
    assert not os.path.exists(f"{path}/decade=1900")  # its last title has moved
    assert daily.merge_cleaned(spark, path, changed.limit(0)) == set() and files(path) == after
    daily.merge_cleaned(spark, path, changed)  # a repeated run changes nothing
    assert sorted(tables.read_table(spark, path).select(everything.columns).collect()) == sorted(everything.collect())


COLUMNS = ["tconst", "averageRating", "numVotes"]


def lines(spark, tmp_path, *texts):
    for k, text in enumerate(texts):
        (tmp_path / f"{k}.tsv").write_bytes(text.encode())
    return quarantine.checked_lines(spark, str(tmp_path), COLUMNS, quarantine.RATING_NUMBERS)


def test_lines_are_read_or_refused(spark, tmp_path):
    header = "\t".join(COLUMNS)
    checked = lines(spark, tmp_path, f"{header}\ntt1\t7.5\t100\ntt2\t\\N\t\\N\ntt3\thigh\t9x\n",
                    f"{header}\r\ntt4\t1\t2\t3\r\ntt5\t6\t10\r\n\r\n")
    assert sorted(tuple(r) for r in quarantine.sound(checked, COLUMNS).collect()) == [
        ("tt1", "7.5", "100"), ("tt2", None, None), ("tt5", "6", "10")]
    bad = {r.line: (r.file.rsplit("/", 1)[1], r.reasons) for r in quarantine.refused(checked).collect()}
    assert bad == {"tt3\thigh\t9x": ("0.tsv", ["averagerating is no float", "numvotes is no int"]),
                   "tt4\t1\t2\t3": ("1.tsv", ["4 fields, not 3"]), "": ("1.tsv", ["1 fields, not 3"])}
    counts = {r.reason: r.lines for r in quarantine.reason_counts(checked).collect()}
    assert counts["sound"] == 3 and sum(counts.values()) == 7


def test_a_run_that_would_lose_too_much_is_stopped(spark, tmp_path):
    (tmp_path / "in").mkdir()
    checked = lines(spark, tmp_path / "in", "\n".join(["\t".join(COLUMNS), *["tt1\t7\t1"] * 98, "x", "y"]))
    taken = quarantine.take_in(checked, COLUMNS, str(tmp_path / "bad"), 0.02)
    assert taken.count() == 98 and spark.read.parquet(str(tmp_path / "bad")).count() == 2
    with pytest.raises(quarantine.TooManyRefused, match="2 of 100"):
        quarantine.take_in(checked, COLUMNS, str(tmp_path / "bad"), 0.01)
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2  # kept for whoever looks into it


def test_the_gate(spark):
    measures = spark.createDataFrame([(99.5, 80.0, None)], "titles double, ratings double, votes double")
    assert quarantine.require(measures, {"titles": 99.0}) == {"titles": 99.5}
    with pytest.raises(quarantine.QualityTooLow, match="ratings is 80.0, not 99.0, votes is None"):
        quarantine.require(measures, {"titles": 99.0, "ratings": 99.0, "votes": 1.0})


def test_merged_partials_equal_the_whole(spark):
    rows = cleaned(spark)
    loads = [rollups.partials(rows.filter(F.pmod(F.xxhash64("tconst"), F.lit(3)) == k)) for k in range(3)]
    parts = loads[0].unionByName(loads[1]).unionByName(loads[2])
    for by in (("decade",), ()):
        columns = [*by, *rollups.SUMS, *rollups.GREATEST]
        whole = rollups.merged(rollups.partials(rows), by).select(columns)
        again = rollups.merged(rollups.merged(parts).unionByName(loads[0].limit(0)), by).select(columns)
        assert sorted(whole.collect()) == sorted(again.collect())
    counted = rollups.distinct_counts(parts, ()).first()
    assert abs(counted.distinct_titles - 500) <= 4 * rollups.SKETCH_ERROR * 500 and counted.distinct_genres == 1
    assert rollups.health(parts).first().decades_covered == rows.select("decade").distinct().count()

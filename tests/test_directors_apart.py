"""Reputation without a title's own rating, and directors looked up while scoring."""

import random

from pyspark.sql import functions as F

from marquee import vocabulary as V
from marquee.operators import reputation, scoring
from marquee.session import scratch_path
from marquee.sources import tables
from marquee.streaming import updates


def titles(n=400):
    rng = random.Random(8)
    # a third of all titles have one director; years repeat, some are missing; title, director, year, tenths, votes
    return [(k, 1 if k % 3 == 0 else rng.randint(2, 40), rng.choice([None, *range(1990, 2010)]),
             rng.randint(10, 100), rng.randint(1, 90_000)) for k in range(n)]


def as_tables(spark, rows):
    entries = spark.createDataFrame([(k, 1, d) for k, d, *_ in rows] + [(rows[0][0], 2, rows[0][1])],
                                    "tconst long, ordering int, director_id long")
    ratings = spark.createDataFrame([(k, r / 10, v) for k, _, _, r, v in rows],
                                    "tconst long, averagerating float, numvotes int")
    cleaned = ratings.join(spark.createDataFrame([(k, y) for k, _, y, *_ in rows], "tconst long, startyear int"), "tconst")
    return entries, ratings, cleaned.withColumn("is_high_rated", (F.col("averagerating") >= 7).cast("int"))


def expected(others):
    if not others:
        return (1, 6.0, 0.3, 0, 6.0)
    r = [o[3] for o in others]
    return (len(r), round(sum(r) / 10 / len(r), 3), round(sum(x >= 70 for x in r) / len(r), 3), int(len(r) >= 3),
            max(r) / 10)


def check(found, wanted):
    columns = ("director_movie_count", "director_avg_rating", "director_hit_rate", "has_known_director",
               "director_max_rating")
    got = {r.tconst: [r[c] for c in columns] for r in found.collect()}
    assert got.keys() == wanted.keys()
    for title, values in wanted.items():
        assert all(abs(a - b) < 2e-3 for a, b in zip(got[title], values)), (title, got[title], values)


def test_only_earlier_titles_count(spark):
    rows = titles()
    entries, ratings, cleaned = as_tables(spark, rows)
    rated = reputation.rated_titles(entries, ratings)
    before = reputation.stats_before(reputation.yearly_sums(rated, cleaned))
    found = reputation.with_directors_before(cleaned, reputation.primary_director(entries), before)
    check(found, {t[0]: expected([o for o in rows if t[2] and o[1] == t[1] and o[2] and o[2] < t[2]]) for t in rows})


def test_all_other_titles_count(spark):
    rows = titles() + [(900, 77, 2000, 95, 5), (901, 78, 2000, 95, 5), (902, 78, 2001, 95, 6), (903, 78, 2001, 60, 6)]
    entries, ratings, cleaned = as_tables(spark, rows)
    sums = reputation.director_sums(reputation.rated_titles(entries, ratings))
    found = reputation.with_other_titles(cleaned, reputation.primary_director(entries), sums)
    check(found, {t[0]: expected([o for o in rows if o[1] == t[1] and o[0] != t[0]]) for t in rows})


def test_a_director_with_very_many_titles_does_not_sit_in_one_task(spark):
    """What reaches the window is a row per year, whatever the titles."""
    rated = spark.range(20_000).selectExpr("id as tconst", "1L as director_id", "50L as tenths", "9L as votes", "0L as hit")
    years = spark.range(20_000).selectExpr("id as tconst", "cast(1990 + id % 20 as int) as startyear")
    sums = reputation.yearly_sums(rated, years)
    assert sums.count() == 20
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_sum" in plan
    last = reputation.stats_before(sums).orderBy(F.desc("startyear")).first()
    assert (last.director_movie_count, last.director_avg_rating) == (19_000, 5.0)


def known(spark, path, rows):
    stats = spark.createDataFrame(
        [(d, 8.0, n, 0.5, 9.0, 1, 9.5) for d, n in rows],
        "director_id long, director_avg_rating double, director_movie_count long, director_hit_rate double, "
        "director_votes_log double, has_known_director int, director_max_rating float")
    stats.write.mode("append").parquet(path)


def test_directors_are_looked_up(spark):
    path = scratch_path(spark, "stats")
    known(spark, path, [(1, 30)])
    requests = spark.createDataFrame(
        [(k, "Drama", [1, 2, None][k % 3], 7.0) for k in range(300)],
        "request_id long, genres string, director_id long, director_avg_rating double")
    found = scoring.score_features(
        scoring.look_up_directors(requests, tables.read_table(spark, path)), variant="service").collect()
    assert len(found) == 300
    for r in found:
        own = (r.director_movie_count, r.director_avg_rating, r.director_max_rating)
        assert own == ((30, 8.0, 9.5) if r.director_id == 1 else (V.ASSUMED_MOVIE_COUNT, 7.0, 8.0))
    scored = scoring.score_requests(
        scoring.look_up_directors(requests, tables.read_table(spark, path)),
        lambda df: df.withColumn("prediction", F.col("director_avg_rating")), variant="service")
    assert set(requests.columns) < set(scored.columns) and scoring.DIRECTOR not in scored.columns
    assert {r.predicted_rating for r in scored.collect()} == {8.0, 7.0}


def test_stats_that_come_late_are_seen_by_the_batches_after(spark):
    path, source = scratch_path(spark, "stats"), scratch_path(spark, "requests")
    known(spark, path, [(1, 30)])
    rows = spark.createDataFrame([(1, "Drama", 1), (2, "Drama", 2)], "request_id long, genres string, director_id long")
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(source)
    seen = []

    def each(batch):
        out = scoring.look_up_directors(batch, tables.read_table(spark, path))
        out = scoring.score_features(out, variant="service").select("request_id", "director_movie_count")
        seen.append(sorted(tuple(r) for r in out.collect()))
        if len(seen) == 1:
            known(spark, path, [(2, 44)])
        return out.select("request_id")

    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    updates.run_rows(stream, "late", each)
    assert seen == [[(1, 30), (2, V.ASSUMED_MOVIE_COUNT)], [(1, 30), (2, 44)]]


def test_a_director_most_requests_name_is_split(spark, conf):
    for key, value in (("autoBroadcastJoinThreshold", "-1"), ("adaptive.autoBroadcastJoinThreshold", "-1"),
                       ("adaptive.skewJoin.skewedPartitionThresholdInBytes", "10KB"),
                       ("adaptive.skewJoin.skewedPartitionFactor", "2"),
                       ("adaptive.advisoryPartitionSizeInBytes", "10KB")):
        conf(f"spark.sql.{key}", value)
    requests = spark.range(60_000).selectExpr(
        "id as request_id", "'Drama' as genres", "case when id % 3 > 0 then 1L else id end as director_id")
    stats = spark.range(500).selectExpr(
        "id as director_id", "7D as director_avg_rating", "3L as director_movie_count", "0.5D as director_hit_rate",
        "8D as director_votes_log", "1 as has_known_director", "9F as director_max_rating")
    found = scoring.look_up_directors(requests.repartition(8), stats.repartition(8))
    assert found.filter(F.col(scoring.DIRECTOR).isNotNull()).count() > 40_000
    found.write.format("noop").mode("overwrite").save()
    found.collect()
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()

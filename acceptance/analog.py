"""Titles, ratings, credits, requests and job metrics derived from the given tables.

Orders play the titles, line items the credits and events the job metrics. All rows of
each table are used. Values are shaped so that every tier, every missing value and every
boundary occurs.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from marquee import vocabulary as V

GENRE_POOL = V.GENRES + ["Western", "War"]
RATED = "o_orderpriority <> '4-NOT SPECIFIED'"


@lru_cache(maxsize=None)
def _schema(application: str, path: str) -> StructType:
    return SparkSession.active().read.parquet(path).schema


def table_schema(spark: SparkSession, sf_dir: str, table: str) -> StructType:
    """A table's columns; its footers are read once per session."""
    return _schema(spark.sparkContext.applicationId, f"{sf_dir}/{table}.parquet")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    schema = table_schema(spark, sf_dir, table)
    return spark.read.schema(schema).parquet(f"{sf_dir}/{table}.parquet")


def load_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The table as a stream. The braces make the path a pattern, so a file will do."""
    schema = table_schema(spark, sf_dir, table)
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{{table}}}.parquet")


def _genre(index: str) -> str:
    names = ", ".join(f"'{g}'" for g in GENRE_POOL)
    return f"element_at(array({names}), cast({index} % 17 AS int) + 1)"


def _unless_every(n: int, value: str) -> str:
    return f"CASE WHEN o_orderkey % {n} <> 0 THEN {value} END"


GENRES = f"""CASE WHEN o_orderkey % 23 = 0 THEN NULL
    WHEN o_orderkey % 3 = 0 THEN {_genre('o_orderkey')}
    ELSE concat({_genre('o_orderkey')}, ',', {_genre('(o_orderkey + 5)')}) END"""
YEAR = _unless_every(89, "cast(1890 + o_custkey % 140 AS int)")
RUNTIME = _unless_every(11, "cast(20 + o_orderkey % 181 AS int)")
RATING = "cast((10 + floor(o_totalprice) % 91) / 10D AS float)"
VOTES = """cast(CASE WHEN o_orderkey % 101 = 0 THEN 49999 WHEN o_orderkey % 103 = 0 THEN 10000
    WHEN o_orderkey % 107 = 0 THEN 50000
    ELSE floor(floor(o_totalprice) / power(10, o_orderkey % 6)) END AS int)"""

TITLE_COLUMNS = [
    "o_orderkey AS tconst",
    "CASE WHEN o_orderstatus = 'P' THEN 'tvEpisode' ELSE 'movie' END AS titletype",
    _unless_every(97, "concat('Title ', o_orderkey)") + " AS primarytitle",
    _unless_every(97, "concat('TITLE ', o_orderkey)") + " AS originaltitle",
    f"{YEAR} AS startyear",
    f"{RUNTIME} AS runtimeminutes",
    f"{GENRES} AS genres",
    "CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS isadult",
]
RATING_COLUMNS = ["o_orderkey AS tconst", f"{RATING} AS averagerating", f"{VOTES} AS numvotes"]
CREDIT_COLUMNS = [
    "l_orderkey AS tconst", "l_linenumber AS ordering", "l_suppkey AS nconst",
    """CASE l_returnflag WHEN 'A' THEN 'director' WHEN 'R' THEN 'actor' ELSE 'writer' END
    AS category""",
]
# A scoring request per order, and the rating it turned out to have, if any.
REQUEST_COLUMNS = [
    "o_orderkey AS request_id",
    f"{GENRES} AS genres",
    f"{YEAR} AS year",
    f"{RUNTIME} AS runtime",
    f"CASE WHEN {RATED} THEN {VOTES} END AS num_votes",
    _unless_every(7, "(10 + o_custkey % 91) / 10D") + " AS director_avg_rating",
    _unless_every(19, "(o_custkey % 21) / 20D") + " AS director_hit_rate",
    f"CASE WHEN {RATED} THEN cast({RATING} AS double) END AS actual",
]
# The director a request names: a third of all name the same one, some none, some one nobody knows.
DIRECTOR_COLUMN = """CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 1
    ELSE o_custkey % 150 END AS director_id"""
# JSON requests as clients write them: with spaces, keys in any order, decimals, unknown keys,
# whole numbers as text. Of the others, by request_id: cut off, with text after the object, a
# list, a key given twice, a null, a year that is no number, or is a decimal number as text.
JSON_FIELDS = """concat_ws(', ',
      '"runtime" : ' || runtime, '"genres": "' || genres || '"', '"num_votes":' || num_votes,
      '"director_avg_rating":' || cast(director_avg_rating AS string), '"note": {"b": 1.0, "a": [1, 2]}',
      '"director_hit_rate": ' || cast(director_hit_rate AS string), '"year":"' || year || '"')"""
JSON_CASES = [
    (29, """'{"genres": "Drama"'"""), (31, """'{"genres": "Drama"} xyz'"""), (37, """'["genres"]'"""),
    (41, """'{"genres":"Drama","genres":"Comedy"}'"""), (43, """'{"genres": null, "year": 1999}'"""),
    (47, """'{"genres": "Drama", "year": "unknown"}'"""), (53, """'{"genres": "Drama", "year": "90.7"}'"""),
    (59, """'{"genres": "Drama", "runtime": null}'"""), (61, """'{ "year" : 1990.7 , "genres" : "War" }'"""),
    (67, """'{"genres": 7}'"""), (71, """'{}'"""),
]
JSON_TEXT = ("CASE " + " ".join(f"WHEN request_id % {n} = 0 THEN {text}" for n, text in JSON_CASES)
             + " ELSE '{ ' || " + JSON_FIELDS + " || '}' END")
JSON_COLUMNS = ["request_id", f"{JSON_TEXT} AS request"]
# Event times carry no zone; they are read as UTC whatever zone the session has.
METRIC_COLUMNS = [
    """timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts))
    AS ts""", "event_type AS job",
    "CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS completed",
    "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS failed",
    "value AS elapsed",
]


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").selectExpr(*TITLE_COLUMNS)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one priority stand for titles nobody has rated."""
    return load(spark, sf_dir, "orders").filter(RATED).selectExpr(*RATING_COLUMNS)


def credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").selectExpr(*CREDIT_COLUMNS)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").selectExpr(*REQUEST_COLUMNS)


def request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_stream(spark, sf_dir, "orders").selectExpr(*REQUEST_COLUMNS)


def directed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").selectExpr(*REQUEST_COLUMNS, DIRECTOR_COLUMN)


def directed_request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_stream(spark, sf_dir, "orders").selectExpr(*REQUEST_COLUMNS, DIRECTOR_COLUMN)


def request_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests(spark, sf_dir).selectExpr(*JSON_COLUMNS)


def job_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").selectExpr(*METRIC_COLUMNS)


def job_metrics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_stream(spark, sf_dir, "events").selectExpr(*METRIC_COLUMNS)


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job metrics with the id of each event."""
    return load(spark, sf_dir, "events").selectExpr("event_id", *METRIC_COLUMNS)

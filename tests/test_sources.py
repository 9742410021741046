import glob
import gzip
import json

import pytest
from pyspark.sql import functions as F

from marquee import vocabulary as V
from marquee.operators import cleaning
from marquee.sources import catalog, tables, tsv

HEADER = "\t".join(tsv.TITLE_COLUMNS)
LINES = [
    "tt1\tmovie\tPlain\tPlain\t0\t1999\t\\N\t100\tDrama,Crime",
    "tt2\tmovie\t\"Quoted\" start\tx\t0\t2000\t\\N\t\\N\t\\N",
    "tt3\tmovie\t\"Open quote only\tx\t0\t2001\t\\N\t90\tDrama",
    "tt4\tmovie\tNo year\tx\t0\t\\N\t\\N\t90\tDrama",
    "tt5\tmovie\tBad year\tx\t0\t19x9\t\\N\t90\tDrama",
    "tt6\tmovie\t\tx\t0\t1999\t\\N\t90\tDrama",
    "tt7\tmovie\tBack\\slash\tx\t0\t1999\t\\N\t90\tDrama",
]


@pytest.fixture()
def title_file(tmp_path):
    path = str(tmp_path / "title.basics.tsv.gz")
    with gzip.open(path, "wt") as f:
        f.write("\n".join([HEADER, *LINES]) + "\n")
    return path


def test_quotes_nulls_and_empty_fields(spark, title_file):
    df = tsv.read_tsv(spark, title_file, tsv.TITLE_COLUMNS)
    assert df.columns == [c.lower() for c in tsv.TITLE_COLUMNS]
    assert {kind for _, kind in df.dtypes} == {"string"}
    rows = {r.tconst: r for r in df.collect()}
    assert len(rows) == 7
    assert rows["tt2"].primarytitle == '"Quoted" start' and rows["tt2"].genres is None
    assert rows["tt3"].primarytitle == '"Open quote only' and rows["tt3"].genres == "Drama"
    assert rows["tt4"].startyear is None and rows["tt6"].primarytitle is None
    assert rows["tt7"].primarytitle == "Back\\slash"


def test_names_may_come_from_the_file(spark, title_file):
    assert "startyear" in tsv.read_tsv(spark, title_file).columns


def test_another_header_is_refused(spark, title_file):
    wrong = list(reversed(tsv.TITLE_COLUMNS))
    with pytest.raises(Exception, match="(?i)header"):
        tsv.read_tsv(spark, title_file, wrong).collect()


def test_rows_are_spread_out_only_when_asked(spark, title_file):
    plan = tsv.read_tsv(spark, title_file)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert tsv.read_tsv(spark, title_file, partitions=6).rdd.getNumPartitions() == 6


def test_plain_files_are_not_shuffled(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    plan = tsv.read_tsv(spark, str(path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_several_files_are_read_as_one(spark, title_file):
    assert tsv.read_tsv(spark, [title_file, title_file], tsv.TITLE_COLUMNS).count() == 14


def movies(spark, n):
    titles = spark.range(n).selectExpr(
        "concat('tt', id) AS tconst", "'movie' AS titletype", "concat('T', id) AS primarytitle",
        "sha2(cast(id AS string), 512) AS originaltitle",
        "CASE WHEN id % 3 = 0 THEN 1994 ELSE 1900 + id % 125 END AS startyear",
        "100 AS runtimeminutes", "'Drama' AS genres", "0 AS isadult").repartition(8)
    ratings = spark.range(n).selectExpr(
        "concat('tt', id) AS tconst", "6.0F AS averagerating", "100 AS numvotes")
    return cleaning.clean_titles(titles, ratings)


def test_cleaned_table_is_pruned_by_decade(spark, tmp_path):
    path = str(tmp_path / "cleaned")
    df = movies(spark, 500)
    tables.write_cleaned(df, path)
    tables.write_cleaned(df, path)  # overwrites
    back = tables.read_table(spark, path)
    assert sorted(back.select(df.columns).collect()) == sorted(df.collect())
    assert dict(back.dtypes)["decade"] == "int"
    plan = back.filter("decade >= 1990").select("averagerating")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(decade" in text
    assert "ReadSchema: struct<averagerating:float>" in text


def test_a_popular_decade_is_written_by_several_tasks(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "40KB")
    conf("spark.sql.shuffle.partitions", "64")
    path = str(tmp_path / "cleaned")
    tables.write_cleaned(movies(spark, 6000), path)
    files = {d: len(glob.glob(f"{path}/decade={d}/*.parquet")) for d in range(1900, 2030, 10)}
    assert files.pop(1990) > 1 == min(files.values())
    assert tables.read_table(spark, path).count() == 6000


def test_split_folders(spark, tmp_path):
    path = str(tmp_path / "split")
    df = spark.createDataFrame([(1, "train"), (2, "test"), (3, "train")], "id int, split string")
    tables.write_split(df, path)
    assert {r.id for r in spark.read.parquet(f"{path}/split=train").collect()} == {1, 3}


def test_training_csv_has_label_first_and_no_header(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(0.5, None, 7.5)], "b double, a int, target_rating float")
    tables.write_training_csv(df, path, ["a", "b"])
    text = "".join(open(p).read() for p in glob.glob(f"{path}/part-*.csv"))
    assert text == "7.5,0,0.5\n"


def test_sample_csv_keeps_quotes_and_commas(spark, tmp_path):
    path = str(tmp_path / "sample")
    df = spark.createDataFrame([("a,b", 'say "hi"', None)], "x string, y string, z int")
    tables.write_sample_csv(df, path)
    assert tables.read_sample_csv(spark, path, df.schema).collect() == df.collect()


def test_sample_csv_keeps_every_text(spark, tmp_path):
    path = str(tmp_path / "sample")
    texts = ["  lead", "trail  ", "", "line\nbreak", None, 'say "hi", a\\b', "cr\r\nlf", " ", '"', "#x", "\\"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    tables.write_sample_csv(df, path)
    assert tables.read_sample_csv(spark, path, df.schema).orderBy("id").collect() == df.collect()


def test_training_csv_per_split(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(0.5, None, 7.5, "train"), (1.5, 2, 8.0, "test")],
                               "b double, a int, target_rating float, split string")
    tables.write_split_csv(df, path, ["a", "b"])
    for split, line in (("train", "7.5,0,0.5\n"), ("test", "8.0,2,1.5\n")):
        assert "".join(open(p).read() for p in glob.glob(f"{path}/split={split}/part-*.csv")) == line


def test_stored_views_outlive_a_plan_and_are_pruned(spark, tmp_path):
    path = str(tmp_path / "cleaned")
    df = movies(spark, 300)
    tables.write_cleaned(df, path)
    catalog.register_stored(spark, path, "kept_cleaned", prefix="kept_")
    catalog.register_views(df, "plan_cleaned")
    names = {v.name for v in spark.catalog.listTables() if not v.isTemporary}
    assert {"kept_cleaned", *(f"kept_{v}" for v in catalog.VIEWS)} <= names
    for view in catalog.VIEWS:
        stored = spark.sql(f"SELECT * FROM kept_{view}")
        temporary = spark.table(view)
        assert sorted(map(str, stored.select(temporary.columns).collect())) == sorted(
            map(str, temporary.collect()))
        spark.catalog.dropTempView(view)
    plan = spark.sql("SELECT * FROM kept_v_decade_stats WHERE decade >= 1990")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(decade" in text
    catalog.register_stored(spark, path, "kept_cleaned", prefix="kept_")  # again


def test_record_is_one_json_line(spark, tmp_path):
    path = str(tmp_path / "metrics")
    tables.write_record(spark.createDataFrame([(0.5, 3)], "rmse double, n int"), path)
    (file,) = glob.glob(f"{path}/part-*.json")
    assert json.loads(open(file).read()) == {"rmse": 0.5, "n": 3}


def test_differing_schemas_are_merged(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "all/part=1"))
    spark.range(3).withColumn("more", F.lit("x")).write.parquet(str(tmp_path / "all/part=2"))
    df = tables.read_table(spark, str(tmp_path / "all"), merge=True)
    assert df.count() == 5 and df.filter("more IS NULL").count() == 2


def test_materialized_rows_have_no_lineage(spark):
    df = spark.range(100).filter("id % 2 = 0").withColumn("v", F.rand(1))
    stored = tables.materialize(df, "test")
    assert stored.columns == df.columns and sorted(stored.collect()) == sorted(df.collect())
    assert "Range" not in stored._jdf.queryExecution().executedPlan().toString()


def test_column_checks(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert tables.missing_columns(df, ["a", "c"]) == ["c"]
    assert tables.available_columns(df, ["b", "c"]).columns == ["b"]
    assert tables.only_missing(df, {"a": F.lit(9), "c": F.lit(3)}).first() == (1, 2, 3)


def test_genre_names_are_those_of_the_flags():
    assert V.GENRE_FLAGS[9] == "genre_sci_fi" and len(V.GENRE_FLAGS) == 15

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marquee.streaming import job_metrics, updates

START = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp, job string, completed int, failed int, elapsed double"


def rows(minutes, job="etl", failed=0):
    return [(START + dt.timedelta(minutes=m), job, 1 - failed, failed, float(m)) for m in minutes]


@pytest.fixture(scope="module")
def metrics(spark):
    data = rows([0, 1, 4, 5, 6, 1441]) + rows([2, 12], failed=1) + rows([3], "features")
    return spark.createDataFrame(data, SCHEMA)


def seconds(minutes):
    return int(START.replace(tzinfo=dt.timezone.utc).timestamp()) + 60 * minutes


def keyed(df):
    return {(r.window_start, r.job): r for r in df.collect()}


def test_five_minute_sums_and_averages(metrics):
    sums = keyed(job_metrics.task_sums(metrics))
    assert len(sums) == 5  # empty windows give no row
    first = sums[seconds(0), "etl"]
    assert (first.completed, first.failed) == (3, 1)
    averages = keyed(job_metrics.elapsed_average(metrics))
    assert averages[seconds(5), "etl"].avg_elapsed == 5.5


def test_daily_average_is_one_series(metrics):
    days = {r.window_start: r.avg_elapsed for r in job_metrics.daily_average(metrics).collect()}
    assert len(days) == 2 and days[seconds(1440)] == 1441.0


def test_alarms_need_a_failure(metrics):
    alarms = keyed(job_metrics.alarms(job_metrics.task_sums(metrics)))
    assert set(alarms) == {(seconds(0), "etl"), (seconds(10), "etl")}
    assert job_metrics.alarms(job_metrics.task_sums(metrics), threshold=2).count() == 0


def stream_of(spark, df, path, files):
    """Write ``df`` as several files and read them back one per micro-batch, oldest first."""
    for i, part in enumerate(files(df)):
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch_over_several_batches(spark, metrics, tmp_path):
    thirds = lambda df: [df.filter(F.pmod(F.hash("ts"), F.lit(3)) == i) for i in range(3)]
    stream = stream_of(spark, metrics, str(tmp_path / "in"), thirds)
    sums = job_metrics.task_sums(stream.withWatermark("ts", "30 days"))
    result = updates.run_updates(sums, ("window_start", "job"), "test")
    batch = job_metrics.task_sums(metrics)
    assert sorted(result.select(batch.columns).collect()) == sorted(batch.collect())


def test_rows_later_than_the_watermark_are_dropped(spark, tmp_path):
    path = str(tmp_path / "in")
    for part in ([1, 2], [600], [601], [3]):  # a watermark counts from the batch after next
        spark.createDataFrame(rows(part), SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    sums = job_metrics.task_sums(stream.withWatermark("ts", "10 minutes"))
    table = str(tmp_path / "late")
    assert updates.run_to_table(sums, table, allow_late=True) == 1
    result = keyed(updates.latest(spark, table, ("window_start", "job")))
    assert result[seconds(0), "etl"].completed == 2  # minute 3 came after minute 600
    assert result[seconds(600), "etl"].completed == 2
    with pytest.raises(updates.LateRowsDropped):
        updates.run_to_table(sums, str(tmp_path / "again"))


def test_a_replay_may_come_in_any_order(spark, tmp_path):
    path = str(tmp_path / "in")
    for part in ([600], [1, 2], [601], [3]):
        spark.createDataFrame(rows(part), SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stored = spark.read.schema(SCHEMA).parquet(path)
    assert updates.disorder(stored) == f"{600 * 60 + 1} seconds"
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    sums = job_metrics.task_sums(stream.withWatermark("ts", updates.disorder(stored)))
    result = keyed(updates.run_updates(sums, ("window_start", "job"), "test"))
    assert result[seconds(0), "etl"].completed == 3


def test_closed_windows_are_written_once(spark, tmp_path):
    path = str(tmp_path / "in")
    for part in ([1, 2], [3], [30], [31], [90]):
        spark.createDataFrame(rows(part), SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    sums = job_metrics.task_sums(stream.withWatermark("ts", "10 minutes"))
    closed = updates.run_rows(sums, "closed").collect()
    assert sorted((r.window_start, r.completed) for r in closed) == [(seconds(0), 3), (seconds(30), 2)]


def test_alarms_are_raised_within_the_stream(spark, metrics, tmp_path):
    stream = stream_of(spark, metrics, str(tmp_path / "in"), lambda df: [df])
    sums = job_metrics.task_sums(stream.withWatermark("ts", "30 days"))
    raised = keyed(updates.run_updates(job_metrics.alarms(sums), ("window_start", "job"), "alarms"))
    assert set(raised) == {(seconds(0), "etl"), (seconds(10), "etl")}


def test_a_table_belongs_to_its_checkpoint(spark, tmp_path):
    """A second run over the same table continues the first: nothing starts again at epoch 0."""
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    spark.createDataFrame(rows([1]), SCHEMA).coalesce(1).write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema(SCHEMA).parquet(source).withWatermark("ts", "1 day")
        updates.run_to_table(job_metrics.task_sums(stream), table)
    (row,) = updates.latest(spark, table, ("window_start", "job")).collect()
    assert row.completed == 1


def test_a_continued_stream_adds_to_its_table(spark, tmp_path):
    source, log = (str(tmp_path / n) for n in ("in", "log"))

    def arrive_and_run(minutes):
        new = spark.createDataFrame(rows(minutes), SCHEMA).coalesce(1)
        new.write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source).withWatermark("ts", "1 day")
        updates.run_to_table(job_metrics.task_sums(stream), log)
        return keyed(updates.latest(spark, log, ("window_start", "job")))

    assert arrive_and_run([1, 2])[seconds(0), "etl"].completed == 2
    assert arrive_and_run([3, 7])[seconds(0), "etl"].completed == 3


def test_a_repeated_batch_is_not_counted_twice(spark, tmp_path):
    log = str(tmp_path / "log")
    state = spark.createDataFrame([(0, "etl", 2)], "window_start int, job string, completed int")
    for epoch in (0, 1, 1):
        state.withColumn("completed", F.lit(epoch + 5)).write.mode("overwrite").parquet(
            f"{log}/epoch={epoch}")
    (row,) = updates.latest(spark, log, ("window_start", "job")).collect()
    assert row.completed == 6

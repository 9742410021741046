"""Alarms as states, replayed micro-batch by micro-batch."""

import random

import pytest
from pyspark.sql import functions as F

from marquee.session import scratch_path
from marquee.streaming import alarm_state, job_metrics, updates

START = 1_700_000_100  # a multiple of 300


def plain(rows, quiet, until):
    """Changes by job, one failure after the other."""
    out = []
    for job in sorted({j for j, _, _ in rows}):
        windows = sorted({s // 300 * 300 for j, s, failed in rows if j == job and failed})
        clear = None
        for w in (w for w in windows if w + 300 <= until):
            if clear is not None and w >= clear:
                out.append((job, clear, "cleared"))
                clear = None
            if clear is None:
                out.append((job, w, "raised"))
            clear = w + 300 + quiet
        if clear is not None and clear <= until:
            out.append((job, clear, "cleared"))
    return sorted(out)


def metrics_of(spark, rows):
    df = spark.createDataFrame(rows, "job string, second long, failed long")
    return df.select("job", F.timestamp_seconds("second").alias("ts"), "failed")


@pytest.mark.parametrize("seed", [1, 2])
def test_transitions_batch_and_stream(spark, seed):
    rng = random.Random(seed)
    second, rows = START, []
    for _ in range(240):
        second += rng.choice([5, 60, 400, 2500])
        rows.append((rng.choice("ab"), second, int(rng.random() < 0.4)))
    rows += [("quiet", START + 10, 1), ("fine", START + 20, 0)]
    metrics, quiet, delay = metrics_of(spark, rows), 1500, 120
    until = alarm_state.closed_until(metrics, delay)
    got = [tuple(r) for r in alarm_state.transitions(metrics, quiet, until).collect()]
    assert sorted(got) == plain(rows, quiet, until) and len(got) > 20

    path = scratch_path(spark, "files")
    for k in range(0, len(rows), 40):  # in order of time, as jobs send them
        metrics_of(spark, sorted(rows, key=lambda r: r[1])[k:k + 40]).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(metrics.schema).option("maxFilesPerTrigger", 1).parquet(path)
    found = updates.run_rows(alarm_state.transitions_stream(stream.withWatermark("ts", f"{delay} seconds"), quiet), "t")
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, quiet, until)


def test_events_without_failures_move_the_watermark(spark):
    metrics = metrics_of(spark, [("a", START, 1), ("a", START + 9000, 0), ("b", START + 9000, 0)])
    path = scratch_path(spark, "files")
    metrics.coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(metrics.schema).parquet(path).withWatermark("ts", "120 seconds")
    found = updates.run_rows(alarm_state.transitions_stream(stream, 1500), "t")
    assert sorted(tuple(r) for r in found.collect()) == [("a", START, "raised"), ("a", START + 1800, "cleared")]


def test_no_data_raises_and_clears_nothing_before_its_time(spark):
    one = metrics_of(spark, [("a", START, 1)])
    assert [tuple(r) for r in alarm_state.transitions(one, 600, START + 800).collect()] == [("a", START, "raised")]
    assert alarm_state.transitions(one, 600, START + 900).count() == 2
    assert alarm_state.transitions(one.limit(0), 600).count() == 0
    assert alarm_state.closed_until(one.limit(0), 5) == -5


def test_repeated_events_count_once_and_state_ends(spark):
    path = scratch_path(spark, "events")
    rows = [(k, "ab"[k % 2], START + 60 * k, 1, k % 3 == 0) for k in range(300)]
    events = spark.createDataFrame(rows, "event_id long, job string, second long, completed long, bad boolean").select(
        "event_id", "job", F.timestamp_seconds("second").alias("ts"), "completed", F.col("bad").cast("long").alias("failed"))
    for k in range(0, 300, 50):
        part = events.filter(f"event_id >= {k} and event_id < {k + 50}").coalesce(1)
        for _ in range(2):
            part.write.mode("append").parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    once = job_metrics.counted_once(stream.withWatermark("ts", "1 hour"), "event_id")
    kept, table = [], scratch_path(spark, "once")
    query = (once.writeStream.foreachBatch(lambda df, n: df.write.mode("append").parquet(table))
             .option("checkpointLocation", f"{table}-c").trigger(availableNow=True).start())
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(kept) <= 200 < 300 and len(kept) >= 12  # two delays and a file, not all events
    got, want = (sorted(tuple(r) for r in job_metrics.task_sums(df).collect()) for df in (spark.read.parquet(table), events))
    assert got == want
    assert job_metrics.counted_once(events.union(events), "event_id").count() == 300

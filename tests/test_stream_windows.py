import json
import os
import random
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from feed_records import rows
from pyspark.sql import functions as F

import pactline as p
from pactline.operators import sweep

NOON = datetime(2026, 1, 1, 12)
MINUTE = timedelta(minutes=1)


def arrivals(folder, files, first=0):
    """Files of (n, minute) that a stream takes in this order."""
    folder.mkdir(exist_ok=True)
    for i, held in enumerate(files, first):
        path = folder / f"{i:04d}.json"
        lines = [
            json.dumps({"n": n, "ts": None if m is None else str(NOON + m * MINUTE)}) for n, m in held
        ]
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def stream(spark, folder):
    return (
        spark.readStream.schema("n int, ts timestamp")
        .option("maxFilesPerTrigger", 1)
        .json(str(folder))
    )


def expected_split(files, delay):
    late, latest = [], None
    for held in files:
        for n, m in held:
            if m is not None and latest is not None and m <= latest - delay:
                late.append(n)
        latest = max([m for _, m in held if m is not None] + ([] if latest is None else [latest]))
    return sorted(late)


def test_split_keeps_every_row_over_restarts(spark, tmp_path):
    rng = random.Random(4)
    files = [
        [(100 * i + k, rng.choice([None, 10 * i - rng.randint(0, 60)])) for k in range(6)] + [(100 * i + 9, 10 * i)]
        for i in range(9)
    ]
    source, out = tmp_path / "in", str(tmp_path / "out")
    for first, part in ((0, files[:5]), (5, files[5:])):
        arrivals(source, part, first)
        p.split_late(stream(spark, source), out, "ts", 20 * MINUTE).awaitTermination()
    frame = stream(spark, source)
    late = sorted(r.n for r in p.late_side(spark, frame, out).collect())
    on_time = sorted(r.n for r in p.on_time_side(spark, frame, out).collect())
    assert late == expected_split(files, 20) and late
    assert sorted(late + on_time) == sorted(n for held in files for n, _ in held)
    log = p.split_log(spark, out).orderBy("batch_id").collect()
    assert [r.batch_id for r in log] == list(range(9))
    assert sum(r.late_rows for r in log) == len(late) and sum(r.rows for r in log) == 63
    assert log[0].watermark_us is None and log[-1].watermark_us == log[-2].latest_us - 1_200_000_000


def test_kept_late_rows_and_metrics_add_up(spark, tmp_path):
    rng = random.Random(8)
    files = [[(i, 10 * i - rng.randint(0, 45)) for _ in range(20)] for i in range(8)]
    arrivals(tmp_path / "in", files)
    events = stream(spark, tmp_path / "in").select(
        F.col("ts").alias("event_timestamp"), F.col("n").cast("bigint").alias("lag_us")
    )
    out = str(tmp_path / "out")
    query = p.sla_stream(events, out, timedelta(minutes=5), timedelta(minutes=10), keep_late=True)
    query.awaitTermination()
    assert p.late_rows(query) == 0
    timed = p.closed_window_times(events, "event_timestamp", timedelta(minutes=5))
    late = p.late_side(spark, timed, out)
    closed = spark.read.parquet(f"{out}/metrics").select("window_end", "total_events")
    held = p.on_time_side(spark, timed, out).groupBy("window_end").count()
    open_ = held.join(closed, "window_end", "left_anti").agg(F.sum("count")).first()[0]
    emitted = closed.agg(F.sum("total_events")).first()[0]
    minutes = [m for held in files for _, m in held]
    copies = len(minutes) + sum(m % 5 == 0 for m in minutes)
    assert late.count() + emitted + open_ == copies and late.count() > 0
    assert rows(held.join(closed, "window_end").where("count <> total_events")) == []


def test_stream_of_events_and_batches_equals_tumbling_metrics(spark, tmp_path):
    rng = random.Random(6)
    data = [(NOON + timedelta(seconds=rng.randrange(0, 7200, 30)), rng.randint(0, 9_000_000)) for _ in range(300)]
    begun = [(NOON + timedelta(seconds=rng.randrange(0, 6000, 60)),) for _ in range(40)]
    events = spark.createDataFrame(data, "event_timestamp timestamp, lag_us bigint")
    batches = spark.createDataFrame(begun, "batch_start timestamp")
    events.repartition(4).write.parquet(str(tmp_path / "e"))
    batches.repartition(2).write.parquet(str(tmp_path / "b"))
    width, delay = timedelta(minutes=5), timedelta(minutes=10)
    p.sla_stream(
        spark.readStream.schema(events.schema).parquet(str(tmp_path / "e")),
        str(tmp_path / "out"), width, delay,
        batches=spark.readStream.schema(batches.schema).parquet(str(tmp_path / "b")),
    ).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out" / "metrics")).drop("batch_id")
    end = min(max(t for t, _ in data), max(t for (t,) in begun)) - delay
    wanted = p.tumbling_metrics(events, batches, width).where(F.col("window_end") <= F.lit(end))
    assert rows(found.select(*wanted.columns)) == rows(wanted) and found.count() > 10


def test_late_rows_does_not_guess(spark):
    gone = SimpleNamespace(recentProgress=[{"stateOperators": []}] * 100)
    with pytest.raises(RuntimeError):
        p.late_rows(gone)


@pytest.mark.parametrize("size", [1, 2, 3, 8, 17, 100])
def test_cover_is_exact_and_small(size):
    for first in range(size):
        for stop in range(first + 1, size + 1):
            nodes = sweep._cover(first, stop)
            held = sorted(x for lv, n in nodes for x in range(n << lv, (n + 1) << lv))
            assert held == list(range(first, stop)) and len(nodes) <= 2 * size.bit_length()


@pytest.mark.parametrize("cuts", [[5], [0, 1], [-7, 0, 3, 4, 1000], list(range(0, 90, 7))])
def test_every_row_falls_into_one_segment(spark, cuts):
    found = sweep.in_segments(spark.range(-20, 120).select(F.col("id").alias("_at"), "id"), cuts)
    wanted = [
        (i, n) for i in range(-20, 120) for n, (a, b) in enumerate(zip(cuts, cuts[1:])) if a <= i < b
    ]
    assert sorted((r.id, r._node) for r in found.collect()) == sorted(wanted)


def test_ten_thousand_windows_count_each_event_once(spark):
    lags = spark.range(2000).select((F.col("id") * 1_800_000).alias("_at"), "id")
    cuts = sorted({t for n in range(10_000) for t in (n * 180_000, n * 180_000 + 1_800_000_001)})
    assert sweep.in_segments(lags, cuts).count() <= 2000


def test_windows_with_wide_and_negative_lags(spark):
    lags = [-(10**15), -1, 0, 1, 10**6, 10**15, 10**15 + 1, 5]
    events = spark.createDataFrame(
        [(NOON + i * MINUTE, x) for i, x in enumerate(lags)], "event_timestamp timestamp, lag_us bigint"
    )
    spans = [(NOON + a * MINUTE, NOON + b * MINUTE) for a in range(8) for b in range(a, 8)]
    batches = spark.createDataFrame([], "batch_start timestamp")
    for r in p.window_metrics(events, batches, spans).collect():
        held = sorted(lags[i] for i in range(8) if r.window_start <= NOON + i * MINUTE <= r.window_end)
        n = len(held)
        assert (r.total_events, r.p50_lag_ms, r.p99_lag_ms, r.max_lag_ms) == (
            n, held[n // 2] / 1000, held[int(n * 0.99)] / 1000, held[-1] / 1000
        )


@pytest.mark.parametrize("shape", ["even", "steps", "heavy", "same", "negative"])
def test_sketch_ranks_are_within_the_bound(spark, tmp_path, shape):
    n, k = 6000, 128
    lag = {
        "even": F.col("id"),
        "steps": F.col("id") % 7,
        "heavy": F.expr("cast(exp(id / 400.0) as bigint)"),
        "same": F.lit(5).cast("bigint"),
        "negative": -F.col("id") * F.col("id"),
    }[shape]
    at = F.timestamp_seconds(F.lit(1_700_000_130) + F.col("id") % 60).alias("event_timestamp")
    made = spark.range(n).select(at, (lag * 1000).alias("lag_us"))
    end = spark.range(1).select(
        F.timestamp_seconds(F.lit(1_700_010_000)).alias("event_timestamp"), F.lit(0).cast("bigint").alias("lag_us")
    )
    made.union(end).repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(made.schema).parquet(str(tmp_path / "in"))
    p.sla_sketch_stream(stream, str(tmp_path / "out"), k=k).awaitTermination()
    (row,) = spark.read.parquet(str(tmp_path / "out" / "metrics")).collect()
    lags = sorted(r[0] / 1000 for r in made.select("lag_us").collect())
    assert (row.total_events, row.max_lag_ms) == (n, lags[-1])
    for part, found in ((0.5, row.p50_lag_ms), (0.99, row.p99_lag_ms)):
        room = 3 * p.rank_error(k) * n + 1
        assert sum(x < found for x in lags) - room <= part * n <= sum(x <= found for x in lags) + room

import random
from datetime import datetime, timedelta

import pytest
from feed_records import rows
from pyspark.sql import functions as F

import pactline as p
from pactline import session
from pactline.operators import ranks, sla, sweep

NOON = datetime(2025, 8, 23, 12)
EVENT = "event_id string, event_timestamp timestamp, ingestion_timestamp timestamp"
BATCH = "batch_id string, batch_start timestamp, batch_end timestamp, event_count bigint"


def events(spark, lags, step=timedelta(seconds=1), schema=EVENT):
    data = [
        (str(i), NOON + i * step, NOON + i * step + timedelta(milliseconds=lag))
        for i, lag in enumerate(lags)
    ]
    return p.with_lag(spark.createDataFrame(data, schema))


def batches(spark, seconds=2, count=100):
    return spark.createDataFrame([("b", NOON, NOON + timedelta(seconds=seconds), count)], BATCH)


def test_percentile_is_the_element_at_the_floor(spark):
    row = p.lag_summary(events(spark, [500, 100, 400, 200, 300]), sla_ms=500).head()
    assert (row.avg_lag_ms, row.max_lag_ms, row.p50_lag_ms, row.p99_lag_ms) == (300, 500, 300, 500)
    assert (row.sla_violations, row.sla_violation_rate) == (0, 0.0)
    four = p.lag_percentiles(events(spark, [1, 2, 3, 4])).head()
    assert four.p50_lag_ms == 3.0


def test_lags_whose_sum_is_no_bigint(spark):
    """Five years each, so that some 60,000 of them leave the range of a long."""
    lag, n = 5 * 365 * 86_400 * 10**6, 100_000
    df = spark.range(n).select(F.lit(lag).cast("bigint").alias("lag_us"))
    row = p.lag_summary(df).head()
    assert (row.total_events, row.avg_lag_ms, row.max_lag_ms) == (n, lag / 1000, lag / 1000)
    weighted = spark.createDataFrame([(lag, n), (-lag, 1)], "lag_us bigint, times bigint")
    row = p.lag_summary(weighted, weight="times").head()
    assert (row.total_events, row.avg_lag_ms) == (n + 1, lag * (n - 1) / (n + 1) / 1000)
    at = df.withColumn("event_timestamp", F.lit(NOON))
    hour = timedelta(hours=1)
    windows = p.window_metrics(at, batches(spark), [(NOON, NOON + hour)]).head()
    assert (windows.total_events, windows.avg_lag_ms) == (n, lag / 1000)


def test_windows_meet_few_counts_in_many_tasks(spark, capsys):
    """A window's node comes with some counts, not with thousands, nor all in one task."""
    windows = [(NOON, NOON + timedelta(seconds=n)) for n in range(1, 40)]
    p.window_metrics(events(spark, range(40)), batches(spark), windows).explain()
    assert "REPARTITION_BY_NUM" in capsys.readouterr().out
    assert 1 << sweep.DIGIT <= 64


def test_violations_are_strict(spark):
    row = p.sla_violations(events(spark, [500, 1500, 2000, 900, 1000]), sla_ms=1000).head()
    assert (row.sla_violations, row.sla_violation_rate) == (2, 0.4)


@pytest.mark.parametrize("limit", [session.BROADCAST_ROWS, 0])
def test_ranks_against_sorting(spark, monkeypatch, limit):
    """Both ways of meeting the targets; one group holds most rows, one is null."""
    monkeypatch.setattr(session, "BROADCAST_ROWS", limit)
    rng = random.Random(4)
    groups = {"hot": 3000, "mild": 200, "one": 1, None: 77}
    data = [
        (g, rng.choice([rng.randint(-9, 9), rng.randint(-(10**7), 10**8), rng.randint(0, 10**13)]))
        for g, n in groups.items()
        for _ in range(n)
    ]
    df = spark.createDataFrame(data, "g string, v bigint").repartition(7)
    found = ranks.with_ranks(df, ["g"], "v", {"a": 0.0, "b": 0.5, "c": 0.99})
    for row in found.collect():
        ordered = sorted(v for g, v in data if g == row.g)
        wanted = [ordered[int(len(ordered) * q)] for q in (0.0, 0.5, 0.99)]
        assert [row.a, row.b, row.c] == wanted and row.n == len(ordered)
    assert found.count() == 4


def test_weighted_ranks_equal_repeated_rows(spark):
    df = spark.createDataFrame([(i, 1 + i % 3) for i in range(50)], "v bigint, w bigint")
    many = df.select("v", F.explode(F.sequence(F.lit(1), "w")).alias("i"))
    a = ranks.with_ranks(df, [], "v", {"m": 0.5, "h": 0.99}, weight="w")
    b = ranks.with_ranks(many, [], "v", {"m": 0.5, "h": 0.99})
    assert rows(a) == rows(b)


def test_window_metrics(spark):
    e = events(spark, [100, 200, 300, 400, 500])
    windows = [
        (NOON, NOON + timedelta(seconds=10)),
        (NOON + timedelta(hours=1), NOON + timedelta(hours=2)),
        (NOON, NOON + timedelta(seconds=2)),
        (NOON + timedelta(seconds=2), NOON + timedelta(seconds=2)),
    ]
    found = {r.window_end: r for r in p.window_metrics(e, batches(spark), windows, 500).collect()
             if r.window_end != windows[2][1] or r.window_start == NOON}
    first = found[windows[0][1]]
    assert (first.total_events, first.total_batches, first.sla_violations) == (5, 1, 0)
    assert (first.throughput_events_per_sec, first.throughput_batches_per_sec) == (0.5, 0.1)
    empty = found[windows[1][1]]
    assert tuple(empty)[2:] == (0, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0, 0.0)
    assert found[windows[2][1]].total_events == 3


def test_ways_of_meeting_windows_agree(spark, monkeypatch):
    rng = random.Random(3)
    e = events(spark, [rng.randint(0, 9000) for _ in range(400)])
    b = batches(spark)
    windows = [
        (NOON + timedelta(seconds=s), NOON + timedelta(seconds=s + n))
        for s, n in ((rng.randint(-50, 400), rng.choice([0, 1, 7, 60, 900])) for _ in range(25))
    ]
    small = rows(p.window_metrics(e, b, windows))
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(sla, "BROADCAST_ROWS", 0)
    assert rows(p.window_metrics(e, b, windows)) == small
    for row in small:
        held = [i for i in range(400) if row[0] <= NOON + timedelta(seconds=i) <= row[1]]
        assert row[2] == len(held)


def test_window_without_events_has_no_batches(spark):
    later = NOON - timedelta(hours=3)
    b = spark.createDataFrame([("b", later, later, 1)], BATCH)
    found = p.window_metrics(events(spark, [1]), b, [(later, later + timedelta(hours=1))]).head()
    assert found.total_batches == 0


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_tumbling_windows_share_their_boundary(spark, zone):
    schema = EVENT.replace("timestamp timestamp", "timestamp timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        e = events(spark, [100, 200, 300, 400, 500], schema=schema)
        found = p.tumbling_metrics(e, batches(spark).limit(0), timedelta(seconds=2), 300)
        got = [(r.window_start, r.total_events, r.sla_violations)
               for r in found.orderBy("window_start").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [
        (NOON - timedelta(seconds=2), 1, 0), (NOON, 3, 0),
        (NOON + timedelta(seconds=2), 3, 2), (NOON + timedelta(seconds=4), 1, 1),
    ]


def test_lag_ignores_clock_changes(spark):
    """Local times on both sides of a clock change of the session time zone."""
    data = [(datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 3, 30))]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(data, "a timestamp_ntz, b timestamp_ntz")
        assert p.with_lag(df, "a", "b").head().lag_ms == 7_200_000.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_batches_and_run_summary(spark):
    row = p.batch_throughput(batches(spark)).head()
    assert (row.duration_sec, row.throughput_events_per_sec) == (2.0, 50.0)
    assert p.batch_throughput(batches(spark, 0)).head().throughput_events_per_sec == 0.0
    log = "rows_read bigint, rows_written bigint, status string"
    done = spark.createDataFrame([(100, 100, "success"), (0, 0, "failed")], log)
    assert tuple(p.run_summary(done).head()) == (2, 100, 100, 1, 1, 50.0)
    assert tuple(p.run_summary(done.limit(0)).head()) == (0, 0, 0, 0, 0, 0.0)


def test_report_rounding(spark):
    df = spark.createDataFrame([(123.456, 0.12345)], "avg_lag_ms double, sla_violation_rate double")
    assert tuple(p.rounded(df).head()) == (123.46, 0.1234)


def test_histogram_edges(spark):
    found = p.latency_histogram(events(spark, [-5, 0, 99, 100, 250]), [0, 100])
    assert rows(found) == [(0.0, 100.0, 2), (100.0, None, 2), (None, 0.0, 1)]


def test_sketch_percentiles_are_close(spark):
    df = spark.range(10_000).select((F.col("id") * 1000).alias("lag_us"))
    row = p.approx_lag_percentiles(df).head()
    assert abs(row.p50_lag_ms - 5000) <= 2 and abs(row.p99_lag_ms - 9900) <= 2


@pytest.mark.parametrize("limit", [session.BROADCAST_ROWS, 0])
def test_late_flag_follows_earlier_batches(spark, monkeypatch, limit):
    from pactline.operators import late

    monkeypatch.setattr(session, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(late, "BLOCK", 3)
    rng = random.Random(9)
    data = [(i, i // 5, rng.choice("ab"), NOON + timedelta(minutes=rng.randint(0, 600) + i))
            for i in range(120)]
    df = spark.createDataFrame(data, "n int, batch int, s string, ts timestamp")
    marked = p.with_late_flag(df, "ts", "batch", ["s"], timedelta(minutes=90))
    wanted = []
    for n, batch, s, ts in data:
        seen = [t for _, b, s2, t in data if s2 == s and b < batch]
        if seen and ts < max(seen) - timedelta(minutes=90):
            wanted.append(n)
    assert sorted(r.n for r in marked.where("is_late").collect()) == wanted and wanted


@pytest.mark.parametrize("limit", [session.BROADCAST_ROWS, 0])
def test_keep_first(spark, monkeypatch, limit):
    monkeypatch.setattr(session, "BROADCAST_ROWS", limit)
    data = [(i, None if i % 7 == 0 else "same" if i % 3 else f"t{i % 30}", i % 2) for i in range(200)]
    df = spark.createDataFrame(data, "id int, text string, lang int").repartition(5)
    first = {}
    for i, *content in data:
        first.setdefault(tuple(content), i)
    assert rows(p.keep_first(df, ["text", "lang"], "id"), "id") == rows(
        spark.createDataFrame([(i,) for i in first.values()], "id int")
    )
    unique = df.limit(0)
    assert p.keep_first(unique, ["text"], "id").count() == 0

import json
import os
import random
from datetime import datetime, timedelta

from feed_records import call, drifted, reading, rows
from pyspark.sql import functions as F

import pactline as p
from workload import contract_queries, source_queries

NOON = datetime(2026, 1, 1, 12)


def numbered_file(folder, i, lines):
    folder.mkdir(exist_ok=True)
    path = folder / f"{i:04d}.txt"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def test_cumulative_report_equals_the_batch_report(spark, tmp_path, contracts):
    files = [
        [json.dumps(r) for r in drifted()],
        ["not json", "[1]", "  ", json.dumps(call(20)), json.dumps(reading(9))],
        [json.dumps(call(20)), json.dumps(reading(9)), json.dumps(call(21, status=None))],
        ["   "],
        [json.dumps(call(n)) for n in range(30, 40)],
    ]
    chosen, out = list(contracts.values()), str(tmp_path / "out")
    for part in (files[:3], files[3:]):
        for lines in part:
            numbered_file(tmp_path / "in", files.index(lines), lines)
        stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
        p.contract_watch(stream, chosen, out, observed_max_lag_ms=6000).awaitTermination()
    reports = spark.read.parquet(f"{out}/report")
    for n in range(len(files)):
        lines = [(x,) for part in files[: n + 1] for x in part]
        records = p.raw_records(spark.createDataFrame(lines, "value string"))
        wanted = p.contract_report(records, chosen, observed_max_lag_ms=6000)
        assert rows(reports.where(F.col("batch_id") == n).drop("batch_id")) == rows(wanted)


def test_value_that_comes_back_much_later_is_a_duplicate(spark, tmp_path):
    contract = p.Contract(
        "c", "v1", "c", (p.Field("id", "integer"),), (p.Rule("id", allow_duplicates=False),)
    )
    for i in range(6):
        numbered_file(tmp_path / "in", i, [json.dumps({"id": 1 if i in (0, 4) else 10 + i})])
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
    p.contract_watch(stream, contract, str(tmp_path / "out")).awaitTermination()
    reports = spark.read.parquet(str(tmp_path / "out" / "report")).orderBy("batch_id").collect()
    assert [r.is_valid for r in reports] == [True] * 4 + [False] * 2
    # What is carried from batch to batch holds no keys.
    known = spark.read.parquet(str(tmp_path / "out" / "known" / "5"))
    assert rows(known, "rule_id", "records") == [(-1, 6), (0, 2)]


def test_every_key_is_delivered_once_however_late(spark, tmp_path):
    rng, out, keys = random.Random(5), str(tmp_path / "out"), set()
    schema = "id int, other string, ts timestamp"
    for run in range(3):
        for i in range(4):
            lines = []
            for _ in range(25):
                hour = rng.randint(0, 10 * (4 * run + i) + 5)
                key = rng.choice([None, hour * 10 + rng.randint(0, 4)])
                keys.add((key, "x" if hour % 2 else None, hour))
                lines.append(json.dumps(
                    {"id": key, "other": "x" if hour % 2 else None,
                     "ts": str(NOON + timedelta(hours=hour))}))
            numbered_file(tmp_path / "in", 4 * run + i, lines)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
        events = stream.json(str(tmp_path / "in"))
        named = ["id", "other", "ts"]
        p.dedupe_all(events, named, "ts", timedelta(hours=3), out).awaitTermination()
    found = spark.read.parquet(f"{out}/rows")
    got = sorted(((r.id, r.other, r.ts) for r in found.collect()), key=str)
    assert got == sorted(((k, o, NOON + timedelta(hours=h)) for k, o, h in keys), key=str)
    assert found.where("kind = 'late'").count() > 10


def made_events(spark, tmp_path, n=70):
    """A table of events, 25 minutes apart, with the columns of the test tables."""
    events = spark.range(n).select(
        F.col("id").alias("event_id"),
        (F.lit(NOON) + F.make_dt_interval(mins=(F.col("id") * 25).cast("int")))
        .cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.when(F.col("id") % 2 == 0, "click").otherwise("buy").alias("event_type"),
        (F.col("id") / 4).alias("value"),
        F.concat(F.lit('{"k": '), "id", F.lit("}")).alias("props"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    return events


def test_larger_feed_has_more_micro_batches(spark, tmp_path, monkeypatch):
    """Files of a size, and no task that holds the counts of all shuffle partitions."""
    made_events(spark, tmp_path)
    monkeypatch.setattr(source_queries, "FILE_LINES", 5)
    frame, joined = type(spark.range(1)), []
    old = frame.coalesce

    def coalesce(self, n):
        joined.append(self.rdd.getNumPartitions())
        return old(self, n)

    monkeypatch.setattr(frame, "coalesce", coalesce)
    found = source_queries.stream_contract_cumulative(spark, str(tmp_path))
    assert len(joined) == 4 and max(joined) == 1  # 14 files, 4 at a time
    assert rows(found) == rows(contract_queries.contract_report_all(spark, str(tmp_path)))


def test_large_micro_batch_of_late_rows_has_several_files(spark, tmp_path, monkeypatch):
    events = made_events(spark, tmp_path)
    monkeypatch.setattr(source_queries, "MICRO_BATCHES", 3)
    monkeypatch.setattr(source_queries, "FILE_ROWS", 6)
    found = source_queries.stream_late_rows(spark, str(tmp_path)).collect()
    folder = spark.conf.get("spark.checkpoint.dir")
    files = [
        len([f for f in names if f.endswith(".parquet")])
        for place, _, names in os.walk(folder)
        if place.endswith("/events") and os.path.basename(os.path.dirname(place)).startswith("late-")
    ]
    assert files == [12]  # 70 rows, 3 micro-batches, 4 files each
    # Hours are closed at both ends: an event on one counts twice.
    on_hours = sum(n % 97 == 0 or n * 25 % 60 == 0 for n in range(events.count()))
    assert sum(r.events for r in found) == events.count() + on_hours
    assert not any(r.many_batches for r in found)

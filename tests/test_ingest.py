import json
import time
from datetime import datetime, timedelta

import pytest
from feed_records import call, drifted, reading, rows
from pyspark.sql import functions as F

import pactline as p
from pactline.sources import envelope
from workload import loss_queries


def test_infer_schema(spark, jsonl):
    ddl = p.infer_schema(spark, jsonl([{"a": 1, "b": "x", "c": 1.5}, {"a": "no"}]))
    assert ddl == "STRUCT<a: BIGINT, b: STRING, c: DOUBLE>"
    for text in ("", "{broken"):
        with pytest.raises(p.InputError):
            p.infer_schema(spark, jsonl([text], "bad.jsonl"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        p.infer_schema(spark, "/nowhere.jsonl")


def test_read_keeps_the_line(spark, jsonl):
    path = jsonl([{"a": 1}, {"a": "x"}, "", {"b": 2}])
    assert rows(p.read_with_schema(spark, path, raw="line")) == sorted(
        [(1, '{"a": 1}'), (None, '{"a": "x"}'), (None, '{"b": 2}')], key=str
    )


def test_ingest_batch(spark, jsonl, tmp_path):
    path, target = jsonl([call(i) for i in range(8)]), str(tmp_path / "out")
    good = p.ingest_batch(spark, path, target, 0)
    assert (good.batch_id, good.rows_read, good.rows_written, good.status) == (
        "batch_0", 8, 8, "success")
    assert good.schema_fields == 10
    again = p.ingest_batch(spark, path, target, 0)
    assert spark.read.json(target + "_bronze_batch_0").count() == again.rows_written == 8
    bad = p.ingest_batch(spark, path + "x", target)
    assert (bad.batch_id, bad.status, bad.rows_read) == ("ad_hoc", "failed", 0)
    assert "PATH_NOT_FOUND" in bad.error_message
    summary = p.run_summary(p.ingest_log(spark, [good, again, bad])).head()
    assert (summary.total_batches, summary.failed_batches) == (3, 1)


def test_writer(spark, tmp_path):
    path = str(tmp_path / "bronze")
    df = p.enrich(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"))
    for times in (1, 2):
        done = p.write_bronze(df, p.BronzeSink(path))
        assert (done["rows_written"], done["status"]) == (2, "success")
        assert spark.read.text(path).count() == 2 * times
    assert '"b":null' in "".join(r.value for r in spark.read.text(path).collect())
    with pytest.raises(ValueError):
        p.BronzeSink(path, mode="cloud")
    failed = p.write_bronze(df, p.BronzeSink(path, mode="delta"))
    assert failed["status"] == "failed" and failed["error"]


def test_empty_write_counts_zero(spark, tmp_path):
    none = spark.createDataFrame([], "a int")
    assert p.write_bronze(none, p.BronzeSink(str(tmp_path / "b")))["rows_written"] == 0
    assert p.materialize(none.where("a > 1"), "none").rows == 0


def test_envelopes_keep_the_event(spark, tmp_path):
    events = ['{"a": 1.0, "b": null}', '  {"a": 354.05, "c": [1, {"d": "é"}]} ', "", '{"a": 3}']
    lines = spark.createDataFrame([(e,) for e in events], "value string")
    topic = str(tmp_path / "topic")
    envelope.publish(lines, topic, "calls", 'a "b"')
    back = envelope.unwrap(spark.read.text(topic)).collect()
    assert {(r.topic, r.client_id) for r in back} == {("calls", 'a "b"')}
    got = sorted(json.dumps(json.loads(r.value), sort_keys=True) for r in back)
    assert got == sorted(json.dumps(json.loads(e), sort_keys=True) for e in events if e.strip())
    contract = p.Contract("c", "v", "d", (p.Field("a", "float"), p.Field("b", "string")))
    profile = p.type_profile(p.raw_records(spark.createDataFrame(back)), contract)
    assert ("d", "a", "float", 2) in rows(profile) and ("d", "b", "null", 1) in rows(profile)
    few = str(tmp_path / "few")
    envelope.publish(lines.where("value <> ''"), few, max_records=2)
    assert spark.read.text(few).count() == 2
    with pytest.raises(p.InputError):
        envelope.wrap_lines(lines, topic=" ")
    assert tuple(envelope.publish_stats(lines).head()) == (3, 3, 0)


def test_bronze_stream(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    schema = "event_id string, event_time timestamp"
    for i, day in enumerate((1, 5, 2)):
        line = json.dumps({"event_id": f"e{i}", "event_time": f"2026-01-0{day}T00:00:00Z"})
        wrapped = f'{{"topic": "t", "client_id": "c", "event": {line}}}'
        (source / f"{i}.jsonl").write_text(wrapped + "\n")
        # One file per run: each run is a batch, and restarts from its checkpoint.
        lines = spark.readStream.text(str(source))
        p.bronze_stream(lines, schema, out, "event_time", enveloped=True).awaitTermination()
    got = spark.read.parquet(out + "/rows")
    assert rows(got, "event_id", "is_late", "batch_id") == [
        ("e0", False, 0), ("e1", False, 1), ("e2", True, 2)]
    log = spark.read.parquet(out + "/log")
    assert rows(log, "batch_id", "rows_read", "late_rows")[2][1:] == (1, 1)
    assert p.run_summary(log).head().successful_batches == 3


def test_contract_stream_equals_batch(spark, contracts, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    stray = ["", "{broken", json.dumps({"source": "other"})]
    lines = [json.dumps(r) for r in drifted()] + stray
    (source / "a.jsonl").write_text("\n".join(lines) + "\n")
    stream = spark.readStream.text(str(source))
    p.contract_stream(stream, contracts.values(), out).awaitTermination()
    split = spark.read.parquet(out + "/rows").groupBy("status").count()
    assert dict(rows(split)) == {"valid": 17, "quarantine": 4, "unmatched": 1}
    told = spark.read.parquet(out + "/report").drop("batch_id")
    batch = p.contract_report(p.read_jsonl(spark, str(source)), contracts.values())
    assert rows(told) == rows(batch)


def test_contract_stream_can_fail(spark, contracts, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.jsonl").write_text(json.dumps(call(1, status=3)) + "\n")
    stream = spark.readStream.text(str(source))
    query = p.contract_stream(stream, contracts.values(), str(tmp_path / "out"), True)
    with pytest.raises(Exception, match="contract not met"):
        query.awaitTermination()


def test_sla_stream_equals_batch(spark, tmp_path):
    noon = datetime(2025, 8, 23, 12)
    data = [(noon + timedelta(seconds=i), (i * 7919) % 6000 * 1000) for i in range(3600)]
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame(data, "event_timestamp timestamp, lag_us bigint").repartition(6)
    df.write.parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 3).parquet(path)
    p.sla_stream(stream, out, delay=timedelta(hours=2)).awaitTermination()
    assert spark.read.parquet(out + "/metrics").count() == 0
    more = spark.createDataFrame([(noon + timedelta(days=1), 0)], df.schema)
    more.write.mode("append").parquet(path)
    p.sla_stream(stream, out, delay=timedelta(hours=2)).awaitTermination()
    got = spark.read.parquet(out + "/metrics")
    none = spark.createDataFrame([], "batch_start timestamp")
    batch = p.tumbling_metrics(df, none).withColumnRenamed("throughput_events_per_sec", "eps")
    shared = [c for c in got.columns if c in batch.columns]
    assert rows(got, *shared) == rows(batch, *shared) and got.count() == 13


def test_dedupe_stream(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.range(300).select(
        (F.col("id") % 100).alias("event_id"),
        F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000).alias("ts"),
    )
    df.repartition(5).write.parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path)
    p.dedupe_stream(stream, ["event_id"], "ts", timedelta(days=1), out).awaitTermination()
    assert spark.read.parquet(out + "/rows").count() == 100


def test_late_stream_rows_are_counted(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    found = []
    for days, ids in ((10, 5), (0, 3), (20, 4)):
        df = spark.range(ids).select(
            (F.col("id") + 100 * days).alias("event_id"),
            F.timestamp_seconds(F.lit(1_700_000_000 + days * 86_400)).alias("ts"),
        )
        df.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(df.schema).parquet(path)
        query = p.dedupe_stream(stream, ["event_id"], "ts", timedelta(days=1), out)
        query.awaitTermination()
        found.append(p.late_rows(query))
    assert found == [0, 3, 0]
    assert spark.read.parquet(out + "/rows").count() == 9


def test_union_sources(spark):
    both = p.union_sources(
        spark.createDataFrame([(1, "x")], "a int, b string"),
        spark.createDataFrame([(2, 0.5)], "a int, c double"),
    )
    assert rows(both) == [(1, "x", None), (2, None, 0.5)]
    assert reading(1)["source"] == "metrics-simulator"


def test_schema_of_all_records(spark, jsonl):
    path = jsonl([
        {"a": 1, "b": "x", "c": {"k": 1}, "n": None}, {"a": 1.5, "b": None, "c": {"z": [1]}},
        {"a": 2, "d": True, "odd `name`": "y"}, {}, "not json", "[1]", "  ",
        {"b": 3, "c": {"k": 2}},
    ])
    fields = p.field_schema(p.read_jsonl(spark, path))
    found = {r.field: r for r in fields.collect()}
    assert {r.records for r in found.values()} == {5}
    assert (found["b"].type, found["b"].kinds) == ("VARIANT", ["int", "null", "str"])
    assert found["a"].present == 3 and found["a"].type.startswith("DECIMAL")
    assert (found["n"].type, found["n"].nulls, found["d"].present) == ("VOID", 1, 1)
    read = p.read_with_schema(spark, path, p.infer_merged_schema(spark, path))
    rows_ = [r for r in read.collect() if r.a is not None]
    assert sorted(float(r.a) for r in rows_) == [1.0, 1.5, 2.0]
    assert [r["odd `name`"] for r in rows_ if r.d] == ["y"]
    assert sorted((r.c.k or 0, r.c.z or []) for r in read.collect() if r.c) == [
        (0, [1]), (1, []), (2, [])]
    with pytest.raises(p.InputError):
        p.infer_merged_schema(spark, path, most=2)


def test_publish_limit_counts_broken_lines(spark, tmp_path):
    path = str(tmp_path / "topic")
    lines = ["{bad", '{"a": 1}', "bad", "", '{"a": 2}', '{"a": 3}', "bad too"]
    frame = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    assert envelope.publish(frame, path, max_records=2) == {
        "attempted": 4, "published": 2, "failed": 2}
    assert rows(spark.read.text(path + "_rejected")) == [("bad",), ("{bad",)]
    spread_out = frame.union(frame).repartition(3)
    counted = envelope.publish(spread_out, str(tmp_path / "more"), max_records=5)
    assert counted["published"] == 5 and spark.read.text(str(tmp_path / "more")).count() == 5
    assert envelope.publish(frame, str(tmp_path / "all"), max_records=99)["attempted"] == 6


def test_event_of_an_envelope_with_separators_and_a_long_topic(spark, tmp_path):
    event = '{"a": 1.10, "t": "x\u2028y\x85z"}'
    frame = spark.createDataFrame([(event,)], "value string")
    envelope.publish(frame, str(tmp_path / "t"), "q\\" * 30_000)
    (row,) = envelope.unwrap(spark.read.text(str(tmp_path / "t"))).collect()
    assert row.value == event and row.topic == "q\\" * 30_000


def test_topic_folder_is_smaller_than_its_topics(spark, tmp_path):
    frame = spark.range(300).select(F.concat(F.lit('{"id": '), "id", F.lit("}")).alias("value"))
    folder, topic = tmp_path / "t", "q\\" * 30_000
    envelope.publish(frame.coalesce(1), str(folder), topic)
    assert sum(f.stat().st_size for f in folder.iterdir()) < 1_000_000 < 300 * len(topic)
    back = envelope.unwrap(spark.read.text(str(folder))).collect()
    assert {r.topic for r in back} == {topic}
    assert sorted(r.value for r in back) == sorted(f'{{"id": {n}}}' for n in range(300))


def test_unwrapping_by_a_sample_changes_nothing(spark):
    head = '{"topic": "a\\\\ \\"b", "client_id": "c\\u00e9 é", "event": '
    odd = '{"topic": "a\\q", "client_id": "c", "event": '
    tails = ['{"a": 1.10}}', '"x\u2028y\x85z", "more": 1}', "1", "{bad}", "{bad}}", "}", "", "é}\u2028",
             '{"topic": "z"}, "topic": "z", "client_id": "y"}', "[1, 2]} behind", '{"a": "}"}}  ',
             "1}}", '{"a": {"event": 2.0}}, "event": 3}']
    lines = [h + t for h in (head, odd, head.replace("c\\", "d\\"), head + " ") for t in tails]
    lines += [head.replace(": ", ":") + "1.0}", '{"event": 1.0, "topic": "t"}', head[:-9], "", None]
    frame = spark.createDataFrame([(n, x) for n, x in enumerate(lines)], "n int, line string")

    def found(**like):
        read = envelope.unwrap(frame.orderBy("n").coalesce(1), "line", **like).collect()
        return [tuple(r) for r in read]

    plain = found()
    assert plain[0] == ('a\\ "b', "cé é", '{"a": 1.10}') and plain[3][0] is None
    for sample in [None, "", "no envelope", head, head + "{bad", odd + "1}", *lines[:3]]:
        assert found(sample=sample) == plain


def test_long_topics_are_not_parsed_line_by_line(spark):
    topic = "q\\" * 30_000
    events = spark.range(0, 4_000, 1, 4).select(F.col("id").cast("string").alias("value"))
    lines = envelope.wrap_lines(events, topic)
    sample = lines.first()["value"]

    def seconds(**like):
        began = time.perf_counter()
        unwrapped = envelope.unwrap(lines, **like)
        assert unwrapped.where(F.col("topic") == topic).agg(F.sum("value")).head()[0] == 7_998_000
        return time.perf_counter() - began

    seconds(sample=sample)
    assert 2 * min(seconds(sample=sample) for _ in range(2)) < seconds()


def test_envelopes_of_one_row_group_are_shared_out(spark, tmp_path):
    spark.range(200).select(F.col("id").alias("event_id")).coalesce(1).write.parquet(
        str(tmp_path / "events.parquet")
    )
    small = {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "0"}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        kept = loss_queries.envelope_text_kept(spark, str(tmp_path))
        files = kept.groupBy(F.input_file_name()).count().collect()
    finally:
        for key in small:
            spark.conf.unset(key)
    assert len(files) > 4 and sum(r["count"] for r in files) == 200


def test_times_need_a_whole_date(spark):
    from pactline.functions.clock import iso_timestamp

    good = ["2026-01-01", " 2026-01-01T10:00 ", "2026-01-01 10:00:00", "2026-01-01T10:00:00.5Z",
            "2026-01-01T10:00:00+05:30"]
    bad = ["12:30:00", "T10:00", "2026", "2026-01", "2026-13-01", "2026-01-01T10:00 America/New_York",
           "", None, "2026-01-01T"]
    frame = spark.createDataFrame([(x,) for x in good + bad], "t string")
    got = [r[0] is not None for r in frame.select(iso_timestamp(F.col("t"))).collect()]
    assert got == [True] * len(good) + [False] * len(bad)

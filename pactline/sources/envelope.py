"""Message envelopes: ``{"topic": ..., "client_id": ..., "event": {...}}``."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming import DataStreamReader

from pactline.errors import InputError
from pactline.functions.values import is_well_formed, parse_document, strip
from pactline.session import materialize

# Defaults of the publisher.
TOPIC, CLIENT_ID = "telemetry-events", "pactline-producer"

# All envelopes of a folder begin alike, so most of their bytes go with any compression,
# and long topics make so many bytes that its speed counts.
COMPRESSION = "lz4"

# Possessive, so that a text of any length takes no stack; (?s), as an event may
# hold any line separator.
_TEXT = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_HEAD = rf'(?s)^\{{"topic": {_TEXT}, "client_id": {_TEXT}, "event": '
_EVENT = r"(.*)\}$"
_ENVELOPE = _HEAD + _EVENT


def wrap_lines(
    lines: DataFrame, topic: str = TOPIC, client_id: str = CLIENT_ID, line: str = "value"
) -> DataFrame:
    """One envelope per JSON line; the event's own text is kept as it is."""
    if not topic.strip():
        raise InputError("topic is empty")
    head = f'{{"topic": {json.dumps(topic)}, "client_id": {json.dumps(client_id)}, "event": '
    kept = lines.select(strip(F.col(line)).alias("_event")).where("_event != ''")
    return kept.select(
        F.concat(F.lit(head), F.col("_event"), F.lit("}")).alias("value")
    )


def wrap_rows(df: DataFrame, topic: str = TOPIC, client_id: str = CLIENT_ID) -> DataFrame:
    """One envelope per row of a typed table, nulls written as nulls."""
    event = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return wrap_lines(df.select(event.alias("value")), topic, client_id)


def unwrap(envelopes: DataFrame, line: str = "value", sample: str | None = None) -> DataFrame:
    """Topic, client and the event as a JSON line in ``value``.

    Of envelopes as ``wrap_lines`` writes them the event's text is cut out as it
    stands, with every digit of its numbers; other spellings are parsed, and
    their events written anew.

    ``sample`` is one of the envelopes. Lines that have its topic and client to
    the byte, as all of one publisher do, need no search for the event and no
    parsing of the topic, which long topics make dear; the result is the same.
    """
    text, as_written, rest = F.col("_text"), F.col("_event"), F.col("_rest")
    # Of the sample alone: no row is looked at, and without a head no line has it.
    head = F.nullif(F.regexp_extract(F.lit(sample or ""), _HEAD, 0), F.lit(""))
    behind = F.substring(F.col(line).cast("binary"), F.octet_length(head) + 1, F.lit(2**31 - 1))
    cut = F.when(F.startswith(F.col(line), head), behind.cast("string")).alias("_rest")
    # Columns of their own, so that each pattern runs once per line.
    lines = envelopes.select(F.col(line).alias("_text"), cut)
    event = F.when(rest.isNotNull(), F.regexp_extract(rest, f"(?s)^{_EVENT}", 1)).otherwise(
        F.regexp_extract(text, _ENVELOPE, 1)
    )
    # A document that is broken behind its head has no topic and no client.
    whole = F.get_json_object(F.concat(F.lit('{"head": 0, "event": '), rest), "$.head").isNotNull()
    found = lines.select("_text", "_rest", event.alias("_event"), whole.alias("_whole"))

    def told(path: str) -> Column:
        known = F.get_json_object(F.concat(head, F.lit("0}")), path)
        return F.when(rest.isNotNull(), F.when(F.col("_whole"), known)).otherwise(
            F.get_json_object(text, path)
        )

    return found.select(
        told("$.topic").alias("topic"),
        told("$.client_id").alias("client_id"),
        F.when(as_written != "", as_written)
        .otherwise(F.get_json_object(text, "$.event"))
        .alias("value"),
    )


def _judged(lines: DataFrame, line: str) -> DataFrame:
    """Lines that are not blank, with whether each is one JSON value."""
    parsed = (
        lines.select(strip(F.col(line)).alias("_line"))
        .where("_line != ''")
        .withColumn("_document", parse_document(F.col("_line")))
    )
    good = is_well_formed(F.col("_document"), F.col("_line")).alias("_good")
    return parsed.select(F.col("_line").alias("value"), good)


def _counters() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("attempted"),
        F.count_if("_good").alias("published"),
        F.count_if(~F.col("_good")).alias("failed"),
    ]


def publish_stats(lines: DataFrame, line: str = "value") -> DataFrame:
    """Attempted, published and failed events: a line that is not JSON fails."""
    return _judged(lines, line).agg(*_counters())


def publish(
    lines: DataFrame,
    path: str,
    topic: str = TOPIC,
    client_id: str = CLIENT_ID,
    max_records: int = 0,
    line: str = "value",
) -> dict[str, int]:
    """Append envelopes of JSON lines to a topic folder; 0 publishes all.

    A line that is not JSON never becomes an envelope; it goes to
    ``<path>_rejected``. Blank lines are no events. ``max_records`` counts the
    events that are published; broken lines before the last of them are counted
    and kept as well, and those behind it are not attempted. The files are compressed, and a file
    is read by one task: ``lines`` of few splits make few files. Returns what the write itself
    counted: ``attempted``, ``published`` and ``failed``.
    """
    judged = _judged(lines, line)
    if max_records > 0:
        judged = _up_to(judged, max_records)
    seen = Observation()
    envelopes = wrap_lines(judged.observe(seen, *_counters()).where("_good"), topic, client_id)
    envelopes.write.mode("append").option("compression", COMPRESSION).text(path)
    counted = {name: seen.get.get(name) or 0 for name in ("attempted", "published", "failed")}
    if counted["failed"]:
        judged.where("not _good").select("value").write.mode("append").text(f"{path}_rejected")
    return counted


def _up_to(judged: DataFrame, most: int) -> DataFrame:
    """The lines up to the last of ``most`` good ones, broken lines among them included.

    Lines are judged once and written with their place: task and row. One count
    per task tells the task in which the limit falls, and only that task's rows
    are put in order. Lines count in the order in which tasks scan them.
    """
    places = {"_task": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}
    held = materialize(judged.withColumns(places), "judged", measure=False).df
    counts = held.where("_good").groupBy("_task").agg(F.count(F.lit(1)).alias("n"))
    before = 0
    for task, n in sorted(map(tuple, counts.collect())):  # one row per task of the scan
        if before + n >= most:
            good = held.where((F.col("_task") == task) & F.col("_good")).select("_row")
            last = good.orderBy("_row").limit(most - before).agg(F.max("_row")).first()[0]
            inside = (F.col("_task") < task) | ((F.col("_task") == task) & (F.col("_row") <= last))
            held = held.where(inside)
            break
        before += n
    return held.drop("_task", "_row")


def publish_to_kafka(lines: DataFrame, servers: str, topic: str, client_id: str = CLIENT_ID) -> None:
    """Send envelopes to a Kafka topic, where the session has that connector."""
    if not servers.strip():
        raise InputError("bootstrap servers are empty")
    options = {"kafka.bootstrap.servers": servers, "kafka.client.id": client_id, "topic": topic}
    wrap_lines(lines, topic, client_id).write.format("kafka").options(**options).save()


def kafka_lines(reader: DataFrameReader | DataStreamReader, servers: str, topic: str) -> DataFrame:
    """Lines of a Kafka topic, from ``spark.read`` or ``spark.readStream``."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    source = reader.format("kafka").options(**options).load()
    return source.select(F.col("value").cast("string").alias("value"))

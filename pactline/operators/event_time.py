"""Event times of raw records, for the lag and lateness metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.functions import kinds
from pactline.functions.clock import iso_timestamp
from pactline.operators.sla import EVENT_TS
from pactline.records import Records, column


def with_event_time(records: Records, field: str = "event_time", name: str = EVENT_TS) -> DataFrame:
    """The records' own columns and the time that ``field`` holds as ISO text.

    A time without an offset is UTC. Absent fields, other kinds of values and
    texts that are no time give NULL; ``unmeasured_events`` counts them.
    """
    rows, found = records.with_kinds([field], [])
    text = F.when(F.col(found[field]) == kinds.TEXT, records.text(field))
    kept = [column(c) for c in records.passthrough if c != name]
    return rows.select(*kept, iso_timestamp(text).alias(name))

"""Routing of mixed-source records to the datasets of their contracts."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.contracts import Contract, as_contracts
from pactline.records import LINE, Records, column, falls_under, unfold


def route_records(records: Records, contracts: Contract | Iterable[Contract]) -> DataFrame:
    """Each record once per contract its source falls under, with ``dataset``.

    A record whose source is absent, null or no text goes to contracts without
    a source system only. One projection, whatever the number of contracts.
    """
    chosen = as_contracts(contracts)
    df, _ = records.with_kinds([], chosen)
    held = [F.when(falls_under(c), F.struct(F.lit(c.dataset).alias("dataset"))) for c in chosen]
    keep = [column(name) for name in records.passthrough]
    line = [] if records.typed else [F.col(LINE).alias("value")]
    return unfold(df, held, *keep, *line)


def union_sources(*sources: DataFrame) -> DataFrame:
    """All rows of sources with different fields; a field a source lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)

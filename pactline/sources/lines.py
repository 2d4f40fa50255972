"""JSON-lines sources: scan, count, and find the first line that is not JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.errors import InputError
from pactline.functions.values import parse_document, strip
from pactline.records import DOCUMENT, LINE, STATE, Records, line_state, raw_records
from pactline.session import spread

PLACE = "_place"


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text lines as ``value`` with their place: file, block, order in the block.

    The place orders lines as they stand in their files, whichever way Spark
    packs the blocks into tasks.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return spark.read.text(path).select("value", place.alias(PLACE))


def read_jsonl(
    spark: SparkSession, path: str | Sequence[str], source_field: str = "source"
) -> Records:
    """Records of JSON-lines files, in file order."""
    lines = spread(read_lines(spark, path))
    return raw_records(lines, order_by=PLACE, source_field=source_field)


def scan_counts(df: DataFrame, line: str = "value") -> DataFrame:
    """Lines, and how many are blank, not JSON, JSON objects or other JSON."""
    states = (
        df.select(strip(F.col(line)).alias(LINE))
        .withColumn(DOCUMENT, parse_document(F.col(LINE)))
        .groupBy(line_state().alias(STATE))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    named = {"blank": "blank", "bad": "invalid", "object": "objects", "other": "other_json"}
    parts = [
        F.coalesce(F.sum(F.when(F.col(STATE) == state, F.col("n"))), F.lit(0)).alias(name)
        for state, name in named.items()
    ]
    return states.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("lines"), *parts)


def valid_lines(records: Records) -> DataFrame:
    """Lenient reading: the lines that hold a JSON object."""
    return records.parsed().where(F.col(STATE) == "object")


def bad_lines(records: Records) -> DataFrame:
    """Lines that are not JSON, or hold JSON that is no object."""
    return records.parsed().where(F.col(STATE).isin("bad", "other"))


def first_bad_line(records: Records) -> str:
    """Where the first such line stands, with its 1-based line number."""
    if records.order_by != PLACE:
        order = records.order_by or LINE
        row = bad_lines(records).orderBy(order).select(order).head()
        return f"{order} {row[0]}" if row else "no line"
    row = bad_lines(records).orderBy(PLACE).select(f"{PLACE}.*").head()
    if row is None:
        return "no line"
    # Only after a failure: count the lines of that file up to the bad one. A
    # filter would change how the files are split, so this counts by condition.
    file, block, order = (F.col(f"{PLACE}.{part}") for part in ("file", "block", "row"))
    before = (block < row["block"]) | ((block == row["block"]) & (order <= row["row"]))
    number = records.lines.agg(F.count_if((file == row["file"]) & before)).head()[0]
    return f"{row['file']} line {number}"


def require_valid(records: Records) -> Records:
    """Strict reading: raise at the first line that is not a JSON object."""
    if bad_lines(records).select(F.lit(1)).limit(1).count():
        raise InputError(f"not a JSON object: {first_bad_line(records)}")
    return records

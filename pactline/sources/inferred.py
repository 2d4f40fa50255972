"""Schema from the first record or from all of them, and reading a source with it."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactline.errors import InputError
from pactline.functions.kinds import NAMES, NULL
from pactline.functions.values import strip
from pactline.records import DOCUMENT, STATE, Records, raw_records


def infer_schema(spark: SparkSession, path: str) -> str:
    """DDL schema of the first line of the first file that is not empty.

    Only that line is read, whatever the size of the source.
    """
    first = None
    for file in sorted(spark.read.text(path).inputFiles()):
        first = spark.read.text(file).head()
        if first is not None:
            break
    line = "" if first is None else first["value"].strip()
    if not line:
        raise InputError(f"{path} starts with an empty line")
    try:
        json.loads(line)
    except json.JSONDecodeError as error:
        raise InputError(f"the first line of {path} is not JSON: {error}") from error
    return spark.range(1).select(F.schema_of_json(F.lit(line)).alias("ddl")).head()["ddl"]


def field_schema(records: Records) -> DataFrame:
    """What all records say of each top-level field, from one pass.

    ``type`` is the type that holds every value, nested ones merged field by
    field and VARIANT where they conflict; ``kinds`` names what was seen;
    ``present`` and ``nulls`` count records, of ``records`` objects in all. Values
    fold in the map tasks, so a field that all records have is no hot key.
    """
    spark = records.df.sparkSession
    whole = F.try_variant_get(F.col(DOCUMENT), "$[0]", "variant").alias("_whole")
    rows = records.parsed().where(F.col(STATE) == "object").select(whole)
    each = rows.lateralJoin(spark.tvf.variant_explode_outer(F.col("_whole").outer()))
    kind = F.substring(F.schema_of_variant("value"), 1, 3)
    merged = each.groupBy("key").agg(
        F.schema_of_variant_agg("value").alias("type"),
        F.collect_set(kind).alias("_kinds"),
        F.count(F.lit(1)).alias("present"),
        F.count_if(kind == NULL).alias("nulls"),
        # The first field of a record, or its only row where it has none, stands for it.
        F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("_records"),
    )
    names = F.create_map(*(F.lit(x) for pair in NAMES.items() for x in pair))
    kinds = F.array_sort(F.array_distinct(F.transform("_kinds", lambda k: names[k])))
    every = Window.partitionBy(F.lit(0))  # one row per field
    return (
        merged.withColumn("records", F.sum("_records").over(every))
        .where(F.col("key").isNotNull())
        .select(F.col("key").alias("field"), "type", kinds.alias("kinds"), "present", "nulls", "records")
    )


def merged_schema(fields: DataFrame, most: int = 10_000) -> str:
    """DDL that reads every value of :func:`field_schema`, conflicting ones as VARIANT.

    Fails where records have more than ``most`` different fields, as names that
    are data (ids, say) make no schema.
    """
    found = fields.select("field", "type").orderBy("field").limit(most + 1).collect()
    if len(found) > most:
        raise InputError(f"records have more than {most} different fields")
    parts = []
    for name, kind in found:
        kind = re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT<", "STRUCT<", kind))
        kind = "VARIANT" if "OBJECT" in kind.split("<") else kind
        quoted = name.replace("`", "``")
        parts.append(f"`{quoted}` {kind}")
    return ", ".join(parts)


def infer_merged_schema(spark: SparkSession, path: str, most: int = 10_000) -> str:
    """DDL schema of all records of a source, from one pass over it."""
    return merged_schema(field_schema(raw_records(spark.read.text(path))), most)


def read_with_schema(
    spark: SparkSession, path: str, schema: str | None = None, raw: str | None = None
) -> DataFrame:
    """Read JSON lines with a schema, by default that of the first record.

    A value that does not fit its type becomes null. Name a column in ``raw``
    to keep the line itself, which still tells absent, null and misfit apart.
    """
    return parse_lines(spark.read.text(path), schema or infer_schema(spark, path), raw)


def parse_lines(lines: DataFrame, schema: str, raw: str | None = None) -> DataFrame:
    """Parse a column ``value`` of JSON lines; blank lines are left out."""
    kept = lines.where(strip(F.col("value")) != "")
    parsed = kept.select(F.from_json("value", schema).alias("_parsed"), "value")
    line = [] if raw is None else [F.col("value").alias(raw)]
    return parsed.select("_parsed.*", *line)

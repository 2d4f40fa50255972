"""Inputs derived from the given tables, whole, by expressions that Spark and
DuckDB both understand: the same text defines the query and its check.

The tables are clean, so defects are put in by row number: every kind of fault
the rules and detectors look for occurs, in known places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.contracts import Contract, Field, Rule
from pactline.records import Records, raw_records
from pactline.session import spread

# One JSON line per event; assembled as text, because only text can tell an
# absent field from a null one.
DIRTY_LINE = """concat('{',
  case when event_id % 50 = 0 then '"event_id": null'
       when event_id % 40 = 1 then concat('"event_id": "ev-', cast(event_id - 1 as string), '"')
       else concat('"event_id": "ev-', cast(event_id as string), '"') end,
  case when event_id % 150 = 0 then ''
       when event_id % 140 = 0 then ', "source": 7'
       when event_type in ('click', 'view') then ', "source": "web"'
       else ', "source": "ops"' end,
  case when event_id % 110 = 0 then concat(', "event_time": ', cast(event_id as string))
       else concat(', "event_time": "', replace(cast(ts as string), ' ', 'T'), 'Z"') end,
  case when event_id % 70 = 0 then ''
       when event_id % 90 = 0 then concat(', "user_id": "', cast(user_id as string), '"')
       when event_id % 130 = 0 then concat(', "user_id": ', cast(user_id as string), '.0')
       else concat(', "user_id": ', cast(user_id as string)) end,
  case when event_id % 75 = 0 then concat(', "event_kind": "', event_type, '"')
       when event_id % 60 = 0 then ', "event_type": null'
       when event_id % 85 = 0 then ', "event_type": " "'
       else concat(', "event_type": "', event_type, '"') end,
  case when event_id % 95 = 0 then ', "value": "n/a"'
       when event_id % 65 = 0 then ', "value": null'
       when event_id % 45 = 0 then ', "value": -1.5'
       when event_id % 20 = 3 then concat(', "value": ', cast(user_id as string))
       else concat(', "value": ', cast(value as string)) end,
  case when event_id % 35 = 0 then ', "props": null'
       when event_id % 120 = 7 then ', "props": [1, 2]'
       else concat(', "props": ', props) end,
  case when event_id % 55 = 0 then ', "region": "eu"' else '' end,
  case when event_id % 77 = 0 then ', "beta": true' else '' end,
  '}')"""

# Lines as they may come from a broken file.
MIXED_LINE = """case when event_id % 60 = 0 then '   '
  when event_id % 70 = 0 then concat(props, ' trailing')
  when event_id % 80 = 0 then '[1, 2]'
  when event_id % 90 = 0 then '"text"'
  when event_id % 100 = 1 then '{"k": '
  when event_id % 100 = 2 then concat(props, props)
  else concat('  ', props, ' ') end"""

# Fixed contracts of the derived feeds.
_FIELDS = (
    Field("event_id", "string", False),
    Field("source", "string", False),
    Field("event_time", "timestamp", False),
    Field("user_id", "integer", False),
    Field("event_type", "string", False),
    Field("value", "float", False),
    Field("props", "object", True),
)
WEB = Contract(
    "web_events_contract",
    "v1",
    "web_events",
    _FIELDS,
    (
        Rule("event_id", required=True, allow_duplicates=False),
        Rule("user_id", max_null_ratio=0.01),
        Rule("value", max_null_ratio=0.5, required=True),
        Rule("event_type", max_null_ratio=0.0),
    ),
    source_system="web",
    max_lag_ms=5000.0,
)
OPS = Contract(
    "ops_events_contract",
    "v2",
    "ops_events",
    _FIELDS,
    (
        Rule("event_id", max_null_ratio=0.05, allow_duplicates=False),
        Rule("event_time", required=True, max_null_ratio=0.0),
        Rule("value", max_null_ratio=0.001),
    ),
    source_system="ops",
    max_lag_ms=20000.0,
)
EVERY = Contract(
    "all_events_contract",
    "v1",
    "all_events",
    (Field("event_id", "string", False), Field("props", "object", True)),
    (Rule("event_id", required=True), Rule("region", max_null_ratio=0.9)),
)
CONTRACTS = [WEB, OPS, EVERY]

# Ingestion time of an event, in milliseconds after it: 0 to 9972.
DELAY_MS = "(event_id * 7919) % 9973"
# Events on a full hour, so that some stand on a window boundary.
BOUNDARY_TS = "case when event_id % 97 = 0 then date_trunc('hour', ts) else ts end"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n`` (row number) and the dirty JSON line of every event."""
    return spread(table(spark, sf_dir, "events")).select(
        F.col("event_id").alias("n"), F.expr(DIRTY_LINE).alias("value")
    )


def dirty_records(spark: SparkSession, sf_dir: str) -> Records:
    return raw_records(dirty_lines(spark, sf_dir), order_by="n")


def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(table(spark, sf_dir, "events"))
    return events.select(F.expr(MIXED_LINE).alias("value"))


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with event and ingestion time and the number of their batch."""
    late_by = F.expr(f"make_dt_interval(0, 0, 0, ({DELAY_MS}) / 1000)")
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "user_id",
        F.expr(f"cast({BOUNDARY_TS} as timestamp_ntz)").alias("event_timestamp"),
        F.expr("event_id div 500").alias("batch_id"),
    )
    return events.withColumn("ingestion_timestamp", F.col("event_timestamp") + late_by)


def event_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 500 events, from their first to their last ingestion."""
    return (
        timed_events(spark, sf_dir)
        .groupBy("batch_id")
        .agg(
            F.min("ingestion_timestamp").alias("batch_start"),
            F.max("ingestion_timestamp").alias("batch_end"),
            F.count(F.lit(1)).alias("event_count"),
        )
    )


# --- the same inputs in DuckDB ----------------------------------------------


def _values(rows: list[str]) -> str:
    return "values " + ", ".join(rows)


def _text(value: object) -> str:
    return "null" if value is None else "'" + str(value).replace("'", "''") + "'"


FIELD_ROWS = _values(
    [
        f"('{c.dataset}', {_text(c.source_system)}, {i}, '{f.name}', '{f.type}', "
        f"{str(f.nullable).lower()})"
        for c in CONTRACTS
        for i, f in enumerate(c.fields)
    ]
)
RULE_ROWS = _values(
    [
        f"('{c.dataset}', {_text(c.source_system)}, {i}, '{r.field}', "
        f"{str(r.required).lower()}, "
        f"{'null' if r.max_null_ratio is None else f'cast({r.max_null_ratio} as double)'}, "
        f"{str(r.allow_duplicates).lower()})"
        for c in CONTRACTS
        for i, r in enumerate(c.rules)
    ]
)
DATASET_ROWS = _values(
    [f"('{c.dataset}', '{c.name}', '{c.version}', {_text(c.source_system)})" for c in CONTRACTS]
)

# Observed type of a field in the words of the reports; NULL where absent.
KIND = """case json_type(j, '$.' || field)
  when 'VARCHAR' then 'str' when 'BIGINT' then 'int' when 'UBIGINT' then 'int'
  when 'HUGEINT' then 'int' when 'DOUBLE' then 'float' when 'BOOLEAN' then 'bool'
  when 'OBJECT' then 'dict' when 'ARRAY' then 'list' when 'NULL' then 'null' end"""

LINES_SQL = f"""lines as (
  select n, j, case when json_type(j, '$.source') = 'VARCHAR'
                    then json_extract_string(j, '$.source') end as src
  from (select event_id as n, {DIRTY_LINE} as j from events)),
datasets(dataset, contract, version, source_system) as ({DATASET_ROWS}),
fields(dataset, source_system, position, field, ctype, nullable) as ({FIELD_ROWS}),
rules(dataset, source_system, position, field, required, max_null_ratio, allow_duplicates)
  as ({RULE_ROWS}),
members as (select n, j, dataset from lines join datasets
  on source_system is null or source_system = src),
typed as (select n, j, f.dataset, position, field, ctype, nullable, {KIND} as kind
  from members m join fields f on f.dataset = m.dataset),
broken as (select n, dataset, position, field,
    case when kind is null then 'missing_field' when kind = 'null' then 'nullability'
         else 'type_mismatch' end as rule,
    case when kind = 'null' then 'non-null' else ctype end as expected,
    coalesce(kind, '') as observed
  from typed
  where kind is null or (kind = 'null' and not nullable)
     or (kind <> 'null' and not case ctype
           when 'string' then kind = 'str' when 'timestamp' then kind = 'str'
           when 'integer' then kind = 'int' when 'float' then kind in ('int', 'float')
           when 'object' then kind = 'dict' when 'array' then kind = 'list'
           when 'boolean' then kind = 'bool' end)),
ruled as (select n, r.dataset, position, field, required, max_null_ratio, allow_duplicates,
    {KIND} as kind, json_extract_string(j, '$.' || field) as val
  from members m join rules r on r.dataset = m.dataset),
rule_nulls as (select dataset, position, field, required, max_null_ratio,
    count(*) as records, count(*) filter (kind is null or kind = 'null') as nulls
  from ruled group by all),
repeated as (select dataset, position, field, val, count(*) as copies, min(n) as first_seen
  from ruled where not allow_duplicates and kind is not null and kind <> 'null'
  group by all having count(*) > 1)"""

TIMED_SQL = f"""timed as (
  select event_id, event_type, event_timestamp, event_id // 500 as batch_id,
         event_timestamp + ({DELAY_MS}) * interval 1 millisecond as ingestion_timestamp,
         ({DELAY_MS}) * 1000 as lag_us
  from (select *, {BOUNDARY_TS} as event_timestamp from events)),
batches as (select batch_id, min(ingestion_timestamp) as batch_start,
    max(ingestion_timestamp) as batch_end, count(*) as event_count
  from timed group by batch_id)"""

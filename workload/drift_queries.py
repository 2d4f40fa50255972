"""Drift, bad values, late events and duplicates."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import pactline as p
from pactline.contracts import Contract, Field
from workload.feeds import CONTRACTS, LINES_SQL, dirty_records, table

CUSTOMER = Contract(
    "customer_contract",
    "v1",
    "customer",
    (
        Field("c_custkey", "integer", False),
        Field("c_name", "string", False),
        Field("c_acctbal", "float", False),
    ),
)


def drift_unexpected_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.unexpected_fields(dirty_records(spark, sf_dir), CONTRACTS)


def drift_unexpected_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.unexpected_fields(p.typed_records(table(spark, sf_dir, "customer")), CUSTOMER)


def drift_rename_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.rename_candidates(dirty_records(spark, sf_dir), CONTRACTS)


def drift_field_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.field_profile(dirty_records(spark, sf_dir), CONTRACTS)


def drift_type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.type_profile(dirty_records(spark, sf_dir), CONTRACTS)


def bad_values_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.bad_values(dirty_records(spark, sf_dir), CONTRACTS)


def bad_values_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.bad_values(p.typed_records(table(spark, sf_dir, "customer")), CUSTOMER)


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 37th event arrives two days late; a day is allowed."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.expr("event_id div 500").alias("batch_id"),
        F.expr("case when event_id % 37 = 0 then ts - interval 2 days else ts end").alias("ts"),
    )
    marked = p.with_late_flag(events, "ts", "batch_id", ["event_type"], timedelta(days=1))
    return marked.where("is_late").select("event_id", "event_type", "ts")


def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.exact_duplicates(table(spark, sf_dir, "documents"), ["text", "lang"], "doc_id")


def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return p.keep_first(documents, ["text", "lang"], "doc_id").select("doc_id", "n_chars")


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), "c_mktsegment"
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), "s_acctbal"
    )
    return p.union_sources(customers, suppliers)


QUERIES = {
    "drift_unexpected_fields": drift_unexpected_fields,
    "drift_unexpected_columns": drift_unexpected_columns,
    "drift_rename_candidates": drift_rename_candidates,
    "drift_field_profile": drift_field_profile,
    "drift_type_profile": drift_type_profile,
    "bad_values_profile": bad_values_profile,
    "bad_values_typed": bad_values_typed,
    "late_events": late_events,
    "exact_duplicates": exact_duplicates,
    "dedupe_keep_first": dedupe_keep_first,
    "union_sources": union_sources,
}

ORACLE = {
    "drift_unexpected_fields": f"""with {LINES_SQL}, known as (
  select dataset, list(field) as names from fields group by dataset),
unknown as (select n, m.dataset, unnest(json_keys(j)) as field, names
  from members m join known k on k.dataset = m.dataset)
select dataset, field, count(*) as records from unknown
where not list_contains(names, field) group by all""",
    "drift_unexpected_columns": """select 'customer' as dataset, field, count(*) as records
from customer, (values ('c_nationkey'), ('c_mktsegment')) t(field) group by field""",
    "drift_rename_candidates": f"""with {LINES_SQL}, known as (
  select dataset, list(field) as names from fields group by dataset),
keys as (select n, j, m.dataset, unnest(json_keys(j)) as field, names
  from members m join known k on k.dataset = m.dataset),
unknown as (select n, dataset, field, json_type(j, '$.' || field) as t from keys
  where not list_contains(names, field)),
gone as (select n, dataset, field, ctype from typed where kind is null)
select g.dataset, g.field as missing_field, u.field as candidate, count(*) as records
from gone g join unknown u on g.n = u.n and g.dataset = u.dataset
where case ctype when 'string' then t = 'VARCHAR' when 'timestamp' then t = 'VARCHAR'
  when 'integer' then t in ('BIGINT', 'UBIGINT') when 'object' then t = 'OBJECT'
  when 'float' then t in ('BIGINT', 'UBIGINT', 'DOUBLE') end
group by all""",
    "drift_field_profile": f"""with {LINES_SQL}
select dataset, field, count(*) as records, count(kind) as present,
  count(*) filter (kind = 'null') as nulls, count(kind) / count(*) as presence_ratio
from typed group by all""",
    "drift_type_profile": f"""with {LINES_SQL}
select dataset, field, coalesce(kind, 'absent') as observed_type, count(*) as records
from typed group by all""",
    "bad_values_profile": f"""with {LINES_SQL}
select dataset, field, case when ctype = 'string' then 'blank' else 'negative' end as "check",
  count(*) filter (case when ctype = 'string'
      then kind = 'str' and trim(json_extract_string(j, '$.' || field)) = ''
      else kind in ('int', 'float') and try_cast(json_extract_string(j, '$.' || field) as double) < 0
    end) as records
from typed where ctype in ('string', 'integer', 'float') group by all""",
    "bad_values_typed": """select 'customer' as dataset, 'c_custkey' as field,
  'negative' as "check", count(*) filter (c_custkey < 0) as records from customer
union all select 'customer', 'c_name', 'blank', count(*) filter (trim(c_name) = '') from customer
union all select 'customer', 'c_acctbal', 'negative', count(*) filter (c_acctbal < 0)
from customer""",
    "late_events": """with shifted as (select event_id, event_type, event_id // 500 as b,
    case when event_id % 37 = 0 then ts - interval 2 days else ts end as ts from events),
latest as (select event_type, b, max(ts) as m from shifted group by all),
seen as (select event_type, b, max(m) over (partition by event_type order by b
    rows between unbounded preceding and 1 preceding) as s from latest)
select event_id, event_type, ts from shifted join seen using (event_type, b)
where ts < s - interval 1 day""",
    "exact_duplicates": """select min(doc_id) as first_seen, count(*) as copies
from documents group by text, lang having count(*) > 1""",
    "dedupe_keep_first": """select doc_id, n_chars from documents
qualify row_number() over (partition by text, lang order by doc_id) = 1""",
    "union_sources": """select c_custkey as key, c_name as name, c_mktsegment,
  cast(null as double) as s_acctbal from customer
union all select s_suppkey, s_name, null, s_acctbal from supplier""",
}

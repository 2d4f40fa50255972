"""Contract checks over the dirty event feed and over typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import pactline as p
from pactline.contracts import Contract, Field, Rule
from workload.feeds import (
    CONTRACTS,
    LINES_SQL,
    OPS,
    TIMED_SQL,
    WEB,
    dirty_lines,
    dirty_records,
    table,
    timed_events,
)

ORDERS = Contract(
    "orders_contract",
    "v1",
    "orders",
    (
        Field("o_orderkey", "integer", False),
        Field("o_custkey", "string", False),
        Field("o_orderdate", "timestamp", False),
        Field("o_totalprice", "float", False),
        Field("o_comment", "string", True),
    ),
    (
        Rule("o_orderkey", required=True, allow_duplicates=False),
        Rule("o_custkey", allow_duplicates=False),
        Rule("o_comment", max_null_ratio=0.25),
    ),
)


def _schema_rule(rule: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = p.schema_summary(dirty_records(spark, sf_dir), CONTRACTS)
        return found.where(F.col("rule") == rule).drop("position")

    return query


def _schema_rule_sql(rule: str) -> str:
    return f"""with {LINES_SQL}
select dataset, field, rule, expected, observed, count(*) as violations
from broken where rule = '{rule}' group by all"""


def schema_violation_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.schema_violations(dirty_records(spark, sf_dir), CONTRACTS)


def schema_violation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.schema_summary(dirty_records(spark, sf_dir), CONTRACTS)


def quality_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.null_counts(dirty_records(spark, sf_dir), CONTRACTS)


def _null_rule(rule: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = p.null_findings(dirty_records(spark, sf_dir), CONTRACTS)
        return found.where(F.col("rule") == rule).select(
            "dataset", "position", "field", "rule", "expected", "observed"
        )

    return query


def quality_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.duplicate_values(table(spark, sf_dir, "documents"), "text", "doc_id")


def quality_duplicate_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.duplicate_findings(dirty_records(spark, sf_dir), CONTRACTS).select(
        "dataset", "field", "rule", "observed"
    )


def quality_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    lags = p.with_lag(timed_events(spark, sf_dir))
    both = [p.freshness_findings(lags, c) for c in (WEB, OPS)]
    return both[0].unionByName(both[1]).select("dataset", "field", "rule", "expected", "observed")


def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.contract_report(dirty_records(spark, sf_dir), WEB, observed_max_lag_ms=7000)


def contract_report_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.contract_report(dirty_records(spark, sf_dir), CONTRACTS)


def contract_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.contract_findings(dirty_records(spark, sf_dir), CONTRACTS).select(
        "dataset", "check", "field", "rule", "expected", "observed", "violations"
    )


def contract_report_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = p.typed_records(table(spark, sf_dir, "orders"), order_by="o_orderkey")
    return p.contract_findings(records, ORDERS).select(
        "dataset", "check", "field", "rule", "expected", "observed", "violations"
    )


def contract_jsonl_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = p.shared_folder(spark, "feed")
    dirty_lines(spark, sf_dir).select("value").write.text(folder)
    return p.contract_report(p.read_jsonl(spark, folder), CONTRACTS)


def numbered_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = p.shared_folder(spark, "feed")
    dirty_lines(spark, sf_dir).orderBy("n").select("value").write.text(folder)
    return p.numbered_violations(p.read_jsonl(spark, folder), WEB)


def route_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lines, whole texts, routed by source."""
    documents = table(spark, sf_dir, "documents")
    fields = ("doc_id", "source", "lang", "text", "n_chars")
    lines = documents.select("doc_id", F.to_json(F.struct(*fields)).alias("value"))
    sources = [f"src{i}" for i in range(0, 20, 2)]
    contracts = [
        Contract(f"{s}_contract", "v1", s, (Field("doc_id", "integer"),), source_system=s)
        for s in sources
    ]
    records = p.raw_records(lines, order_by="doc_id")
    routed = p.route_records(records, contracts)
    return routed.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.length(F.get_json_object("value", "$.text"))).alias("characters"),
    )


QUERIES = {
    "schema_missing_field": _schema_rule("missing_field"),
    "schema_nullability": _schema_rule("nullability"),
    "schema_type_mismatch": _schema_rule("type_mismatch"),
    "schema_violation_detail": schema_violation_detail,
    "schema_violation_summary": schema_violation_summary,
    "schema_numbered_violations": numbered_violations,
    "quality_null_counts": quality_null_counts,
    "quality_required": _null_rule("required"),
    "quality_null_ratio": _null_rule("max_null_ratio"),
    "quality_duplicates": quality_duplicates,
    "quality_duplicate_sample": quality_duplicate_sample,
    "quality_freshness": quality_freshness,
    "contract_report": contract_report,
    "contract_report_all": contract_report_all,
    "contract_findings": contract_findings,
    "contract_report_typed": contract_report_typed,
    "contract_jsonl_report": contract_jsonl_report,
    "route_by_source": route_by_source,
}

_MESSAGE = """case rule when 'missing_field' then format('Record {} is missing field {}', n, field)
  when 'nullability' then format('Record {} has null for non-nullable field {}', n, field)
  else format('Record {} field {} has invalid type', n, field) end as message"""

_REPORT = """, report as (
  select d.dataset, contract, version,
    (select count(*) from members m where m.dataset = d.dataset) as records,
    (select count(*) from broken b where b.dataset = d.dataset) as schema_violations,
    (select count(*) from rule_nulls q where q.dataset = d.dataset and required and nulls > 0)
    + (select count(*) from rule_nulls q where q.dataset = d.dataset
       and nulls / records > max_null_ratio)
    + (select count(distinct position) from repeated q where q.dataset = d.dataset)
    {extra} as quality_violations
  from datasets d {where})
select dataset, contract, version, records, schema_violations, quality_violations,
  schema_violations + quality_violations as total_violations,
  schema_violations + quality_violations = 0 as is_valid,
  cast(0 as bigint) as bad_lines, cast(0 as bigint) as other_lines from report"""

_FOUR_DIGITS = "printf('%.4f', nulls / records)"

# First three duplicate values per rule, as a list of quoted texts.
_SAMPLES = """samples as (select dataset, position, field,
    '[' || string_agg('''' || val || '''', ', ' order by first_seen) || ']' as observed
  from (select *, row_number() over (partition by dataset, position order by first_seen) as rank
        from repeated) where rank <= 3 group by all)"""

_FINDINGS = f"""with {LINES_SQL}, {_SAMPLES}
select dataset, 'schema' as "check", field, rule, expected, observed, count(*) as violations
from broken group by all
union all
select dataset, 'quality', field, 'required', '0 null or missing values',
  cast(nulls as string), 1 from rule_nulls where required and nulls > 0
union all
select dataset, 'quality', field, 'max_null_ratio', cast(max_null_ratio as string),
  {_FOUR_DIGITS}, 1 from rule_nulls where nulls / records > max_null_ratio
union all
select dataset, 'quality', field, 'duplicates', 'unique values', observed, 1 from samples"""

ORACLE = {
    "schema_missing_field": _schema_rule_sql("missing_field"),
    "schema_nullability": _schema_rule_sql("nullability"),
    "schema_type_mismatch": _schema_rule_sql("type_mismatch"),
    "schema_violation_detail": f"""with {LINES_SQL}
select n, dataset, position, field, rule, expected, observed, {_MESSAGE} from broken""",
    "schema_violation_summary": f"""with {LINES_SQL}
select dataset, position, field, rule, expected, observed, count(*) as violations
from broken group by all""",
    "schema_numbered_violations": f"""with {LINES_SQL}, numbered as (
  select n as row, row_number() over (order by n) - 1 as n from members
  where dataset = 'web_events')
select numbered.n as record_index, dataset, position, field, rule, expected, observed,
  {_MESSAGE.replace("n, field", "numbered.n, field")}
from broken join numbered on broken.n = numbered.row where dataset = 'web_events'""",
    "quality_null_counts": f"""with {LINES_SQL}
select dataset, position, field, records, nulls, nulls / records as null_ratio
from rule_nulls""",
    "quality_required": f"""with {LINES_SQL}
select dataset, position, field, 'required' as rule, '0 null or missing values' as expected,
  cast(nulls as string) as observed from rule_nulls where required and nulls > 0""",
    "quality_null_ratio": f"""with {LINES_SQL}
select dataset, position, field, 'max_null_ratio' as rule,
  cast(max_null_ratio as string) as expected, {_FOUR_DIGITS} as observed
from rule_nulls where nulls / records > max_null_ratio""",
    "quality_duplicates": """select min(doc_id) as first_seen, count(*) as copies
from documents where text is not null group by text having count(*) > 1""",
    "quality_duplicate_sample": f"""with {LINES_SQL}, {_SAMPLES}
select dataset, field, 'duplicates' as rule, observed from samples""",
    "quality_freshness": f"""with {TIMED_SQL}, seen as (select max(lag_us) / 1000 as lag from timed)
select dataset, 'freshness' as field, 'max_lag_ms' as rule, cast(lim as string) as expected,
  cast(lag as string) as observed
from seen, (values ('web_events', cast(5000 as double)), ('ops_events', cast(20000 as double)))
  c(dataset, lim) where lag > lim""",
    "contract_report": f"with {LINES_SQL}"
    + _REPORT.format(extra="+ 1", where="where d.dataset = 'web_events'"),
    "contract_report_all": f"with {LINES_SQL}" + _REPORT.format(extra="", where=""),
    "contract_findings": _FINDINGS,
    "contract_report_typed": """with repeated as (
  select o_custkey, min(o_orderkey) as first_seen, count(*) as copies from orders
  group by o_custkey having count(*) > 1 order by first_seen limit 3),
total as (select count(*) as n from orders)
select 'orders' as dataset, 'schema' as "check", 'o_custkey' as field, 'type_mismatch' as rule,
  'string' as expected, 'int' as observed, n as violations from total
union all
select 'orders', 'schema', 'o_comment', 'missing_field', 'string', '', n from total
union all
select 'orders', 'quality', 'o_comment', 'max_null_ratio', '0.25', printf('%.4f', n / n), 1
from total
union all
select 'orders', 'quality', 'o_custkey', 'duplicates', 'unique values',
  '[' || string_agg(cast(o_custkey as string), ', ' order by first_seen) || ']', 1 from repeated
union all
select 'orders', 'quality', 'o_orderkey', 'duplicates', 'unique values',
  '[' || string_agg(cast(o_orderkey as string), ', ' order by o_orderkey) || ']', 1
from (select o_orderkey from orders group by 1 having count(*) > 1 order by 1 limit 3)
having count(*) > 0""",
    "contract_jsonl_report": f"with {LINES_SQL}" + _REPORT.format(extra="", where=""),
    "route_by_source": """select source as dataset, count(*) as records,
  cast(sum(length(text)) as bigint) as characters
from documents where source in ('src0', 'src2', 'src4', 'src6', 'src8', 'src10', 'src12',
  'src14', 'src16', 'src18') group by source""",
}

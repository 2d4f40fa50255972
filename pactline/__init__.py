"""Data contracts, bronze ingestion and ingestion-SLA metrics on Spark."""

from pactline.contracts import (
    Contract,
    Field,
    Rule,
    find_contract,
    load_contract,
    load_contracts,
)
from pactline.errors import ContractError, EnforcementError, InputError
from pactline.operators.drift import (
    bad_values,
    field_profile,
    rename_candidates,
    type_profile,
    unexpected_fields,
)
from pactline.operators.duplicates import (
    duplicate_keys,
    duplicate_samples,
    duplicate_values,
    exact_duplicates,
    keep_first,
)
from pactline.operators.event_time import with_event_time
from pactline.operators.late import with_late_flag
from pactline.operators.quality_rules import (
    duplicate_findings,
    freshness_findings,
    null_counts,
    null_findings,
)
from pactline.operators.routing import route_records, union_sources
from pactline.operators.schema_rules import (
    kind_counts,
    numbered_violations,
    schema_summary,
    schema_violations,
)
from pactline.operators.sla import (
    approx_lag_percentiles,
    batch_throughput,
    lag_percentiles,
    lag_summary,
    latency_histogram,
    rounded,
    run_summary,
    sla_violations,
    tumbling_metrics,
    unmeasured_events,
    window_metrics,
    with_lag,
)
from pactline.plans.ingest import ingest_batch, ingest_log
from pactline.plans.report import contract_findings, contract_report, enforce
from pactline.records import Records, raw_records, typed_records
from pactline.session import configure, materialize, shared_folder, spread
from pactline.sinks.bronze import BronzeSink, enrich, write_bronze
from pactline.sinks.reports import emit_metrics, emit_report
from pactline.sources.inferred import (
    field_schema,
    infer_merged_schema,
    infer_schema,
    merged_schema,
    read_with_schema,
)
from pactline.sources.lines import read_jsonl, read_lines, require_valid, scan_counts
from pactline.streaming.bronze import bronze_stream
from pactline.streaming.contract_split import contract_stream
from pactline.streaming.contract_watch import contract_watch
from pactline.streaming.dedupe import dedupe_all, dedupe_stream
from pactline.streaming.late import late_rows, late_side, on_time_side, split_late, split_log
from pactline.streaming.sla import (
    closed_window_times,
    rank_error,
    sla_sketch_stream,
    sla_stream,
)

__all__ = [name for name, value in list(globals().items()) if getattr(value, "__module__", "").startswith("pactline.")]

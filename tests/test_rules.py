import json

import pytest
from feed_records import call, drifted, reading, rows

import pactline as p
from pactline import Contract, Field, Rule


def calls(spark, records):
    lines = [(i, json.dumps(r)) for i, r in enumerate(records)]
    return p.raw_records(spark.createDataFrame(lines, "n int, value string"), order_by="n")


def verdict(report):
    return {r["dataset"]: (r["records"], r["schema_violations"], r["quality_violations"])
            for r in report.collect()}


def test_clean_mixed_file(spark, contracts, jsonl):
    path = jsonl([call(i) for i in range(8)] + [reading(i) for i in range(8)])
    report = p.contract_report(p.read_jsonl(spark, path), contracts.values(), 1000)
    assert verdict(report) == {"cdr_events": (8, 0, 0), "device_metrics": (8, 0, 0)}
    assert len(p.enforce(report)) == 2


def test_drifted_mixed_file(spark, contracts, jsonl):
    records = p.read_jsonl(spark, jsonl(drifted()))
    report = p.contract_report(records, contracts.values())
    assert verdict(report) == {"cdr_events": (12, 2, 2), "device_metrics": (8, 1, 2)}
    found = rows(p.contract_findings(records, contracts.values()), "dataset", "rule", "observed")
    assert found == sorted([
        ("cdr_events", "missing_field", ""),
        ("cdr_events", "nullability", "null"),
        ("cdr_events", "required", "1"),
        ("cdr_events", "duplicates", "['cdr-00001', 'cdr-00002', 'cdr-00003']"),
        ("device_metrics", "nullability", "null"),
        ("device_metrics", "required", "1"),
        ("device_metrics", "max_null_ratio", "0.1250"),
    ], key=str)
    with pytest.raises(p.EnforcementError, match="4 violations"):
        p.enforce(report)


def test_report_is_emitted_as_json(spark, contracts, jsonl, tmp_path):
    report = p.contract_report(p.read_jsonl(spark, jsonl(drifted())), contracts.values())
    p.emit_report(report, str(tmp_path / "reports"))
    said = spark.read.json(str(tmp_path / "reports"))
    assert rows(said, "report.dataset", "report.total_violations") == [
        ("cdr_events", 4), ("device_metrics", 3)]


def test_record_numbers_count_matched_records(spark, contracts, jsonl):
    mixed = drifted()
    records = p.read_jsonl(spark, jsonl([*mixed[12:], *mixed[:12]]))
    numbered = p.numbered_violations(records, contracts["cdr_events"])
    assert rows(numbered, "record_index", "field", "message") == [
        (11, "callee_id", "Record 11 is missing field callee_id"),
        (9, "event_id", "Record 9 has null for non-nullable field event_id"),
    ]


def test_combined_violations(spark, contracts):
    records = calls(spark, [call(1, callee_id=...), call(1)])
    report = p.contract_report(records, contracts["cdr_events"], 7000)
    assert verdict(report) == {"cdr_events": (2, 1, 2)}


def test_types_of_values(spark):
    odd = ['1', '1.0', '"1"', 'true', 'null', '[1]', '{"a": 1}', '99999999999999999999', '1e3']
    lines = [(i, f'{{"x": {v}}}') for i, v in enumerate(odd)] + [(9, "{}")]
    records = p.raw_records(spark.createDataFrame(lines, "n int, value string"), order_by="n")
    accepted = {
        "integer": {0, 7},
        "float": {0, 1, 7, 8},
        "string": {2},
        "timestamp": {2},
        "boolean": {3},
        "array": {5},
        "object": {6},
        "anything": {0, 1, 2, 3, 5, 6, 7, 8},
    }
    for kind, sound in accepted.items():
        contract = Contract("c", "v", "d", (Field("x", kind, True),))
        broken = {r["n"]: r["rule"] for r in p.schema_violations(records, contract).collect()}
        assert set(broken) == set(range(10)) - sound - {4}, kind
        assert broken[9] == "missing_field"
    observed = p.schema_violations(records, Contract("c", "v", "d", (Field("x", "date"),)))
    assert observed.count() == 1
    names = p.type_profile(records, Contract("c", "v", "d", (Field("x", "string"),)))
    assert dict(rows(names, "observed_type", "records")) == {
        "int": 2, "float": 2, "str": 1, "bool": 1, "null": 1, "list": 1, "dict": 1, "absent": 1,
    }


def test_type_mismatch_names_observed_type(spark, contracts):
    broken = p.schema_violations(calls(spark, [call(1, duration_sec="120")]), contracts["cdr_events"])
    assert rows(broken, "field", "rule", "expected", "observed") == [
        ("duration_sec", "type_mismatch", "integer", "str")
    ]


def test_null_rules(spark, contracts):
    c = contracts["cdr_events"]
    for change, rules in (
        ({"event_time": None}, ["max_null_ratio", "required"]),
        ({"duration_sec": None}, ["max_null_ratio"]),
        ({"event_id": ...}, ["required"]),
    ):
        found = p.null_findings(calls(spark, [call(1, **change), call(2)]), c)
        assert sorted(r["rule"] for r in found.collect()) == rules


def test_duplicates_compare_values_not_texts(spark):
    values = ["1", "1.0", "true", '"1"', "1e0", "2.5", "2.50", "null", "null", '"x"', '{"b":1,"a":2}',
              '{"a":2,"b":1}', '"' + "y" * 99 + '"', '"' + "y" * 99 + '"']
    lines = [(i, f'{{"x": {v}}}') for i, v in enumerate(values)]
    records = p.raw_records(spark.createDataFrame(lines, "n int, value string"), order_by="n")
    contract = Contract("c", "v", "d", (Field("x", "any"),), (Rule("x", allow_duplicates=False),))
    found = p.duplicate_keys(records, contract)
    assert rows(found, "first_seen", "copies") == [(0, 4), (10, 2), (12, 2), (5, 2)]
    assert rows(p.duplicate_findings(records, contract), "observed") == [("[1, 2.5, " '{"a":2,"b":1}]',)]


def test_routing_needs_a_text_source(spark, contracts):
    sources = ["cdr-simulator", None, 5, ..., "other"]
    records = calls(spark, [call(i, source=s) for i, s in enumerate(sources)])
    c = contracts["cdr_events"]
    assert rows(p.route_records(records, c), "n", "dataset") == [(0, "cdr_events")]
    assert verdict(p.contract_report(records, c, route=False))["cdr_events"][0] == 5


def test_last_of_repeated_keys_wins_and_dots_are_names(spark):
    line = [(0, '{"a.b": "x", "k": 1, "k": "z"}')]
    records = p.raw_records(spark.createDataFrame(line, "n int, value string"), order_by="n")
    contract = Contract("c", "v", "d", (Field("a.b", "string"), Field("k", "string")))
    assert p.schema_violations(records, contract).count() == 0


def test_empty_match_and_unknown_lines(spark, contracts, jsonl):
    records = p.read_jsonl(spark, jsonl([reading(1)]))
    with pytest.raises(p.EnforcementError, match="no records"):
        p.enforce(p.contract_report(records, contracts["cdr_events"]))
    bad = p.read_jsonl(spark, jsonl([call(1), "  ", '{"a": 1} x', "[1]"], "bad.jsonl"))
    with pytest.raises(p.InputError, match="line 3"):
        p.require_valid(bad)
    with pytest.raises(p.InputError, match="1 lines are not JSON and 1"):
        p.enforce(p.contract_report(bad, contracts["cdr_events"]), bad)
    assert p.require_valid(records) is records


def test_scan_counts(spark):
    lines = ["", " \t", "{}", ' {"a": 1} ', "[1]", "3", '"s"', "{", '{"a": 1} x', '{"a": 1}{"b": 2}',
             '{"a": 1},7', "{'a': 1}", "] [", "[1],1", '{"a":1} ']
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert tuple(p.scan_counts(df).head()) == (15, 2, 7, 3, 3)


def test_empty_input(spark, contracts):
    records = calls(spark, [call(1)]).over(calls(spark, [call(1)]).df.limit(0))
    report = p.contract_report(records, contracts["cdr_events"])
    assert verdict(report) == {"cdr_events": (0, 0, 0)}


def test_typed_lane_matches_raw_lane(spark):
    contract = Contract(
        "c", "v", "d",
        (Field("a", "integer", False), Field("b", "string", False), Field("z", "float")),
        (Rule("a", required=True, allow_duplicates=False), Rule("b", max_null_ratio=0.4)),
    )
    data = [(0, 1, "x"), (1, None, "y"), (2, 1, None), (3, 2, None), (4, 1, "x")]
    df = spark.createDataFrame(data, "n int, a bigint, b string")
    text = spark.createDataFrame(
        [(n, json.dumps({"a": a, "b": b})) for n, a, b in data], "n int, value string"
    )
    typed = p.contract_findings(p.typed_records(df, order_by="n"), contract)
    raw = p.contract_findings(p.raw_records(text, order_by="n"), contract)
    assert rows(typed) == rows(raw) and typed.count() == 5  # 2 of 5 is not above 0.4


def test_drift_detectors(spark, contracts, jsonl):
    records = p.read_jsonl(spark, jsonl(drifted()))
    both = contracts.values()
    assert rows(p.unexpected_fields(records, both)) == [
        ("cdr_events", "callee_identifier", 1), ("cdr_events", "is_late_event", 4),
        ("cdr_events", "roaming_flag", 2), ("device_metrics", "is_late_event", 3),
        ("device_metrics", "pipeline_region", 1),
    ]
    assert rows(p.rename_candidates(records, both)) == [
        ("cdr_events", "callee_id", "callee_identifier", 1)
    ]
    bad = {r["field"]: r["records"] for r in p.bad_values(records, both).collect() if r["records"]}
    assert bad == {"duration_sec": 2, "consumer_lag": 2}
    profile = {r["field"]: r["presence_ratio"] for r in p.field_profile(records, both).collect()}
    assert profile["callee_id"] == pytest.approx(11 / 12) and profile["status"] == 1.0

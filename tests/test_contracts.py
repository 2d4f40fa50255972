import pytest

from pactline import Contract, ContractError, find_contract, load_contract, load_contracts

GOOD = {
    "contract_name": "c",
    "version": "v1",
    "dataset_name": "d",
    "schema": [{"name": "a", "type": "string", "nullable": False}, {"name": "b", "type": "float"}],
    "quality_rules": [{"field": "a", "required": True, "max_null_ratio": 0}],
    "freshness": {"max_lag_ms": 10},
}


def test_packaged_contracts():
    found = load_contracts()
    assert sorted(found) == ["cdr_events", "device_metrics"]
    calls = found["cdr_events"]
    assert calls.max_lag_ms == 5000 and len(calls.fields) == 8 and len(calls.rules) == 3
    assert found["device_metrics"].rules[0].allow_duplicates is False


def test_defaults():
    c = Contract.from_mapping(GOOD)
    assert c.fields[1].nullable and not c.fields[0].nullable
    assert c.rules[0].allow_duplicates and c.rules[0].max_null_ratio == 0.0


@pytest.mark.parametrize(
    "change",
    [
        {"schema": []},
        {"schema": {"a": "string"}},
        {"schema": [{"name": "a"}]},
        {"schema": [{"name": "a", "type": "string", "nullable": "false"}]},
        {"quality_rules": [{"field": "a", "max_null_ratio": 1.5}]},
        {"quality_rules": [{"required": True}]},
        {"freshness": {"max_lag_ms": 0}},
        {"freshness": {}},
    ],
)
def test_bad_definitions(change):
    with pytest.raises(ContractError):
        Contract.from_mapping(GOOD | change)


@pytest.mark.parametrize("key", ["contract_name", "version", "dataset_name", "schema"])
def test_missing_keys(key):
    with pytest.raises(ContractError, match=key):
        Contract.from_mapping({k: v for k, v in GOOD.items() if k != key})


def test_files(tmp_path):
    for missing in (load_contract, load_contracts):
        with pytest.raises(ContractError):
            missing(tmp_path / "nowhere")
    (tmp_path / "broken.yaml").write_text("a: [1")
    with pytest.raises(ContractError):
        load_contract(tmp_path / "broken.yaml")
    with pytest.raises(ContractError):
        find_contract({}, "d")


def test_repeated_field_keeps_last_definition():
    again = GOOD | {"schema": [*GOOD["schema"], {"name": "a", "type": "integer"}]}
    c = Contract.from_mapping(again)
    assert [(f.name, f.type) for f in c.fields] == [("a", "integer"), ("b", "float")]


def test_read_schema():
    assert Contract.from_mapping(GOOD).read_schema().simpleString() == "struct<a:string,b:double>"

"""Data contracts: small driver-side settings that generate Spark expressions.

A contract is configuration, never data. It is read once on the driver and
turned into Column expressions, so checking costs no join and no UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from pathlib import Path
from typing import Any, NamedTuple

import yaml
from pyspark.sql import types as T

from pactline.errors import ContractError

DEFAULT_DEFINITIONS = Path(__file__).with_name("definitions")

# Spark types used when a contract serves as a read schema.
READ_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "object": T.VariantType(),
    "array": T.ArrayType(T.VariantType()),
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True
    description: str = ""


@dataclass(frozen=True)
class Rule:
    """What must hold for one field over a whole dataset."""

    field: str
    max_null_ratio: float | None = None
    required: bool = False
    allow_duplicates: bool = True


@dataclass(frozen=True)
class Contract:
    name: str
    version: str
    dataset: str
    fields: tuple[Field, ...]
    rules: tuple[Rule, ...] = ()
    source_system: str | None = None
    max_lag_ms: float | None = None
    description: str = ""
    owners: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        # A field given twice keeps its first place and its last definition.
        unique = {f.name: f for f in self.fields}
        object.__setattr__(self, "fields", tuple(unique.values()))

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def checked_fields(self) -> list[str]:
        """Every field some check of this contract looks at."""
        return list(dict.fromkeys(self.field_names + [r.field for r in self.rules]))

    def read_schema(self) -> T.StructType:
        """The contract as a schema for ``spark.read.schema(...)``."""
        schema = T.StructType()
        for f in self.fields:
            kind = READ_TYPES.get(f.type, T.StringType())
            schema.add(f.name, kind, True, {"comment": f.description})
        return schema

    @classmethod
    def from_mapping(cls, raw: Any, where: str = "contract") -> Contract:
        """Build a contract from parsed YAML, refusing a definition with errors."""
        return _built(cls, _CONTRACT, raw, where)


def load_contract(path: str | Path) -> Contract:
    """Read one YAML contract."""
    file = Path(path)
    if not file.is_file():
        raise ContractError(f"no contract file at {file}")
    try:
        raw = yaml.safe_load(file.read_text(encoding="utf-8"))
    except yaml.YAMLError as error:
        raise ContractError(f"{file} is not valid YAML: {error}") from error
    return Contract.from_mapping(raw, file.name)


def load_contracts(directory: str | Path = DEFAULT_DEFINITIONS) -> dict[str, Contract]:
    """Read every ``*.yaml`` of a folder, by dataset; a later file name wins."""
    folder = Path(directory)
    if not folder.is_dir():
        raise ContractError(f"no contract folder at {folder}")
    return {c.dataset: c for c in map(load_contract, sorted(folder.glob("*.yaml")))}


def find_contract(contracts: Mapping[str, Contract], dataset: str) -> Contract:
    if dataset not in contracts:
        known = ", ".join(sorted(contracts)) or "none"
        raise ContractError(f"no contract for dataset {dataset!r} (known: {known})")
    return contracts[dataset]


def as_contracts(contracts: Contract | Iterable[Contract]) -> list[Contract]:
    """One contract or several, as a list with distinct dataset names."""
    found = [contracts] if isinstance(contracts, Contract) else list(contracts)
    names = [c.dataset for c in found]
    if not found or len(set(names)) != len(names):
        raise ContractError("give at least one contract, each for its own dataset")
    return found


# How a definition is written: for every object the keys it may have, what
# becomes of their values, and what stands for a key that is left out.
_NEEDED = object()


class _Key(NamedTuple):
    """One key of an object of the format, and the argument it gives."""

    key: str
    argument: str
    read: Callable[[Any, str], Any]
    default: Any = _NEEDED


def _built(kind: type, keys: tuple[_Key, ...], raw: Any, where: str) -> Any:
    """An object from a mapping with these keys; others are ignored."""
    if not isinstance(raw, Mapping):
        raise ContractError(f"{where}: a mapping is needed")
    absent = [k.key for k in keys if k.default is _NEEDED and k.key not in raw]
    if absent:
        raise ContractError(f"{where}: missing {', '.join(absent)}")
    return kind(
        **{
            k.argument: k.read(raw[k.key], f"{where}: {k.key}") if k.key in raw else k.default
            for k in keys
        }
    )


def _text(value: Any, where: str) -> str:
    return str(value)


def _name(value: Any, where: str) -> str:
    if value is None or not str(value).strip():
        raise ContractError(f"{where} is empty")
    return str(value).strip()


def _flag(value: Any, where: str) -> bool:
    if value is not True and value is not False:
        raise ContractError(f"{where} is neither true nor false")
    return value


def _number(within: Callable[[float], bool], allowed: str) -> Callable[[Any, str], float]:
    def read(value: Any, where: str) -> float:
        try:
            number = float(value)
        except (TypeError, ValueError) as error:
            raise ContractError(f"{where}: {value!r} is not a number") from error
        if not within(number):
            raise ContractError(f"{where} is not {allowed}")
        return number

    return read


def _maybe(read: Callable[[Any, str], Any], otherwise: Any = None) -> Callable[[Any, str], Any]:
    """A value that may also be written as null."""
    return lambda value, where: otherwise if value is None else read(value, where)


def _listed(read: Callable[[Any, str], Any]) -> Callable[[Any, str], tuple]:
    def each(value: Any, where: str) -> tuple:
        if not isinstance(value, list):
            raise ContractError(f"{where} is no list")
        return tuple(read(v, f"{where}[{n}]") for n, v in enumerate(value))

    return each


def _object(kind: type, *keys: _Key) -> Callable[[Any, str], Any]:
    return lambda value, where: _built(kind, keys, value, where)


def _some(read: Callable[[Any, str], tuple]) -> Callable[[Any, str], tuple]:
    def filled(value: Any, where: str) -> tuple:
        found = read(value, where)
        if not found:
            raise ContractError(f"{where} is empty")
        return found

    return filled


_FIELD = _object(
    Field,
    _Key("name", "name", _name),
    _Key("type", "type", _name),
    _Key("nullable", "nullable", _flag, True),
    _Key("description", "description", _text, ""),
)
_RULE = _object(
    Rule,
    _Key("field", "field", _name),
    _Key(
        "max_null_ratio",
        "max_null_ratio",
        _maybe(_number(lambda x: 0 <= x <= 1, "in 0 to 1")),
        None,
    ),
    _Key("required", "required", _flag, False),
    _Key("allow_duplicates", "allow_duplicates", _flag, True),
)
_LIMIT = _object(
    lambda limit: limit,
    _Key("max_lag_ms", "limit", _number(lambda x: x > 0, "above zero")),
)
_CONTRACT = (
    _Key("contract_name", "name", _text),
    _Key("version", "version", _text),
    _Key("dataset_name", "dataset", _text),
    _Key("schema", "fields", _some(_maybe(_listed(_FIELD), ()))),
    _Key("quality_rules", "rules", _maybe(_listed(_RULE), ()), ()),
    _Key("source_system", "source_system", _maybe(_text), None),
    _Key("freshness", "max_lag_ms", _maybe(_LIMIT), None),
    _Key("description", "description", _text, ""),
    _Key("owners", "owners", _maybe(_listed(_text), ()), ()),
)

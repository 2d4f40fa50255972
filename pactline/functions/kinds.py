"""Kinds of values: three letters per record field, NULL where it is absent.

The letters are the start of what ``schema_of_variant`` says, which keeps the
work per field small; reports translate them to names.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, WHOLE, NULL, FLAG, OBJECT, ARRAY = "STR", "BIG", "VOI", "BOO", "OBJ", "ARR"
DOUBLE, DECIMAL, TIME, DATE, OTHER = "DOU", "DEC", "TIM", "DAT", "ELS"
FRACTIONS = (DOUBLE, DECIMAL)
NUMBERS = (WHOLE, *FRACTIONS)
NESTED = (OBJECT, ARRAY)

# Kind -> name of the type in reports.
NAMES = {
    TEXT: "str",
    WHOLE: "int",
    NULL: "null",
    FLAG: "bool",
    OBJECT: "dict",
    ARRAY: "list",
    DOUBLE: "float",
    DECIMAL: "float",
    TIME: "datetime",
    DATE: "date",
    OTHER: "other",
}

# Contract type -> kinds it accepts. A contract type that is not
# listed accepts everything.
ACCEPTED: dict[str, tuple[str, ...]] = {
    "string": (TEXT,),
    "integer": (WHOLE,),
    "float": NUMBERS,
    "boolean": (FLAG,),
    "timestamp": (TEXT, TIME),
    "object": (OBJECT,),
    "array": (ARRAY,),
}


def kind_sql(schema: str) -> str:
    """SQL for the kind behind a ``schema_of_variant`` text.

    A number written with a fraction is a DECIMAL of its shortest scale, so
    scale 0 means a whole number only where it is too long for BIGINT.
    """
    return (
        f"if(length({schema}) = 13 and endswith({schema}, ',0)') "
        f"and substring({schema}, 1, 3) = '{DECIMAL}' and substring({schema}, 9, 2) >= '19', "
        f"'{WHOLE}', substring({schema}, 1, 3))"
    )


def name_sql(kind: str) -> str:
    """SQL for the reported name of a kind."""
    pairs = ", ".join(f"'{code}', '{name}'" for code, name in NAMES.items())
    return f"element_at(map({pairs}), {kind})"


def spark_kind(dtype: T.DataType) -> str:
    """Kind of all values of a Spark column."""
    if isinstance(dtype, T.IntegralType):
        return WHOLE
    if isinstance(dtype, T.DecimalType):
        return WHOLE if dtype.scale == 0 else DECIMAL
    if isinstance(dtype, T.NumericType):
        return DOUBLE
    kinds = {
        T.StringType: TEXT,
        T.BooleanType: FLAG,
        T.TimestampType: TIME,
        T.TimestampNTZType: TIME,
        T.DateType: DATE,
        T.StructType: OBJECT,
        T.MapType: OBJECT,
        T.VariantType: OBJECT,
        T.ArrayType: ARRAY,
    }
    return kinds.get(type(dtype), OTHER)

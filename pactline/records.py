"""Records under check: raw JSON lines or the rows of a typed DataFrame.

Both lanes give every operator the same expressions per field: the kind of its
value (NULL = absent), an equality key and a printable form.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactline.contracts import Contract
from pactline.functions import kinds, values

LINE, DOCUMENT, STATE, SOURCE = (
    "_pactline_line",
    "_pactline_document",
    "_pactline_state",
    "_pactline_source",
)


@dataclass(frozen=True)
class Records:
    """A DataFrame and the way to look at its fields.

    ``order_by`` names a column that is unique per record and gives the order
    in which records were first seen.
    """

    df: DataFrame
    order_by: str | None = None
    typed: bool = False
    source_field: str = "source"
    passthrough: tuple[str, ...] = ()
    lines: DataFrame | None = None

    def over(self, df: DataFrame, *more: str) -> Records:
        """The same view on other rows with the same columns, and ``more``."""
        return replace(self, df=df, passthrough=(*self.passthrough, *more))

    def parsed(self) -> DataFrame:
        """Rows with a state; raw lines also with their parsed document."""
        if self.typed:
            return self.df.withColumn(STATE, F.lit("object"))
        parsed = self.df.withColumn(DOCUMENT, values.parse_document(F.col(LINE)))
        return parsed.withColumn(STATE, line_state())

    def with_kinds(
        self, names: Iterable[str], contracts: list[Contract]
    ) -> tuple[DataFrame, dict[str, str]]:
        """Parsed rows with the source and one kind column per named field.

        The source is kept only where a contract asks for it, so it takes few
        values whatever the data holds.
        """
        systems = sorted({c.source_system for c in contracts if c.source_system is not None})
        wanted = list(dict.fromkeys(names))
        looked_up = [*wanted, self.source_field] if systems else wanted
        columns = {name: f"_pactline_kind_{i}" for i, name in enumerate(dict.fromkeys(looked_up))}
        df = self.parsed()
        if self.typed:
            df = df.withColumns({c: self._typed_kind(name) for name, c in columns.items()})
        elif columns:
            # Two steps, so that each path is looked up once and only then named.
            schemas = {
                c: F.schema_of_variant(values.member(F.col(DOCUMENT), name))
                for name, c in columns.items()
            }
            df = df.withColumns(schemas).withColumns(
                {c: F.expr(kinds.kind_sql(c)) for c in columns.values()}
            )
        return df.withColumn(SOURCE, self._known_source(systems, columns)), columns

    def text(self, name: str) -> Column:
        """A field as text; NULL where a typed table lacks it."""
        return self._value(name, "string")

    def number(self, name: str) -> Column:
        return self._value(name, "double")

    def key(self, name: str, kind_column: str) -> Column:
        """Equality key of a value, with a mark for its family; NULL for null."""
        kind = F.col(kind_column)
        text, number = self.text(name), self.number(name)
        if self._is_decimal(name):
            exact = values.decimal_key(column(name))
        else:
            exact = F.when(~F.isnan(number), values.number_key(number))
        numeric = (
            F.when(kind == kinds.WHOLE, text)
            .when(kind == kinds.FLAG, F.when(text == "true", "1").otherwise("0"))
            .otherwise(exact)
        )
        nested = (*kinds.NESTED, kinds.TIME, kinds.DATE, kinds.OTHER)
        return values.short_key(
            F.when(kind == kinds.TEXT, F.concat(F.lit("s:"), text))
            .when(kind.isin(*kinds.NUMBERS, kinds.FLAG), F.concat(F.lit("n:"), numeric))
            .when(kind.isin(*nested), F.concat(F.lit("j:"), self._json(name)))
        )

    def _is_decimal(self, name: str) -> bool:
        known = self.typed and name in self.df.columns
        return known and isinstance(self.df.schema[name].dataType, T.DecimalType)

    def shown(self, name: str, kind_column: str) -> Column:
        """A value as reports print it."""
        kind, text = F.col(kind_column), self.text(name)
        return (
            F.when(kind == kinds.TEXT, values.quoted(text))
            .when(kind == kinds.FLAG, F.initcap(text))
            .when(kind.isin(*kinds.NESTED), self._json(name))
            .otherwise(text)
        )

    def _known_source(self, systems: list[str], found: dict[str, str]) -> Column:
        if not systems:
            return F.lit(None).cast("string")
        text = self.text(self.source_field)
        known = (F.col(found[self.source_field]) == kinds.TEXT) & text.isin(systems)
        return F.when(known, text)

    def _value(self, name: str, kind: str) -> Column:
        if not self.typed:
            return F.try_variant_get(F.col(DOCUMENT), values.member_path(name), kind)
        if name not in self.df.columns:
            return F.lit(None).cast(kind)
        dtype = self.df.schema[name].dataType
        if isinstance(dtype, (T.StructType, T.MapType, T.ArrayType, T.VariantType)):
            return F.to_json(column(name)) if kind == "string" else F.lit(None).cast(kind)
        if kind == "double" and not isinstance(dtype, T.NumericType):
            return F.lit(None).cast(kind)
        return column(name).cast(kind)

    def _json(self, name: str) -> Column:
        if self.typed:
            return self.text(name)
        return F.to_json(values.member(F.col(DOCUMENT), name))

    def _typed_kind(self, name: str) -> Column:
        if name not in self.df.columns:
            return F.lit(None).cast("string")
        kind = kinds.spark_kind(self.df.schema[name].dataType)
        return F.when(column(name).isNull(), kinds.NULL).otherwise(kind)


def falls_under(contract: Contract, route: bool = True) -> Column:
    """Whether a row of :meth:`Records.with_kinds` falls under a contract.

    With ``route``, a contract with a source system takes only the records
    whose source is that text; absent, null and other sources do not match.
    """
    record = F.col(STATE) == "object"
    if not route or contract.source_system is None:
        return record
    return record & F.col(SOURCE).eqNullSafe(contract.source_system)


def line_state() -> Column:
    """``blank``, ``bad`` (not JSON), ``object`` or ``other`` for a parsed line."""
    line = F.col(LINE)
    return (
        F.when(line == "", "blank")
        .when(~values.is_well_formed(F.col(DOCUMENT), line), "bad")
        .when(line.startswith("{"), "object")
        .otherwise("other")
    )


def raw_records(
    df: DataFrame, line: str = "value", order_by: str | None = None, source_field: str = "source"
) -> Records:
    """Records from a column of JSON text; blank lines are no records."""
    # Read when the plan is optimized: a repeated JSON key keeps its last value.
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    kept = [c for c in df.columns if c != line]
    stripped = df.select(*map(column, kept), values.strip(column(line)).alias(LINE))
    return Records(
        stripped,
        order_by=order_by,
        source_field=source_field,
        passthrough=tuple(kept),
        lines=df,
    )


def typed_records(
    df: DataFrame, order_by: str | None = None, source_field: str = "source"
) -> Records:
    """Records from the rows of an existing table."""
    return Records(df, order_by, True, source_field, tuple(df.columns))


def unfold(
    df: DataFrame, rows: list[Column], *keep: Column | str, only: Column | None = None
) -> DataFrame:
    """One output row per struct of ``rows`` that is not NULL, beside ``keep``.

    The array is a column of its own, because what stands inside a generator
    is interpreted wherever Spark does not compile the whole stage. The outer
    form keeps Catalyst from adding a filter on the array's size, which it
    would push below the projections and so parse every line twice. Rows for
    which ``only`` is false build no array at all.
    """
    found = F.array_compact(F.array(*rows))
    kept = df.select(*keep, (found if only is None else F.when(only, found)).alias("_rows"))
    others = [column(c) for c in kept.columns if c != "_rows"]
    one = kept.select(*others, F.explode_outer("_rows").alias("_row"))
    return one.where(F.col("_row").isNotNull()).select(*others, "_row.*")


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")

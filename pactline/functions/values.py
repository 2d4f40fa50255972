"""Column expressions over JSON values held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blank space at a line's ends.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Values longer than this are grouped by their SHA-256 instead of themselves.
LONG_VALUE = 64


def literal(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def parse_document(line: Column) -> Column:
    """Parse a stripped line as element 0 of an array that ends with its hash.

    The parser stops after the first complete value, so a line such as
    ``{"a": 1} junk`` would pass on its own. Inside the array the junk breaks
    the syntax or moves the closing hash, which ``is_well_formed`` looks for. A
    line cannot close the array itself, as it would have to hold its own hash.
    """
    closing = F.concat(F.lit(',"'), _closing(line), F.lit('"]'))
    return F.try_parse_json(F.concat(F.lit("["), line, closing))


def _closing(line: Column) -> Column:
    return F.hex(F.xxhash64(line, F.length(line)))


def is_well_formed(document: Column, line: Column) -> Column:
    closing = F.try_variant_get(document, "$[1]", "string")
    extra = F.variant_get(document, "$[2]", "variant")
    return F.coalesce(closing == _closing(line), F.lit(False)) & extra.isNull()


def member(document: Column, name: str) -> Column:
    """The value of one key of the record; SQL NULL where the key is absent."""
    return F.variant_get(document, member_path(name), "variant")


def member_path(name: str) -> str:
    quoted = name.replace("\\", "\\\\").replace('"', '\\"')
    return f'$[0]["{quoted}"]'


def short_key(text: Column) -> Column:
    """A key of bounded length that is equal exactly where ``text`` is equal."""
    return F.when(F.length(text) > LONG_VALUE, F.concat(F.lit("h:"), F.sha2(text, 256))).otherwise(
        text
    )


def number_key(value: Column) -> Column:
    """Text under which 1, 1.0 and 1e0 meet."""
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(9.0e18))
    return F.when(whole, F.when(whole, value).cast("bigint").cast("string")).otherwise(
        value.cast("string")
    )


def decimal_key(value: Column) -> Column:
    """Exact text of a decimal under which 1, 1.0 and 1.00 meet."""
    text = value.cast("string")
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def quoted(text: Column) -> Column:
    """A text in quotes, as the reports list it."""
    escaped = text
    for plain, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(shown))
    double = text.contains("'") & ~text.contains('"')
    return F.when(double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )

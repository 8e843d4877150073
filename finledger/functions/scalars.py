"""Scalar cleaning, typing and hashing, JVM side only.

Column in, Column out; most also take SQL text and return SQL text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A column, or SQL text of one.
Expr = Column | str

# The characters that count as whitespace when text is trimmed.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts read as true and as false.
TRUE_TOKENS = ("1", "true", "t", "yes", "si", "sí")
FALSE_TOKENS = ("0", "false", "f", "no")

# Day-and-month order falls back from month-first to day-first.
FALLBACK_FORMATS = (
    "MM/dd/yyyy", "dd/MM/yyyy", "MM/dd/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "yyyyMMdd",
)


def call(name: str, *args: Expr) -> Expr:
    """A built-in function over columns, or over SQL text when all arguments are text.

    Text keeps wide projections cheap to build: a table of sixty columns becomes one
    ``selectExpr`` instead of hundreds of calls into the JVM.
    """
    if all(isinstance(a, str) for a in args):
        return f"{name}({', '.join(args)})"
    return F.call_function(name, *[F.expr(a) if isinstance(a, str) else a for a in args])


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def cast(c: Expr, dtype: str) -> Expr:
    return f"CAST({c} AS {dtype})" if isinstance(c, str) else c.cast(dtype)


def try_cast(c: Expr, dtype: str) -> Expr:
    return f"try_cast({c} AS {dtype})" if isinstance(c, str) else c.try_cast(dtype)


def strip(c: Expr) -> Expr:
    return call("btrim", cast(c, "string"), text_literal(WHITESPACE))


def clean(c: Expr) -> Expr:
    """Trimmed text; blank becomes NULL."""
    return call("nullif", strip(c), "''")


def clean_number(c: Column) -> Column:
    """NaN becomes NULL."""
    return F.when(~F.isnan(c), c)


def to_str(c: Expr) -> Expr:
    """Identifier text: trimmed, blank to NULL, zero kept, ``12345.0`` read as ``12345``."""
    # only the rare text that looks like a float meets the patterns; large ones come as 1.2E7
    text = cast(c, "string")
    whole = call("regexp_replace", text, text_literal(r"^\s*(-?\d+)\.0+\s*$"), "'$1'")
    plain = cast(try_cast(text, "decimal(38,6)"), "string")
    spelled = call("regexp_replace", plain, text_literal(r"\.?0+$"), "''")
    large = call("rlike", text, text_literal(r"^\s*-?\d\.\d+E\d+\s*$"))
    is_large = call("if", call("contains", text, "'E'"), large, "false")
    fixed = call("if", is_large, spelled, call("if", call("contains", text, "'.0'"), whole, text))
    return clean(fixed)


def read_as(c: Expr, dtype: str) -> Expr:
    """Text as another type, NULL when it cannot be read. The plain cast comes first;
    trimming is left to the few texts it does not take."""
    return call("coalesce", try_cast(c, dtype), try_cast(strip(c), dtype))


def read_id(c: Expr, dtype: str = "bigint") -> Expr:
    """Identifier text as a whole number."""
    return call("coalesce", try_cast(c, dtype), try_cast(to_str(c), dtype))


def to_bool(c: Expr) -> Expr:
    """Boolean from text tokens; any other text is NULL."""
    text = call("lower", strip(c))
    known = {True: TRUE_TOKENS, False: FALSE_TOKENS}
    yes, no = (call("array_contains", call("array", *map(text_literal, known[v])), text)
               for v in (True, False))
    return call("if", yes, "true", call("if", no, "false", "CAST(NULL AS BOOLEAN)"))


def number_to_bool(c: Column) -> Column:
    """Boolean from a number: non-zero is true, NULL and NaN are NULL."""
    return clean_number(c) != 0


def parse_ts_drop_zone(c: Expr, formats: Sequence[str] = FALLBACK_FORMATS) -> Expr:
    """Wall-clock timestamp: the offset is dropped, not applied. Unreadable text is NULL."""
    text = strip(c)
    tries = [try_cast(c, "timestamp_ntz"), try_cast(text, "timestamp_ntz")]
    tries += [
        cast(call("try_to_timestamp", text, text_literal(f)), "timestamp_ntz") for f in formats
    ]
    return call("coalesce", *tries)


def parse_ts_utc(c: Expr) -> Expr:
    """UTC timestamp without zone: the offset is applied, then dropped (session zone is UTC)."""
    return cast(read_as(c, "timestamp"), "timestamp_ntz")


def canonical_ts(c: Expr) -> Expr:
    """One spelling per instant for hashing; unreadable text stays as it came."""
    return call("coalesce", cast(parse_ts_drop_zone(c), "string"), clean(c))


def canonical_amount(c: Expr) -> Expr:
    """Amounts hash as two-decimal text whatever their source spelling."""
    return call("coalesce", cast(read_as(c, "decimal(18,2)"), "string"), clean(c))


def canonical_int(c: Expr) -> Expr:
    return call("coalesce", cast(read_id(c, "int"), "string"), clean(c))


def parts_text(*parts: Expr) -> Expr:
    """The text that is hashed: NULL counts as empty, so no part can shift left."""
    return call("concat_ws", "'|'", *[call("coalesce", strip(p), "''") for p in parts])


def sha256_of_parts(*parts: Expr) -> Expr:
    return call("sha2", parts_text(*parts), "256")


def to_json_text(c: Column) -> Column:
    """JSON text of an object or array, NULL members kept."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def safe_get(c: Column, *path: str, default: Column | None = None) -> Column:
    """Nested field, NULL (or the default) as soon as a parent is missing."""
    for name in path:
        c = c.getField(name)
    return c if default is None else F.coalesce(c, default)


def first_nonzero(a: Expr, b: Expr) -> Expr:
    """``a`` unless it is missing or zero, else ``b``."""
    return call("coalesce", call("nullif", a, "0"), b)


def first_nonblank(*cols: Column) -> Column:
    """First text that is neither NULL nor empty, else empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def diff_boundaries(unit: str, a: Column, b: Column) -> Column:
    """Number of unit boundaries crossed from ``a`` to ``b`` (not whole units elapsed)."""
    return F.timestamp_diff(unit, F.date_trunc(unit, a), F.date_trunc(unit, b))


def bin_start(c: Column, width: str) -> Column:
    """Start of the fixed-width time bin that holds ``c``."""
    return F.window(c, width).getField("start")


def null_label(c: Column, label: str = "(NULL)") -> Column:
    return F.coalesce(c, F.lit(label))


def with_service(c: Column, service: str) -> Column:
    """Default the service dimension without overwriting one that is set."""
    return F.coalesce(c, F.lit(service))

"""Column builders: every function returns a native ``Column``.

Nothing here is a UDF; all expressions stay inside whole-stage codegen.
Schema-dependent choices (``pick``, ``surrogate_id``) are resolved at plan
time from ``df.columns``: a column's *presence* decides, never its values.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Integer text with an optional fractional part: the fraction is truncated,
# as the non-ANSI string -> int cast did ('12.5' -> 12, '-3.9' -> -3,
# '.5' -> 0).  Groups: sign, integer digits, fraction digits.
_INT_TEXT = r"^([+-]?)([0-9]*)(?:[.]([0-9]*))?$"

MONEY = "decimal(18,2)"


def _names(cols: DataFrame | Iterable[str]) -> set[str]:
    return set(cols.columns) if isinstance(cols, DataFrame) else set(cols)


def pick(cols: DataFrame | Iterable[str], *candidates: str, default=None) -> Column:
    """First candidate column that *exists*; else ``default``; else NULL.

    A present-but-NULL column is returned as is (no value fallback).
    """
    found = [name for name in candidates if name in _names(cols)]
    return F.col(found[0]) if found else F.lit(default)


def typed_null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def legacy_int(col: Column | str) -> Column:
    """Lenient string -> int: malformed or out-of-range text becomes NULL.

    Integer text with a fraction is truncated toward zero (an empty integer
    part before fraction digits reads as 0); surrounding whitespace (blanks,
    tabs, line breaks) is ignored;
    exponent forms are rejected.
    """
    c = F.col(col) if isinstance(col, str) else col
    text = F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")
    whole = F.regexp_extract(text, _INT_TEXT, 2)
    fraction = F.regexp_extract(text, _INT_TEXT, 3)
    valid = text.rlike(_INT_TEXT) & ((F.length(whole) > 0) | (F.length(fraction) > 0))
    digits = F.when(F.length(whole) > 0, F.concat(F.regexp_extract(text, _INT_TEXT, 1), whole)).otherwise(F.lit("0"))
    return F.when(valid, digits.try_cast("int"))


def lenient_double(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(c.cast("string")).try_cast("double")


def as_double(df: DataFrame, name: str) -> Column:
    """``name`` as double; text is parsed leniently, numbers are cast."""
    if dict(df.dtypes)[name] == "string":
        return lenient_double(name)
    return F.col(name).cast("double")


#: Exact type of a single amount, and of sums of amounts.
AMOUNT = "decimal(38,6)"
#: The whole part of an amount is summed as its high bits and this many low ones, both as bigint.
_LOW_BITS = 20


def amount(col: Column | str) -> Column:
    """An amount as exact decimal with six places; NULL if unparseable or too large for it."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("double").try_cast(AMOUNT)


def money(col: Column | str) -> Column:
    """Two-decimal money value as DECIMAL(18,2)."""
    return amount(col).try_cast(MONEY)


def amount_units(name: str) -> dict[str, str]:
    """SQL expressions of one row of column ``name``, by the aggregates of ``amount_parts`` that sum them."""
    value = f"try_cast(`{name}` AS double)"
    whole = f"CASE WHEN abs({value}) < 1152921504606846976D THEN cast({value} AS bigint) END"
    micro = f"cast(rint(({value} - {whole}) * 1e6D) AS bigint)"
    # one correctly rounded division where the millionths fit a double; above, the places are coarser than a rounded sum
    exact = f"CASE WHEN abs({value}) < 2147483648D THEN ({whole} * 1000000L + {micro}) / 1e6D ELSE {whole} + {micro} / 1e6D END = {value}"
    return {
        "high": f"CASE WHEN {exact} THEN shiftright({whole}, {_LOW_BITS}) END",
        "low": f"CASE WHEN {exact} THEN {whole} & {(1 << _LOW_BITS) - 1}L END",
        "micro": f"CASE WHEN {exact} THEN {micro} END",
        "rough": value,
        "odd": f"CASE WHEN {exact} OR {value} IS NULL THEN 0L ELSE 1L END",
    }


def amount_sums(name: str) -> dict[str, str]:
    """SQL aggregates over column ``name`` from which ``exact_sql`` and ``merged_sql`` make a sum.

    An amount is exact if it is the double nearest to a number of at most six
    places below 2^60.  ``high``, ``low`` and ``micro`` sum the exact ones'
    whole parts, in two parts, and millionths; ``rough`` sums all as doubles;
    ``odd`` counts those that are not exact.  Per row that is arithmetic on
    primitives.  They are text so that a sum is parsed in one call.
    """
    return {n: f"sum({e})" if n in ("rough", "odd") else f"try_sum({e})" for n, e in amount_units(name).items()}


def amount_parts(name: str) -> dict[str, Column]:
    return {n: F.expr(e) for n, e in amount_sums(name).items()}


def exact_sql(parts: Mapping[str, str]) -> str:
    """The exact sum as ``AMOUNT``; NULL without values, if one is not exact or if the sum is beyond about 1e25."""
    high, low, micro = (f"CAST({parts[n]} AS decimal(20,0))" for n in ("high", "low", "micro"))
    return f"CASE WHEN {parts['odd']} = 0 THEN CAST({high} * {1 << _LOW_BITS}BD + {low} + {micro} * 0.000001BD AS {AMOUNT}) END"


def merged_sql(parts: Mapping[str, str]) -> str:
    """The sum as double: exact and rounded once, or the double sum where ``exact_sql`` has none.

    Nothing is dropped and nothing wraps, in either ANSI mode.
    """
    return f"coalesce(CAST({exact_sql(parts)} AS double), {parts['rough']})"


def money_sum(name: str) -> Column:
    """Sum of a column of amounts as double: exact, so order-independent, up to six places, else the double sum."""
    return F.expr(merged_sql(amount_sums(name)))


def money_total(name: str) -> Column:
    """Sum of a column of amounts as DECIMAL(18,2), rounded once at the end."""
    parts = amount_sums(name)
    return F.expr(f"coalesce(CAST({exact_sql(parts)} AS {MONEY}), CAST({parts['rough']} AS {MONEY}))")


def band(col: Column, limits: Sequence[tuple[float, str]], otherwise: str, null_band: str | None = None) -> Column:
    """Ordered CASE: first ``value < limit`` wins, else ``otherwise``.

    As in the reference, NULL falls through to ``otherwise`` unless
    ``null_band`` names a separate label for unknown values.
    """
    expr = None
    if null_band is not None:
        expr = F.when(col.isNull(), F.lit(null_band))
    for limit, label in limits:
        expr = F.when(col < limit, F.lit(label)) if expr is None else expr.when(col < limit, F.lit(label))
    return expr.otherwise(F.lit(otherwise)) if expr is not None else F.lit(otherwise)


def flag(cond: Column) -> Column:
    """1 where ``cond`` is true, else 0 (NULL counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def surrogate_id(
    cols: DataFrame | Iterable[str],
    natural: str,
    parts: Sequence[str],
    sep: str = "|",
    strict: bool = False,
) -> Column:
    """Natural key as string if that column exists, else SHA-256 hex.

    Faithful mode hashes ``concat_ws(sep, parts)`` where absent parts are
    '' and NULL values are skipped together with their separator (so
    distinct tuples can collide).  ``strict=True`` hashes length-prefixed
    parts with an explicit NULL marker so distinct tuples never collide.
    """
    present = _names(cols)
    if natural in present:
        return F.col(natural).cast("string")
    if not strict:
        return F.sha2(F.concat_ws(sep, *[pick(present, p, default="").cast("string") for p in parts]), 256)
    encoded = []
    for p in parts:
        v = pick(present, p, default="").cast("string")
        encoded.append(F.when(v.isNull(), F.lit("N")).otherwise(F.concat(F.length(v).cast("string"), F.lit(":"), v)))
    return F.sha2(F.concat_ws(sep, *encoded), 256)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double; a zero denominator gives NULL, not an error."""
    return (num.cast("double") / F.nullif(den, F.lit(0)).cast("double")).cast("double")


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """Rounded percentage ``100 * num / den`` as double (NULL if den = 0)."""
    return F.round(F.lit(100.0) * safe_ratio(num, den), digits)


def load_date(value: str | _dt.date | None = None) -> Column:
    """Run date (``current_date()``) or an injected fixed date."""
    if value is None:
        return F.current_date()
    return F.lit(str(value)).cast("date")

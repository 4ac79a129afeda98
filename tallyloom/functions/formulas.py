"""Scalar formulas: dates, money, guarded ratios, bands, commission factors, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def col(c: str | Column) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def money(c: str | Column) -> Column:
    """Round half up to cents and keep an exact decimal."""
    return F.round(col(c), 2).cast(MONEY)


EXACT = "decimal(28,8)"


def _steps(num: Column, den: Column, factor: int, half: bool = True) -> Column:
    """``|num| / den * factor`` as a whole number, rounded half up or cut; exact, for a positive ``den``.

    Only sums, products and a remainder of decimals: the one division left comes out even.
    """
    top = F.abs(num).cast(EXACT) * F.lit(2 * factor).cast("decimal(9,0)")
    bottom = den.cast(EXACT) * 2
    if half:
        top = top + den.cast(EXACT)
    return ((top - top % bottom) / bottom).cast("decimal(28,0)")


def ratio(num: str | Column, den: str | Column, digits: int, scale: int = 1) -> Column:
    """``num / den * scale`` rounded half away from zero to ``digits``, 0 unless the divisor is positive.

    The exact quotient is what is rounded. Doubles decide where they are far enough from a tie to be
    sure; next to one, and where they grow too large to tell, exact decimals do.
    """
    num, den = col(num), col(den)
    factor = scale * 10**digits
    scaled = F.abs(num).cast("double") / den.cast("double") * F.lit(float(factor))
    unsure = F.abs(scaled % F.lit(1.0) - F.lit(0.5)) <= scaled * F.lit(1e-11) + F.lit(1e-9)
    steps = F.when(unsure, _steps(num, den, factor).cast("double")).otherwise(F.floor(scaled + F.lit(0.5)).cast("double"))
    steps = steps / F.lit(float(10**digits))
    return F.when(den > 0, F.when(num < 0, -steps).otherwise(steps)).otherwise(F.lit(0.0))


def percent(num: str | Column, den: str | Column, digits: int = 1) -> Column:
    return ratio(num, den, digits, 100)


def mean(total: str | Column, count: str | Column, digits: int = 2) -> Column:
    return ratio(total, count, digits)


def round_to_multiple(c: str | Column, step: float) -> Column:
    """Nearest multiple of ``step`` (the visual tool's ``Round(x, 0.1)``), not a digit count."""
    step_dec = F.lit(str(step)).cast("decimal(18,6)")
    return (F.round(col(c).cast("decimal(28,10)") / step_dec, 0) * step_dec).cast("decimal(28,6)")


def band(c: str | Column, edges: Sequence[tuple[object, str]], default: str) -> Column:
    """First label whose lower edge the value reaches; edges go from high to low. NULL -> default."""
    out = None
    for edge, label in edges:
        out = F.when(col(c) >= F.lit(edge), label) if out is None else out.when(col(c) >= F.lit(edge), label)
    return F.lit(default) if out is None else out.otherwise(default)


def value_map(c: str | Column, mapping: Mapping, default) -> Column:
    """Exact value -> value, anything else -> default."""
    out = None
    for key, value in mapping.items():
        hit = col(c) == F.lit(key)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return F.lit(default) if out is None else out.otherwise(default)


# --- dates -----------------------------------------------------------------------------------

def quarter_label(d: str | Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(col(d)).cast("string"))


def month_name(d: str | Column) -> Column:
    return F.date_format(col(d), "MMMM")


def month_start(d: str | Column) -> Column:
    return F.trunc(col(d), "MM")


def days_between(later: str | Column, earlier: str | Column) -> Column:
    return F.datediff(col(later), col(earlier))


def parse_date(c: str | Column, fmt: str = "MM/dd/yyyy") -> Column:
    """Text to date; text that is no such date becomes NULL instead of stopping the job."""
    return F.try_to_date(col(c), fmt)


def as_of_date(as_of: str | None = None, text: bool = False, fmt: str = "MM-dd-yyyy") -> Column:
    """Run date, as a date or as formatted text; ``as_of`` (ISO date) pins it for repeatable runs."""
    day = F.to_date(F.lit(as_of)) if as_of else F.current_date()
    return F.date_format(day, fmt) if text else day


# --- text ------------------------------------------------------------------------------------

def is_blank(c: str | Column) -> Column:
    return col(c).isNull() | (F.trim(col(c)) == "")


def cleanse(c: str | Column, trim: bool = True, collapse: bool = True, case: str | None = None) -> Column:
    out = col(c)
    if collapse:
        out = F.regexp_replace(out, r"\s+", " ")
    if trim:
        out = F.trim(out)
    if case is None:
        return out
    cases = {"upper": F.upper, "lower": F.lower, "title": F.initcap}
    if case not in cases:
        raise ValueError(f"case must be one of {sorted(cases)}, got {case!r}")
    return cases[case](out)


def strip_non_printable(c: str | Column) -> Column:
    """Drop every character outside space..tilde."""
    return F.regexp_replace(col(c), "[^ -~]", "")


def text_length(c: str | Column) -> Column:
    """Characters in the text, 1 where it is NULL (so it can serve as a weight)."""
    return F.coalesce(F.length(col(c)), F.lit(1))


def full_name(first: str | Column, last: str | Column) -> Column:
    return F.concat(col(first), F.lit(" "), col(last))


def split_part(c: str | Column, sep: str, parts: int, i: int) -> Column:
    """Piece ``i`` (from 1) of at most ``parts``; the last piece keeps the remainder, a missing one is NULL."""
    return F.get(F.split(col(c), F.lit(_literal_regex(sep)), parts), i - 1)


def _literal_regex(text: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() and not ch.isspace() else ch for ch in text)


def percent_label(num: str | Column, den: str | Column, digits: int = 1) -> Column:
    """1234 of 10000 -> '12.3%': the exact percentage, rounded half away from zero; NULL where the divisor is 0."""
    num, den = col(num), col(den)
    steps = _steps(num, F.abs(den), 100 * 10**digits)
    signed = F.when((num < 0) != (den < 0), -steps).otherwise(steps)
    text = (signed * F.lit(str(10**-digits)).cast(f"decimal({digits + 1},{digits})")).cast(f"decimal(28,{digits})").cast("string")
    return F.when(den != 0, F.concat(text, F.lit("%")))


def truncated_percent_label(num: str | Column, den: str | Column, width: int = 4) -> Column:
    """Leftmost characters of the percentage as text, cut and not rounded: 10.666 -> '10.6%', 100 -> '100%'."""
    num, den = col(num), col(den)
    pct = (_steps(num, den, 100 * 10**4, half=False) * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(28,4)").cast("string")
    plain = F.regexp_replace(pct, r"\.?0+$", "")  # the number's own text has no trailing zeros
    text = F.substring(F.when(num < 0, F.concat(F.lit("-"), plain)).otherwise(plain), 1, width)
    return F.when(den > 0, F.concat(text, F.lit("%")))

"""Column functions whose edge cases the operators rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(x: Column) -> Column:
    """x, or null where it is NaN or infinite."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def holds(condition: Column) -> Column:
    """The condition, false where it is null: a missing measurement never satisfies a criterion."""
    return F.coalesce(condition, F.lit(False))


def least_known(a: Column, b: Column) -> Column:
    """The smaller of two values; null if either is missing (plain least() skips nulls)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def greatest_known(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def wrap_degrees(x: Column) -> Column:
    """An angle in [-180, 180)."""
    return F.pmod(x + 180.0, F.lit(360.0)) - 180.0


def probability(x: Column) -> Column:
    """x if it is in [0, 1], else its logistic value, with x bounded to +-80."""
    bounded = F.greatest(F.least(x, F.lit(80.0)), F.lit(-80.0))
    return F.when(x.between(0.0, 1.0), x).when(x.isNotNull(), 1.0 / (1.0 + F.exp(-bounded)))


def clip(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(high)), F.lit(low)))


def half_even(x: Column) -> Column:
    """Nearest whole number as a long, halves to even."""
    return F.bround(x, 0).cast("long")


def rational(text: Column) -> Column:
    """The value of `a/b` or `a`; 0.0 if it can't be read or b is 0."""
    top = F.split_part(text, F.lit("/"), F.lit(1)).try_cast("double")
    bottom = F.when(F.locate("/", text) > 0, F.split_part(text, F.lit("/"), F.lit(2)).try_cast("double")).otherwise(F.lit(1.0))
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def clock(seconds: Column) -> Column:
    """h:mm:ss of whole seconds, rounded half to even."""
    s = half_even(seconds)
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def top_folder(path: Column) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(1))


def html_escape(text: Column) -> Column:
    out = text
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out


def cpu_list(text: Column) -> Column:
    """`0-3,8` as an array of ints, ascending."""
    parts = F.filter(F.split(F.regexp_replace(text, " ", ""), ","), lambda p: p != "")
    return F.flatten(F.transform(parts, lambda p: F.sequence(F.split_part(p, F.lit("-"), F.lit(1)).cast("int"), F.split_part(p, F.lit("-"), F.lit(-1)).cast("int"))))

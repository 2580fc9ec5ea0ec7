"""Numeric column functions with defined results for nulls, NaN and ties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def rounded(c: Column, places: int) -> Column:
    """Half up in plain floating point, the same in any engine."""
    return F.floor(c * F.lit(10.0**places) + 0.5) / F.lit(10.0**places)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero or either is null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


#: Coefficients of the rational erfc of Numerical Recipes (erfcc), highest power first. Fixed values.
ERFC = (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223)


def two_sided_p(z: Column) -> Column:
    """erfc(|z| / sqrt 2), at most 1; relative error under 1.2e-7. Null for null, so a missing z never passes for p = 1."""
    x = F.abs(z) / F.lit(2.0**0.5)
    t = 1.0 / (1.0 + 0.5 * x)
    poly = F.lit(ERFC[0])
    for c in ERFC[1:]:
        poly = F.lit(c) + t * poly
    return F.when(z.isNotNull(), F.least(F.lit(1.0), t * F.exp(-x * x + poly)))


def same_rows(a: str, b: str, keys) -> Column:
    """Null-safe equality of the keys of two aliased tables: null keys are keys like any other."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.`{k}`").eqNullSafe(F.col(f"{b}.`{k}`"))
    return out


def flag(c: Column) -> Column:
    """A condition as a flag: null is false."""
    return F.coalesce(c, F.lit(False))


def neg_log10(p: Column, cap: float | None = None) -> Column:
    out = -F.log10(F.greatest(p, F.lit(1e-300)))
    out = F.least(F.lit(cap), out) if cap is not None else out
    return F.when(p.isNotNull(), out)


def normal_density(x: Column, mean: Column, sd: Column) -> Column:
    z = (x - mean) / sd
    return F.exp(-0.5 * z * z) / (sd * F.sqrt(F.lit(2.0) * F.pi()))


def sanitized(name: Column, most: int = 80) -> Column:
    """A name safe in paths: other characters become ``_``, runs of it one, none at the ends."""
    safe = F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9._-]", "_"), r"_+", "_")
    return F.substring(F.regexp_replace(safe, r"^_+|_+$", ""), 1, most)

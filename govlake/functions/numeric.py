"""Exact arithmetic beyond DECIMAL(38,0) in column expressions.

``quotient`` divides two whole numbers as PostgreSQL's NUMERIC does: with as many decimals as give at least 16
significant digits, rounded half away from zero. It returns the quotient as a whole number and its scale.
``scaled_product`` multiplies such a quotient by a whole number and a power of ten without losing a digit on the
way: numbers are split into two limbs at a power of ten, by their decimal text. Nothing raises: what doesn't fit
DECIMAL(38,0) is NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DEC = "decimal(38,0)"
# NUMERIC counts in groups of four decimal digits and keeps at least 16 significant ones in a quotient.
GROUP, SIGNIFICANT = 4, 16


def _dec(x) -> Column:
    return F.lit(str(x)).cast(DEC) if isinstance(x, int) else x.cast(DEC)


def _text(x: Column) -> Column:
    return F.abs(x).cast("string")


def _first_group(text: Column) -> Column:
    return F.left(text, F.pmod(F.length(text) - 1, F.lit(GROUP)) + 1).cast("int")


def quotient_scale(num: Column, den: Column) -> Column:
    """Decimals that NUMERIC gives to the quotient of two whole numbers."""
    a, b = _text(num), _text(den)
    weight = F.floor((F.length(a) - 1) / GROUP) - F.floor((F.length(b) - 1) / GROUP)
    weight = weight - F.when(_first_group(a) <= _first_group(b), 1).otherwise(0)
    return F.greatest(F.lit(SIGNIFICANT) - GROUP * weight, F.lit(0)).cast("int")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def quotient(num: Column, den: Column) -> Column:
    """struct(q, scale): num / den = q / 10^scale, by long division; NULL for a zero or too long denominator."""
    ten = _dec(10)

    def step(at: Column, digit: Column, below: Column) -> Column:
        return let(F.try_add(F.try_multiply(at["r"], ten), digit.cast(DEC)).cast(DEC), lambda r: let(
            F.when(r.isNotNull() & (below > 0), F.call_function("div", r, below)).cast(DEC),  # a digit
            lambda n: F.struct(F.try_add(F.try_multiply(at["q"], ten), n).cast(DEC).alias("q"),
                               F.try_subtract(r, F.try_multiply(n, below)).cast(DEC).alias("r"))))

    def divided(v: Column) -> Column:
        digits = F.split(F.concat(_text(v["num"]), F.repeat(F.lit("0"), v["scale"])), "")
        start = F.struct(_dec(0).alias("q"), _dec(0).alias("r"))
        got = F.aggregate(F.filter(digits, lambda d: d != ""), start, lambda at, d: step(at, d, v["below"]))
        return let(got, lambda g: F.try_multiply(
            F.try_add(g["q"], F.when(F.try_add(g["r"], g["r"]) >= v["below"], _dec(1)).otherwise(_dec(0))),
            F.when((v["num"] < 0) != (v["den"] < 0), _dec(-1)).otherwise(_dec(1))).cast(DEC))

    given = F.struct(num.alias("num"), den.alias("den"), F.abs(_dec(den)).alias("below"), quotient_scale(num, den).alias("scale"))
    return let(given, lambda v: let(divided(v), lambda q: F.when(
        (v["den"] != 0) & v["num"].isNotNull() & q.isNotNull(), F.struct(q.alias("q"), v["scale"].alias("scale")))))


def _limbs(x: Column, k: Column) -> Column:
    """struct(high, low) of a whole number x >= 0: x = high * 10^k + low."""
    return let(x.cast("string"), lambda text: let(F.greatest(F.length(text) - k, F.lit(0)), lambda cut: F.struct(
        F.when(cut > 0, F.left(text, cut)).otherwise("0").cast(DEC).alias("high"),
        F.when(k > 0, F.substr(text, cut + 1)).otherwise("0").cast(DEC).alias("low"))))


def _power(k: Column) -> Column:
    """10^k; NULL beyond 37."""
    return F.when(k <= 37, F.rpad(F.lit("1"), F.least(k, F.lit(37)) + 1, F.lit("0"))).cast(DEC)


def scaled_product(x: Column, q: Column, shift: Column) -> Column:
    """x * q * 10^shift for whole numbers, rounded half away from zero; NULL when it has more than 38 digits."""
    def down(v: Column) -> Column:
        # a * b / 10^k = a * b.high + a.high * b.low + a.low * b.low / 10^k
        def total(w: Column) -> Column:
            half = F.try_multiply(_dec(5), _power(v["k"] - 1)).cast(DEC)
            last = F.try_add(F.try_multiply(w["a"]["low"], w["b"]["low"]), half).cast(DEC)
            return F.try_add(F.try_add(F.try_multiply(v["a"], w["b"]["high"]), F.try_multiply(w["a"]["high"], w["b"]["low"])),
                             _limbs(last, v["k"])["high"]).cast(DEC)
        return let(F.struct(_limbs(v["a"], v["k"]).alias("a"), _limbs(v["b"], v["k"]).alias("b")), total)

    def size(v: Column) -> Column:
        up = F.try_multiply(F.try_multiply(v["a"], v["b"]).cast(DEC), _power(F.greatest(v["shift"], F.lit(0)))).cast(DEC)
        return F.when(v["k"] > 0, down(v)).otherwise(up)

    given = F.struct(F.abs(_dec(x)).alias("a"), F.abs(_dec(q)).alias("b"), shift.alias("shift"), F.greatest(-shift, F.lit(0)).alias("k"),
                     ((x < 0) != (q < 0)).alias("negative"))
    return let(given, lambda v: let(size(v), lambda n: F.when(v["negative"], F.try_subtract(_dec(0), n)).otherwise(n).cast(DEC)))

"""Number expressions: guarded division, exact sums, half-up rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOTAL = "decimal(32,0)"  # sums of mantissas: some 10 ** 14 rows of one exponent
STEP = 4  # exponents that share a sum
SHIFT = 54  # makes every mantissa of a shared sum a whole number below 2 ** 60
CARRY = 30  # steps that the largest sum can run over
DIGITS = 24  # hexadecimal digits of a sum that are kept before it is rounded


def half_up(value: Column, places: int) -> Column:
    """Round a double half away from zero.

    Written as scale, shift, floor so that every engine that follows IEEE 754
    gets the same bits (built-in ``round`` differs between engines on 1.005).
    """
    scale = F.lit(float(10**places))
    size = F.floor(F.abs(value.cast("double")) * scale + F.lit(0.5)).cast("double") / scale
    return F.when(value < 0, -size).otherwise(size)


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def exponent_step(value: Column) -> Column:
    """Which shared sum a finite double goes to: its binary exponent in steps of four. An
    exponent taken wrong by one at a power of two does no harm."""
    step = F.floor(F.floor(F.log2(F.abs(value))) / STEP).cast("int")
    return F.when(is_finite(value), F.coalesce(step, F.lit(0)))


def _scaled(value: Column, exponent: Column) -> Column:
    """``value * 2 ** exponent`` in two exact factors, as one may be out of range."""
    half = F.floor(exponent / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)


def mantissa(value: Column, step: Column) -> Column:
    """The whole number ``m`` with ``value = m * 2 ** (4 * step - 54)``."""
    whole = _scaled(value, F.lit(SHIFT) - step * STEP).cast("bigint")
    return F.when(step.isNotNull(), whole)


def exact_total(parts: str) -> Column:
    """The double next to the sum of a column ``parts``, an array of ``(step, total)`` of mantissas.

    Totals are put into hexadecimal digits with carries, from the smallest step up, so that
    what cancels is gone; a sum below zero shows as a carry of -1 and has the complement of its
    digits. The first digits and whether any follow are then rounded, once. NULL without parts.
    (A result below 2.3e-308 is rounded twice.)
    """

    def once(value: str, name: str, use: str) -> str:
        return f"transform(array({value}), {name} -> {use})[0]"

    steps = f"transform({parts}, p -> p.step)"
    here = f"aggregate(filter({parts}, p -> p.step = b), s.carry, (a, p) -> cast(a + p.total AS {TOTAL}))"
    carried = (
        f"named_struct('carry', cast((t - d) / 16BD AS {TOTAL}), "
        "'digits', concat(s.digits, array(cast(d AS int))))"
    )
    add = once(here, "t", once(f"cast(pmod(t, 16BD) AS {TOTAL})", "d", carried))
    zero = f"named_struct('carry', cast(0 AS {TOTAL}), 'digits', cast(array() AS array<int>))"
    total = f"aggregate(sequence(array_min({steps}), array_max({steps}) + {CARRY}), {zero}, (s, b) -> {add})"
    first = "array_position(transform(s.digits, d -> d <> 0), true) - 1"
    turned = f"transform(s.digits, (d, i) -> if(i < {first}, 0, if(i = {first}, 16 - d, 15 - d)))"
    signed = (
        "named_struct('sign', if(s.carry < 0, -1D, 1D), "
        f"'digits', if(s.carry < 0, {turned}, s.digits))"
    )
    taken = f"(s.n > 0 OR m.digits[i] <> 0) AND s.n < {DIGITS}"
    take = (
        f"named_struct('n', if({taken}, s.n + 1, s.n), "
        f"'sum', if({taken}, cast(s.sum * 16BD + m.digits[i] AS {TOTAL}), s.sum), "
        f"'rest', s.rest OR (s.n >= {DIGITS} AND m.digits[i] <> 0), "
        f"'at', if({taken}, i, s.at))"
    )
    begin = f"named_struct('n', 0, 'sum', cast(0 AS {TOTAL}), 'rest', false, 'at', 0)"
    odd = f"cast(cast(s.sum * 2BD + cast(s.rest AS int) AS {TOTAL}) AS double)"  # decides ties
    exponent = f"((array_min({steps}) + s.at) * {STEP} - {SHIFT + 1})"
    scaled = f"m.sign * {odd} * pow(2D, floor({exponent} / 2)) * pow(2D, {exponent} - floor({exponent} / 2))"
    rounded = f"aggregate(sequence(size(m.digits) - 1, 0, -1), {begin}, (s, i) -> {take}, s -> {scaled})"
    return F.expr(f"if(size({parts}) > 0, {once(once(total, 's', signed), 'm', rounded)}, NULL)")


def share_pct(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; NULL when ``whole`` is zero."""
    return part.cast("double") * F.lit(100.0) / F.nullif(whole.cast("double"), F.lit(0.0))


def fail_percent(failed: Column, total: Column) -> Column:
    """Percentage of failures; 0 for an empty table."""
    ratio = failed.cast("double") / F.nullif(total.cast("double"), F.lit(0.0))
    return F.coalesce(ratio * F.lit(100.0), F.lit(0.0))


def number_text(value: Column, places: int) -> Column:
    """Fixed-point text of a number, e.g. ``14.3``."""
    return F.format_string(f"%.{places}f", half_up(value, places))

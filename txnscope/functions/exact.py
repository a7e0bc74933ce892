"""Exact money and percentage aggregates.

Money has two decimal places.  Summing doubles is order dependent, so a
result could change with the partitioning; at 100 TB that makes reruns
disagree.  Sums are therefore taken over integral cents (exact, order
independent) and means / percentages are rounded half-up with integer
arithmetic on the exact totals.  The results are identical on any cluster layout and in any
engine that follows the same definition (the SQL twins below).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _name(col: Column | str) -> str:
    if isinstance(col, str):
        return f"`{col}`"
    raise TypeError("pass a column name")


MONEY_SCALE = 6       # digits of money kept while summing
SPLIT = 20            # cents = hi * 2^20 + lo, 0 <= lo < 2^20


def units(x: Column, scale: int) -> Column:
    """A value with ``scale`` decimals as an integral count of 10^-scale units.

    ``rint`` of the scaled double is exact for such values (they sit within
    float error of an integer) and, unlike a double -> decimal cast, needs no
    BigDecimal per row."""
    return F.rint(x * F.lit(float(10 ** scale))).cast("long")


def units_sum(col: str | Column, scale: int = 2) -> Column:
    """Exact sum of ``units`` as decimal(38,0).

    The units are split into a high and a low part and each is summed as a
    long: the fast, overflow-checked long path per row (a decimal sum builds a
    Decimal per row).  Neither part can overflow below 2^43 (8.8e12) rows per
    group with values under 2^40 units (1.1e10 in money), far beyond 100 TB;
    past that, ANSI arithmetic raises instead of wrapping.  The parts are
    combined once per group."""
    x = F.col(col) if isinstance(col, str) else col
    u = units(x, scale)
    hi = F.sum(F.shiftright(u, SPLIT))
    lo = F.sum(u.bitwiseAND(F.lit((1 << SPLIT) - 1)))
    return hi.cast("decimal(38,0)") * F.lit(1 << SPLIT) + lo.cast("decimal(38,0)")


def money_sum(col: str | Column) -> Column:
    """Sum of a money column rounded to 2 decimals at the end, as double; digits below a cent count."""
    return half_up(units_sum(col, MONEY_SCALE), 10 ** (MONEY_SCALE - 2)).cast("double") / F.lit(100.0)


def half_up(q: Column, by: int) -> Column:
    """q / by rounded half away from zero, for an integral decimal q."""
    a = F.abs(q) + F.lit(by // 2)
    return F.signum(q).cast("decimal(1,0)") * ((a - a % by) / by).cast("decimal(38,0)")


def exact_mean(col: str, scale_in: int = 2, places: int = 2, mult: int = 1) -> Column:
    """mean(col) * mult rounded half-up to ``places``, for a column that has
    ``scale_in`` decimals.  The sum is exact (decimal) and the rounding is an
    integral division, so no float error enters."""
    x = _name(col)
    u = f"cast(rint({x} * {float(10 ** scale_in)}) AS bigint)"
    q = (f"(cast(sum(shiftright({u}, {SPLIT})) AS decimal(38,0)) * {1 << SPLIT} "
         f"+ cast(sum({u} & {(1 << SPLIT) - 1}) AS decimal(38,0)))")
    n = f"count({x})"
    num = f"(abs({q}) * {2 * mult * 10 ** places} + {n} * {10 ** scale_in})"
    den = f"(2 * {n} * {10 ** scale_in})"
    return F.expr(
        f"CASE WHEN {n} = 0 THEN NULL ELSE "
        f"signum({q}) * ({num} div {den}) / {float(10 ** places)} END")


def money_avg(col: str) -> Column:
    """Mean of a money column rounded half-up to 2 places, computed exactly."""
    return exact_mean(col, MONEY_SCALE, 2)


def half_up_ratio(num: Column, den: Column, scale: int, places: int) -> Column:
    """round(num / den * scale, places) half-up, exact for integral num/den >= 0.

    Zero denominator gives 0 (the stream and KPI convention)."""
    k = scale * 10 ** places
    a = num.cast("decimal(38,0)") * F.lit(2 * k) + den.cast("decimal(38,0)")
    b = den.cast("decimal(38,0)") * 2
    # floor(a / b) without a rounded decimal quotient: a - a % b is a multiple of b.
    quotient = (a - a % b) / b
    return F.when(den == 0, F.lit(0.0)).otherwise(
        quotient.cast("long").cast("double") / F.lit(float(10 ** places)))


def pct(num: Column, den: Column, places: int) -> Column:
    return half_up_ratio(num, den, 100, places)


# --- SQL twins (DuckDB dialect) -------------------------------------------
def sql_units(x: str, scale: int) -> str:
    return f"CAST(round({x} * {float(10 ** scale)}) AS BIGINT)"


def sql_money_sum(x: str) -> str:
    return f"round(CAST(sum({sql_units(x, MONEY_SCALE)}) AS DOUBLE) / {float(10 ** MONEY_SCALE)}, 2)"


def sql_exact_mean(x: str, scale_in: int = 2, places: int = 2, mult: int = 1) -> str:
    q = f"CAST(sum({sql_units(x, scale_in)}) AS HUGEINT)"
    n = f"count({x})"
    num = f"(abs({q}) * {2 * mult * 10 ** places} + {n} * {10 ** scale_in})"
    den = f"(2 * {n} * {10 ** scale_in})"
    return (f"(CASE WHEN {n} = 0 THEN NULL ELSE "
            f"CAST(sign({q}) * ({num} // {den}) AS DOUBLE) / {float(10 ** places)} END)")


def sql_money_avg(x: str) -> str:
    return sql_exact_mean(x, MONEY_SCALE, 2)


def sql_pct(num: str, den: str, places: int, scale: int = 100) -> str:
    k = scale * 10 ** places
    return (f"(CASE WHEN {den} = 0 THEN 0.0 ELSE CAST((CAST({num} AS HUGEINT) * {2 * k} + {den}) "
            f"// (2 * CAST({den} AS HUGEINT)) AS DOUBLE) / {float(10 ** places)} END)")

"""Math on numbers of log fields. Not-a-number is null, and null operands give null unless stated.

Operands are Columns; Python's own precedence applies, so use parentheses.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal
from functools import reduce, wraps

from pyspark.sql import Column
from pyspark.sql import functions as F

from skeinlog.functions.coerce import math_number
from skeinlog.functions.timespan import micros_of


_MARK = "__skeinlog_number"


def _made(c: Column) -> Column:
    """Marks a result of this module: a number that needs no reading from text."""
    c.__dict__[_MARK] = True
    return c


def numeric(function):
    """Results are clean numbers: not-a-number is null."""
    @wraps(function)
    def run(*args, **named):
        return _made(_clean(function(*args, **named)))

    return run


def _d(x) -> Column:
    """Operand as a number. Text is read as the values of fields are: ``5ms``, ``1KB``, times and addresses too."""
    if not isinstance(x, Column):
        return F.lit(x).cast("double") if not isinstance(x, str) else math_number(F.lit(x))
    if x.__dict__.get(_MARK):
        return x
    number = F.typeof(x).rlike("^(tinyint|smallint|int|bigint|float|double|decimal.*)$")
    return _clean(F.when(number, x.try_cast("double")).otherwise(math_number(x.cast("string"))))


def _clean(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


@numeric
def pow_(a, b) -> Column:
    return F.pow(_d(a), _d(b))


@numeric
def mul(a, b) -> Column:
    return _d(a) * _d(b)


@numeric
def div(a, b) -> Column:
    """Quotient; null for a zero divisor."""
    return F.try_divide(_d(a), _d(b))


@numeric
def mod(a, b) -> Column:
    """Remainder with the sign of ``a``; null for a zero divisor."""
    return F.try_mod(_d(a), _d(b))


@numeric
def add(a, b) -> Column:
    return _d(a) + _d(b)


@numeric
def sub(a, b) -> Column:
    return _d(a) - _d(b)


_HALF, _FULL = float(1 << 63), float(1 << 64)


def _bits(x) -> Column:
    """64 bits of a whole number; those from 2^63 on are the upper half of unsigned ones."""
    v = _d(x)
    return F.when(v >= _HALF, (v - F.lit(_FULL)).try_cast("bigint")).otherwise(v.try_cast("bigint"))


def _whole(a, b, bits: Column) -> Column:
    """Bits of operands that are not negative make an unsigned number."""
    signed = bits.cast("double")
    return F.when((bits < 0) & (_d(a) >= 0) & (_d(b) >= 0), signed + F.lit(_FULL)).otherwise(signed)


@numeric
def bit_and(a, b) -> Column:
    return _whole(a, b, _bits(a).bitwiseAND(_bits(b)))


@numeric
def bit_xor(a, b) -> Column:
    return _whole(a, b, _bits(a).bitwiseXOR(_bits(b)))


@numeric
def bit_or(a, b) -> Column:
    return _whole(a, b, _bits(a).bitwiseOR(_bits(b)))


@numeric
def default(a, b) -> Column:
    """``b`` where ``a`` is no number."""
    return F.coalesce(_d(a), _d(b))


@numeric
def abs_(x) -> Column:
    return F.abs(_d(x))


@numeric
def exp(x) -> Column:
    return F.exp(_d(x))


@numeric
def ln(x) -> Column:
    return F.ln(_d(x))


@numeric
def max_(*xs) -> Column:
    """Largest operand, nulls skipped."""
    return reduce(lambda a, b: F.greatest(a, b), [_d(x) for x in xs])


@numeric
def min_(*xs) -> Column:
    return reduce(lambda a, b: F.least(a, b), [_d(x) for x in xs])


# From 2^53 on every double is a whole number.
_WHOLE = float(1 << 53)


@numeric
def round_(x, nearest=None) -> Column:
    """Half away from zero, to whole numbers or to a multiple of ``nearest``, a number or a Column."""
    v = _d(x)
    if nearest is None:
        return F.when(F.abs(v) < _WHOLE, F.round(v)).otherwise(v)
    unit = _d(nearest)
    done = F.signum(v) * F.floor(F.try_divide(F.abs(v), unit) + 0.5) * unit
    if isinstance(nearest, Column):
        # the digits of the unit are not known beforehand; fifteen are what a double holds
        return F.when(F.abs(done) < 1e15, done.cast("decimal(38,15)").cast("double")).otherwise(done)
    return F.round(done, max(0, -Decimal(repr(float(nearest))).as_tuple().exponent))


@numeric
def ceil(x) -> Column:
    v = _d(x)
    return F.when(F.abs(v) < _WHOLE, F.ceil(v).cast("double")).otherwise(v)


@numeric
def floor(x) -> Column:
    v = _d(x)
    return F.when(F.abs(v) < _WHOLE, F.floor(v).cast("double")).otherwise(v)


@numeric
def neg(x) -> Column:
    return -_d(x)


@numeric
def rand(seed: int | None = None) -> Column:
    """Uniform in [0, 1), one draw per row."""
    return F.rand(seed) if seed is not None else F.rand()


@numeric
def now(at: datetime | None = None) -> Column:
    """Unix nanoseconds: the given moment, or the start of the query for all rows."""
    if at is not None:
        return F.lit(float(micros_of(at) * 1000))
    return (F.unix_micros(F.current_timestamp()) * 1000).cast("double")

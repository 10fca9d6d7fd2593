"""Text to number coercion as Catalyst expressions, and the table job over them."""

from __future__ import annotations

import math
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinlog.model import col, field_name, quoted, val

# ---- fixed values: units in nanoseconds and bytes, number shapes -----------
DURATION_UNITS = {
    "ns": 1,
    "us": 1_000,
    "µs": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60_000_000_000,
    "h": 3_600_000_000_000,
    "d": 86_400_000_000_000,
    "w": 604_800_000_000_000,
    "y": 31_536_000_000_000_000,
}
BYTE_UNITS = {
    "KiB": 1 << 10,
    "MiB": 1 << 20,
    "GiB": 1 << 30,
    "TiB": 1 << 40,
    "Ki": 1 << 10,
    "Mi": 1 << 20,
    "Gi": 1 << 30,
    "Ti": 1 << 40,
    "KB": 1_000,
    "MB": 1_000_000,
    "GB": 1_000_000_000,
    "TB": 1_000_000_000_000,
    "B": 1,
    "K": 1_000,
    "M": 1_000_000,
    "G": 1_000_000_000,
    "T": 1_000_000_000_000,
}
_DIGITS = r"[0-9][0-9_]*(?:\.[0-9_]*[0-9])?"
_DUR_UNIT = "ns|us|µs|ms|s|m|h|d|w|y"
_BYTE_UNIT = "KiB|MiB|GiB|TiB|Ki|Mi|Gi|Ti|KB|MB|GB|TB|B|K|M|G|T"
DECIMAL_SHAPE = rf"^-?{_DIGITS}$"
DURATION_SHAPE = rf"^-?(?:{_DIGITS}(?:{_DUR_UNIT}))+$"
BYTES_SHAPE = rf"^-?(?:{_DIGITS}(?:{_BYTE_UNIT}))*(?:{_DIGITS}(?:{_BYTE_UNIT})|[0-9][0-9_]*(?:\.0+)?)$"
FLOAT_SHAPE = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
HEX_SHAPE = r"^[+-]?0[xX][0-9a-fA-F]+$"
BIN_SHAPE = r"^[+-]?0[bB][01]+$"
OCT_SHAPE = r"^[+-]?0[oO][0-7]+$"
IPV4_SHAPE = r"^\d{1,3}(?:\.\d{1,3}){3}$"
TIMESTAMP_SHAPE = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2})(?:\.(\d{1,9}))?(Z|[+-]\d{2}:\d{2})?$"
# ----------------------------------------------------------------------------

MAX_LONG = (1 << 63) - 1


def plain_number(text: Column) -> Column:
    return F.regexp_replace(text, "_", "").try_cast("double")


def _signed_parts(text: Column, unit_re: str, units: dict[str, int]) -> Column:
    """Sum of number+unit parts with the sign in front; saturates at the 64-bit maximum."""
    pattern = F.lit(f"({_DIGITS})({unit_re}|$)")
    numbers = F.regexp_extract_all(text, pattern, F.lit(1))
    names = F.regexp_extract_all(text, pattern, F.lit(2))
    scale = F.expr("map(" + ", ".join(f"'{k}', {v}D" for k, v in {**units, "": 1}.items()) + ")")
    parts = F.zip_with(numbers, names, lambda n, u: F.floor(plain_number(n) * F.element_at(scale, u)).cast("decimal(38,0)"))
    total = F.aggregate(parts, F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x).cast("decimal(38,0)"))
    capped = F.least(total, F.lit(MAX_LONG).cast("decimal(38,0)")).cast("bigint")
    return F.when(text.startswith("-"), -capped).otherwise(capped)


def duration_ns(f) -> Column:
    """``1h5m3.2s`` to nanoseconds, null for other text."""
    text = val(f)
    return F.when(text.rlike(DURATION_SHAPE), _signed_parts(text, _DUR_UNIT, DURATION_UNITS))


def bytes_(f) -> Column:
    """``1.5KiB`` to bytes; a bare fraction is not a size."""
    text = val(f)
    return F.when(text.rlike(BYTES_SHAPE), _signed_parts(text, _BYTE_UNIT, BYTE_UNITS))


def _radix(text: Column, base: int) -> Column:
    digits = F.regexp_replace(text, "^[+-]?0[xXbBoO]", "")
    number = F.conv(digits, base, 10).cast("double")
    return F.when(text.startswith("-"), -number).otherwise(number)


def likely_number(f) -> Column:
    text = val(f)
    return (
        F.when(text.rlike(FLOAT_SHAPE), text.try_cast("double"))
        .when(text.rlike(HEX_SHAPE), _radix(text, 16))
        .when(text.rlike(BIN_SHAPE), _radix(text, 2))
        .when(text.rlike(OCT_SHAPE), _radix(text, 8))
    )


def num(f, df: DataFrame | None = None) -> Column:
    """Number held by a field: decimal, then duration, then size, then other number forms.

    With ``df`` a numeric column is used as it is. Otherwise the type is known
    to the optimizer, which folds the test away, so numeric columns are never
    turned into text and comparisons on them still reach the scan.
    """
    if df is not None:
        from skeinlog.model import is_numeric

        if is_numeric(df, f):
            return _no_nan(col(f).cast("double"))
        return _text_num(f)
    c = col(f)
    numeric = F.typeof(c).rlike("^(tinyint|smallint|int|bigint|float|double|decimal.*)$")
    return F.when(numeric, c.try_cast("double")).otherwise(_text_num(f))


def _no_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def _text_num(f) -> Column:
    text = val(f)
    return (
        F.when(text == "", F.lit(None).cast("double"))
        .when(text.rlike(DECIMAL_SHAPE), plain_number(text))
        .otherwise(F.coalesce(duration_ns(f).cast("double"), bytes_(f).cast("double"), likely_number(f)))
    )


def ipv4_num(f) -> Column:
    """Dotted quad to a number below 2^32, null for other text."""
    text = val(f)
    octets = F.transform(F.split(text, r"\."), lambda x: x.cast("bigint"))
    number = F.aggregate(octets, F.lit(0).cast("bigint"), lambda a, x: a * 256 + x)
    return F.when(text.rlike(IPV4_SHAPE), F.when(F.forall(octets, lambda x: x <= 255), number))


def ts_ns(f) -> Column:
    """RFC3339 text with up to nine fraction digits to nanoseconds."""
    text = val(f)
    whole = F.concat(F.regexp_extract(text, TIMESTAMP_SHAPE, 1), F.regexp_extract(text, TIMESTAMP_SHAPE, 3))
    digits = F.rpad(F.regexp_extract(text, TIMESTAMP_SHAPE, 2), 9, "0").cast("bigint")
    ns = F.unix_seconds(whole.try_cast("timestamp")) * F.lit(1_000_000_000) + digits
    return F.when(text.rlike(TIMESTAMP_SHAPE), ns)


def math_number(f) -> Column:
    """Literals of math expressions also take timestamps (ns) and IPv4 addresses."""
    return F.coalesce(num(f), ts_ns(f).cast("double"), ipv4_num(f).cast("double"))


def duration_text(ns: Column) -> Column:
    """Nanoseconds to ``1w2d3h4m5.6s``; zero parts are left out. Decimals may go beyond 64 bits."""
    u = DURATION_UNITS

    def whole(rest, unit):
        return F.when(rest >= u[unit], F.concat(F.floor(rest / F.lit(u[unit])).cast("string"), F.lit(unit))).otherwise("")

    # weeks are told in the type of the number; what is left of it is below 2^53, so doubles divide it right
    left = ns % u["w"]
    weeks, rest = F.floor(F.abs(ns - left) / F.lit(u["w"]).cast("decimal(20,0)")), F.abs(left.cast("bigint"))
    head = [F.when(ns != left, F.concat(weeks.cast("string"), F.lit("w"))).otherwise("")]
    for unit in ("d", "h", "m"):
        head.append(whole(rest, unit))
        rest = rest % u[unit]
    seconds = F.concat(F.regexp_replace((rest / F.lit(1e9)).cast("string"), r"\.0$", ""), F.lit("s"))
    ms, us = rest % u["s"], rest % u["ms"]
    small = F.concat(
        whole(ms, "ms"),
        F.when(us >= 1000, F.concat(F.floor(us / 1000).cast("string"), F.lit("µs"))).otherwise(""),
        F.when(us % 1000 > 0, F.concat((us % 1000).cast("string"), F.lit("ns"))).otherwise(""),
    )
    # the sign stands beside the parts, not around them: what they share is told once
    sign = F.when(ns == 0, F.lit("0")).when(ns < 0, F.lit("-")).otherwise("")
    return F.concat(sign, *head, F.when(rest >= u["s"], seconds).otherwise(small))


def float_text(c: Column) -> Column:
    """Shortest text of a number: ``5`` for 5.0, exponent form below 1e-4 and from 1e21 on."""
    d = c.cast("double")
    sci = F.regexp_extract(d.cast("string"), r"^(-?[0-9.]+)E(-?[0-9]+)$", 1)
    exp = F.regexp_extract(d.cast("string"), r"^(-?[0-9.]+)E(-?[0-9]+)$", 2).try_cast("int")
    exp_text = F.concat(F.when(exp < 0, "-").otherwise("+"), F.lpad(F.abs(exp).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exp).cast("string"))), F.lit("0")))
    plain = F.regexp_replace(F.regexp_replace(d.cast("decimal(38,16)").cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return (
        F.when(F.isnan(d), "NaN")
        .when(d == float("inf"), "+Inf")
        .when(d == float("-inf"), "-Inf")
        .when(d == 0, "0")
        .when((F.abs(d) >= 1e21) | (F.abs(d) < 1e-4), F.concat(F.regexp_replace(sci, r"\.0$", ""), F.lit("e"), exp_text))
        .when(exp.isNotNull(), plain)
        .otherwise(F.regexp_replace(d.cast("string"), r"\.0$", ""))
    )


# Times as text: UTC, as the session, with all their digits.
RFC3339 = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def text_of(df: DataFrame, f) -> Column:
    """Field as log text, never null: doubles and floats by ``float_text``, times as RFC 3339, the rest as they print."""
    kind = df.schema[field_name(f)].dataType if isinstance(f, str) and field_name(f) in df.columns else None
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # a float counts as the number that it prints
        c = col(f) if isinstance(kind, T.DoubleType) else col(f).cast("string").cast("double")
        return F.coalesce(float_text(c), F.lit(""))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(F.date_format(col(f), RFC3339), F.lit(""))
    return val(f)


def logged_number(text: str) -> float | None:
    """The double that is written so in logs; None if the text is another spelling of a number, or of none."""
    if text in ("NaN", "+Inf", "-Inf"):
        return float(text.lower())
    try:
        number = Decimal(text)
    except InvalidOperation:
        return None
    if not number.is_finite() or not math.isfinite(float(number)):
        return None
    sign, digits, exponent = number.normalize().as_tuple()
    if number == 0:
        return 0.0 if text == "0" else None
    point, digits = len(digits) + exponent, "".join(map(str, digits))
    if -4 < point <= 21:
        whole = digits[:point].ljust(point, "0") if point > 0 else "0"
        rest = digits[point:] if point > 0 else "0" * -point + digits
        form = whole + (f".{rest}" if rest else "")
    else:
        form = digits[0] + (f".{digits[1:]}" if digits[1:] else "") + f"e{point - 1:+03d}"
    return float(number) if ("-" if sign else "") + form == text and len(digits) <= 17 else None


COERCIONS = {
    "num": num,
    "duration": duration_ns,
    "bytes": bytes_,
    "ipv4": ipv4_num,
    "timestamp_ns": ts_ns,
}


def coerce(df: DataFrame, kinds: dict[str, str], observation: Observation | None = None) -> DataFrame:
    """Turn text columns into typed ones.

    With an ``observation`` the values that were present but could not be read
    are counted per column (``bad_<column>``) while the job runs.
    """
    typed = {name: COERCIONS[kind](name) for name, kind in kinds.items()}
    done = df.withColumns({f"__c_{n}": c for n, c in typed.items()})
    if observation is not None:
        bad = [F.count_if((val(n) != "") & F.col(quoted(f"__c_{n}")).isNull()).alias(f"bad_{n}") for n in kinds]
        done = done.observe(observation, *bad)
    return done.withColumns({n: F.col(quoted(f"__c_{n}")) for n in kinds}).drop(*[f"__c_{n}" for n in kinds])

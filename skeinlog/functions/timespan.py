"""Arguments given as text when a plan is built: durations, sizes, partial dates."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from skeinlog.functions.coerce import BYTE_UNITS, DURATION_UNITS

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_PARTIAL = re.compile(
    r"^(?P<y>\d{4})(?:-(?P<mo>\d{2})(?:-(?P<d>\d{2})(?:[T ](?P<h>\d{2})(?::(?P<mi>\d{2})(?::(?P<s>\d{2})(?:\.(?P<f>\d{1,9}))?)?)?)?)?)?"
    r"(?P<tz>Z|[+-]\d{2}:\d{2})?$"
)
_UNIX = re.compile(r"^(?P<whole>\d{5,})(?:\.(?P<f>\d{1,9}))?$")


def _amount(text: str, units: dict[str, int], what: str) -> int:
    names = "|".join(sorted(units, key=len, reverse=True))
    body = text.lstrip("+-")
    parts = re.findall(rf"([0-9][0-9_]*(?:\.[0-9]+)?)({names})", body)
    if not parts or "".join(n + u for n, u in parts) != body:
        raise ValueError(f"cannot read {text!r} as {what}")
    total = sum(int(float(n.replace("_", "")) * units[u]) for n, u in parts)
    return -total if text.startswith("-") else total


def duration(value: str | int | timedelta) -> int:
    """Nanoseconds of ``"1h30m"``, a timedelta, or a plain number of nanoseconds."""
    if isinstance(value, timedelta):
        return (value // timedelta(microseconds=1)) * 1000
    if isinstance(value, (int, float)):
        return int(value)
    return _amount(value, DURATION_UNITS, "a duration")


def number(value: str | int | float) -> float:
    """Number, duration (ns) or size given as text."""
    if isinstance(value, (int, float)):
        return float(value)
    try:
        return float(value.replace("_", ""))
    except ValueError:
        pass
    for units, what in ((DURATION_UNITS, "a duration"), (BYTE_UNITS, "a size")):
        try:
            return float(_amount(value, units, what))
        except ValueError:
            continue
    raise ValueError(f"cannot read {value!r} as a number")


def micros_of(moment: datetime) -> int:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return (moment - _EPOCH) // timedelta(microseconds=1)


def _next_month(moment: datetime) -> datetime:
    year, month = divmod(moment.year * 12 + moment.month, 12)
    return moment.replace(year=year, month=month + 1)


def span(value: str | datetime, now: datetime | None = None) -> tuple[int, int]:
    """First microsecond of a partial date and the first one after it.

    ``2025`` covers the year, ``2025-05`` the month, ``2025-05-20T10`` the hour.
    Digits alone are unix seconds, milliseconds, microseconds or nanoseconds by length.
    """
    if isinstance(value, datetime):
        start = micros_of(value)
        return start, start + 1
    if value == "now":
        start = micros_of(now or datetime.now(timezone.utc))
        return start, start + 1
    m = _PARTIAL.match(value)
    if m:
        parts = m.groupdict()
        local = datetime(int(parts["y"]), int(parts["mo"] or 1), int(parts["d"] or 1), int(parts["h"] or 0),
                         int(parts["mi"] or 0), int(parts["s"] or 0), tzinfo=timezone.utc)
        if parts["mo"] is None:
            until = local.replace(year=local.year + 1)
        elif parts["d"] is None:
            until = _next_month(local)
        else:
            unit = "d" if parts["h"] is None else "h" if parts["mi"] is None else "m" if parts["s"] is None else "s"
            until = local + timedelta(microseconds=DURATION_UNITS[unit] // 1000)
        shift = 0
        if parts["tz"] not in (None, "Z"):
            hours, minutes = parts["tz"][1:].split(":")
            shift = (int(hours) * 60 + int(minutes)) * 60_000_000 * (-1 if parts["tz"][0] == "-" else 1)
        start, end = micros_of(local) - shift, micros_of(until) - shift
        if parts["f"]:
            start += int(parts["f"].ljust(9, "0")) // 1000
            end = start + (1000 if len(parts["f"]) == 3 else 1)
        return start, end
    m = _UNIX.match(value)
    if m:
        whole, frac = m["whole"], m["f"]
        if frac:
            start = int(whole) * 1_000_000 + int(frac.ljust(9, "0")) // 1000
            return start, start + (1000 if len(frac) == 3 else 1)
        if len(whole) <= 10:
            return int(whole) * 1_000_000, (int(whole) + 1) * 1_000_000
        if len(whole) <= 13:
            return int(whole) * 1000, (int(whole) + 1) * 1000
        if len(whole) <= 16:
            return int(whole), int(whole) + 1
        return int(whole) // 1000, int(whole) // 1000 + 1
    raise ValueError(f"cannot read {value!r} as a time")


def moment(micros: int) -> Column:
    """Timestamp literal that the scan can compare against file statistics."""
    return F.lit(_EPOCH + timedelta(microseconds=micros))


def interval(ns: int) -> Column:
    return F.lit(timedelta(microseconds=ns // 1000))

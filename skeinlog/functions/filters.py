"""Predicates over log fields. Every one is a boolean Column that is never null."""

from __future__ import annotations

import itertools
import re
from decimal import Decimal
from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinlog.functions import timespan
from skeinlog.functions.coerce import ipv4_num, logged_number, num
from skeinlog.model import EXTRA, STREAM, STREAM_ID, TIME, col, expand, is_text, out, sort_key, val

# ---- fixed values: word characters, placeholders, weekdays -----------------
WORD = r"[\p{L}\p{Nd}_]"
PLACEHOLDERS = {
    "<N>": r"(?:0[xX][0-9a-fA-F]+|[0-9a-fA-F]{4,}|[0-9]+)",
    "<UUID>": r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    "<IP4>": r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}",
    "<TIME>": r"\d{2}:\d{2}:\d{2}(?:[.,]\d+)?",
    "<DATE>": r"\d{4}[-/]\d{2}[-/]\d{2}",
    "<DATETIME>": r"\d{4}[-/]\d{2}[-/]\d{2}[T ]\d{2}:\d{2}:\d{2}(?:[.,]\d+)?(?:Z|[+-]\d{2}:?\d{2})?",
    "<W>": r"(?:\"(?:[^\"\\]|\\.)*\"|[\p{L}\p{Nd}_]+)",
}
WEEKDAYS = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")
MAX_COMMON_CASE_CAPITALS = 10
# ----------------------------------------------------------------------------

_META = re.compile(r"([\\.\[\]{}()*+?^$|/-])")


def literal_re(text: str) -> str:
    """Regex that matches the text itself, in Java and RE2 alike."""
    return _META.sub(r"\\\1", text)


def _is_word(ch: str) -> bool:
    return ch == "_" or ch.isalpha() or ch.isdecimal()


def _bounded(phrase: str, right: bool = True) -> str:
    """Regex of a phrase with word boundaries where its edges are word characters.

    The text itself comes first, so the search skips to it and looks around only there.
    """
    text = literal_re(phrase)
    head = f"(?<!{WORD}{text})" if _is_word(phrase[0]) else ""
    tail = f"(?!{WORD})" if right and _is_word(phrase[-1]) else ""
    return text + head + tail


def user_re(pattern: str) -> str:
    """Check a user regex: only constructs that mean the same in Java and RE2."""
    if re.search(r"\(\?(?:[=!]|<[=!]|>)", pattern) or re.search(r"\\[1-9]", pattern):
        raise ValueError(f"lookaround and back-references are not supported: {pattern!r}")
    return _line_ends(pattern.replace("(?P<", "(?<"))


def _line_ends(pattern: str) -> str:
    """``$`` as the very end: Java's also stands before a last newline. Not with (?m), where both mean line ends."""
    if re.search(r"\(\?[a-z]*m", pattern):
        return pattern
    return re.sub(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|\$", lambda m: r"\z" if m[0] == "$" else m[0], pattern, flags=re.S)


# ---- logic -----------------------------------------------------------------


def all_rows() -> Column:
    return F.lit(True)


def and_(*preds: Column) -> Column:
    return reduce(lambda a, b: a & b, preds, F.lit(True)) if preds else all_rows()


def or_(*preds: Column) -> Column:
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def not_(pred: Column) -> Column:
    return ~pred


# ---- text ------------------------------------------------------------------


def _phrase(text: Column, phrase: str) -> Column:
    if phrase == "":
        return text == ""
    return text.contains(phrase) & text.rlike(_bounded(phrase))


def _prefix(text: Column, prefix: str) -> Column:
    if prefix == "":
        return text != ""
    return text.contains(prefix) & text.rlike(_bounded(prefix, right=False))


def phrase(f, text: str) -> Column:
    """Word or phrase; the empty phrase matches rows without the field."""
    return _phrase(val(f), text)


def prefix(f, text: str) -> Column:
    """A word starts with the text; the empty prefix matches any value."""
    return _prefix(val(f), text)


def substring(f, text: str) -> Column:
    return val(f).contains(text) if text else all_rows()


def exact(f, text: str) -> Column:
    return _one_of(f, [text])


def _one_of(f, texts: Sequence[str]) -> Column:
    """The value is one of the texts. Doubles are compared as numbers; the optimizer knows the type and keeps one test."""
    plain = val(f) == texts[0] if len(texts) == 1 else val(f).isin(list(texts))
    numbers = [x for x in map(logged_number, texts) if x is not None]
    double = F.coalesce(val(f).try_cast("double").isin(numbers), F.lit(False)) if numbers else F.lit(False)
    if "" in texts:
        double = double | (val(f) == "")
    return F.when(F.typeof(col(f)) == "double", double).otherwise(plain)


def exact_prefix(f, text: str) -> Column:
    return val(f).startswith(text)


def any_case_phrase(f, text: str) -> Column:
    return _phrase(F.lower(val(f)), text.lower())


def any_case_prefix(f, text: str) -> Column:
    return _prefix(F.lower(val(f)), text.lower())


def regexp(f, pattern: str) -> Column:
    """Regex search anywhere in the value."""
    if pattern in ("", ".*"):
        return all_rows()
    if pattern == ".+":
        return val(f) != ""
    return val(f).rlike(user_re(pattern))


def seq(f, *phrases: str) -> Column:
    """Phrases appear in this order."""
    phrases = [p for p in phrases if p]
    if not phrases:
        return all_rows()
    text = val(f)
    return and_(*[text.contains(p) for p in phrases], text.rlike("(?s)" + ".*?".join(_bounded(p) for p in phrases)))


def in_(f, *values: str) -> Column:
    if "*" in values:
        return all_rows()
    return _one_of(f, list(values)) if values else F.lit(False)


def contains_any(f, *phrases: str) -> Column:
    return all_rows() if "*" in phrases else any_phrase(f, phrases)


def any_phrase(f, phrases: Sequence[str]) -> Column:
    """One alternation over all phrases."""
    if not phrases:
        return F.lit(False)
    text = val(f)
    words = sorted({p for p in phrases if p})
    hit = text.rlike("|".join(_bounded(p) for p in words)) if words else F.lit(False)
    return (text == "") | hit if "" in phrases else hit


def contains_all(f, *phrases: str) -> Column:
    if "*" in phrases:
        return all_rows()
    return and_(*[phrase(f, p) for p in phrases])


def common_case_phrases(phrases: Sequence[str]) -> list[str]:
    """Each capital kept or lowered, and the all-capital form."""
    found = set()
    for p in phrases:
        if sum(c.isupper() for c in p) > MAX_COMMON_CASE_CAPITALS:
            raise ValueError(f"too many common-case combinations for {p!r}")
        choices = [(c, c.lower()) if c.isupper() else (c,) for c in p]
        found |= {"".join(v) for v in itertools.product(*choices)}
        found |= {v.upper() for v in found if v.upper() == p.upper()} | {p.upper()}
    return sorted(found)


def contains_common_case(f, *phrases: str) -> Column:
    return contains_any(f, *common_case_phrases(phrases))


def equals_common_case(f, *phrases: str) -> Column:
    return in_(f, *common_case_phrases(phrases))


def pattern_regex(pattern: str, where: str = "anywhere") -> str:
    pieces = re.split("(" + "|".join(re.escape(p) for p in PLACEHOLDERS) + ")", pattern)
    body = "".join(PLACEHOLDERS.get(p) or literal_re(p) for p in pieces)
    head = "^" if where in ("full", "prefix") else ""
    tail = r"\z" if where in ("full", "suffix") else ""
    return "(?s)" + head + body + tail


def pattern_match(f, pattern: str, where: str = "anywhere") -> Column:
    """Text with placeholders such as ``<N>``; ``where`` is anywhere, full, prefix or suffix."""
    if where not in ("anywhere", "full", "prefix", "suffix"):
        raise ValueError(f"unknown match mode {where!r}")
    return val(f).rlike(pattern_regex(pattern, where))


def json_array_contains_any(f, *values: str) -> Column:
    items = F.from_json(val(f), "array<string>")
    return F.coalesce(F.arrays_overlap(items, F.array(*[F.lit(v) for v in values])), F.lit(False))


# ---- numbers and order -----------------------------------------------------


def _between(x: Column, lo, hi, ends: str = "[]") -> Column:
    low = x >= lo if ends[0] == "[" else x > lo
    high = x <= hi if ends[1] == "]" else x < hi
    return x.isNotNull() & low & high


def range_(f, lo, hi, ends: str = "[]") -> Column:
    """Number between two bounds, either end open or closed. Never true for NaN."""
    lo, hi = timespan.number(lo), timespan.number(hi)
    if hi == float("inf"):
        ends = ends[0] + "]"
    return _between(num(f), lo, hi, ends)


def _is_number(x) -> bool:
    try:
        timespan.number(x)
        return True
    except (ValueError, AttributeError):
        return False


def gt(f, x) -> Column:
    return range_(f, x, float("inf"), "(]") if _is_number(x) else val(f) > x


def ge(f, x) -> Column:
    return range_(f, x, float("inf"), "[]") if _is_number(x) else val(f) >= x


def lt(f, x) -> Column:
    return range_(f, float("-inf"), x, "[)") if _is_number(x) else val(f) < x


def le(f, x) -> Column:
    return range_(f, float("-inf"), x, "[]") if _is_number(x) else val(f) <= x


def string_range(f, a: str, b: str) -> Column:
    return (val(f) >= a) & (val(f) < b)


def len_range(f, lo, hi) -> Column:
    """Length in characters; ``inf`` and sizes such as ``1KB`` are allowed."""
    size = F.char_length(val(f))
    low, high = timespan.number(lo), timespan.number(hi)
    pred = size >= int(low)
    return pred if high == float("inf") else pred & (size <= int(high))


def eq_field(f, g) -> Column:
    return val(f) == val(g)


def _both(df: DataFrame | None, f, g) -> tuple[Column, Column]:
    if df is not None and not is_text(df, f) and not is_text(df, g):
        return col(f), col(g)
    return sort_key(f), sort_key(g)


def le_field(f, g, df: DataFrame | None = None) -> Column:
    """Mixed order over text; the native order when ``df`` shows that both are typed."""
    a, b = _both(df, f, g)
    return F.coalesce(a <= b, F.lit(False))


def lt_field(f, g, df: DataFrame | None = None) -> Column:
    a, b = _both(df, f, g)
    return F.coalesce(a < b, F.lit(False))


# ---- addresses -------------------------------------------------------------


def _ipv4(text: str) -> int:
    octets = [int(p) for p in text.split(".")]
    if len(octets) != 4 or any(o > 255 for o in octets):
        raise ValueError(f"not an IPv4 address: {text!r}")
    return reduce(lambda a, x: a * 256 + x, octets, 0)


def ipv4_range(f, first: str, last: str | None = None) -> Column:
    """Address between two, or inside ``a.b.c.d/n``."""
    if last is not None:
        lo, hi = _ipv4(first), _ipv4(last)
    else:
        address, _, bits = first.partition("/")
        size = 1 << (32 - int(bits or 32))
        lo = _ipv4(address) // size * size
        hi = lo + size - 1
    return _between(ipv4_num(f), lo, hi)


def ipv6_hex(f) -> Column:
    """Address as 32 hex digits (IPv4 is mapped), null for other text."""
    raw = F.lower(val(f))
    v4 = F.regexp_extract(raw, r"^(?:::ffff:)?(\d{1,3}(?:\.\d{1,3}){3})$", 1)
    mapped = F.concat(F.lit("0" * 20 + "ffff"), F.lpad(F.lower(F.hex(ipv4_num(v4))), 8, "0"))
    sides = F.split(raw, "::")
    head = F.filter(F.split(sides[0], ":"), lambda x: x != "")
    tail = F.when(F.size(sides) > 1, F.filter(F.split(F.get(sides, F.lit(1)), ":"), lambda x: x != "")).otherwise(
        F.array().cast("array<string>"))
    missing = F.lit(8) - F.size(head) - F.size(tail)
    groups = F.concat(head, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), tail)
    full = F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), "")
    ok = (
        raw.rlike(r"^[0-9a-f:]+$")
        & raw.contains(":")
        & F.forall(groups, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        & (F.size(sides) <= 2)
        & ~raw.rlike(":::")
        & ~raw.rlike("(^:[^:])|([^:]:$)")
        & F.when(F.size(sides) == 2, missing >= 1).otherwise(missing == 0)
    )
    return F.when(v4 != "", mapped).when(ok, full)


def ipv6_range(f, first: str, last: str | None = None) -> Column:
    import ipaddress

    def digits(a):
        return f"{int(a):032x}"

    def address(text):
        a = ipaddress.ip_address(text)
        return ipaddress.IPv6Address(f"::ffff:{a}") if a.version == 4 else a

    if last is not None:
        lo, hi = digits(address(first)), digits(address(last))
    else:
        net = ipaddress.ip_network(first, strict=False)
        if net.version == 4:
            net = ipaddress.ip_network(f"::ffff:{net.network_address}/{96 + net.prefixlen}", strict=False)
        lo, hi = digits(net.network_address), digits(net.broadcast_address)
    return _between(ipv6_hex(f), lo, hi)


# ---- kind of value ---------------------------------------------------------


UINT64_MAX, INT64_MIN = Decimal(2**64 - 1), Decimal(-(2**63))


def value_kind(f) -> Column:
    """Shape of a value: uint64, int64, float64, ipv4, iso8601, string, or empty."""
    text = val(f)
    return (
        F.when(text == "", "empty")
        .when(text.rlike(r"^(0|[1-9][0-9]{0,19})$") & (text.try_cast("decimal(20,0)") <= F.lit(UINT64_MAX)), "uint64")
        .when(text.rlike(r"^-[1-9][0-9]{0,18}$") & (text.try_cast("decimal(20,0)") >= F.lit(INT64_MIN)), "int64")
        .when(text.rlike(r"^-?(0|[1-9][0-9]*)\.[0-9]+$"), "float64")
        .when(ipv4_num(text).isNotNull(), "ipv4")
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?Z$"), "iso8601")
        .otherwise("string")
    )


def value_type(f, kind: str) -> Column:
    return value_kind(f) == kind


# ---- time ------------------------------------------------------------------


def _time_pred(f, lo: int | None, hi: int | None) -> Column:
    """Half-open [lo, hi) in microseconds, as plain comparisons that reach the scan."""
    c = col(f)
    preds = [c.isNotNull()]
    if lo is not None:
        preds.append(c >= timespan.moment(lo))
    if hi is not None:
        preds.append(c < timespan.moment(hi))
    return reduce(lambda a, b: a & b, preds) if len(preds) > 1 else all_rows()


def time_bounds(lo=None, hi=None, ends: str = "[]", offset=0, now: datetime | None = None) -> tuple[int | None, int | None]:
    """Half-open bounds in microseconds. A partial date given as closed end covers its whole period."""
    shift = timespan.duration(offset) // 1000
    low = high = None
    if lo is not None:
        low = timespan.span(lo, now)[0] + (0 if ends[0] == "[" else 1) - shift
    if hi is not None:
        start, after = timespan.span(hi, now)
        high = (after if ends[1] == "]" else start) - shift
    return low, high


def time_range(lo=None, hi=None, ends: str = "[]", offset=0, at: str = TIME, now: datetime | None = None) -> Column:
    """Time between two moments; ``offset`` moves both bounds back."""
    return _time_pred(at, *time_bounds(lo, hi, ends, offset, now))


def time_at(value: str, offset=0, at: str = TIME) -> Column:
    """The whole period named by a partial date."""
    return time_range(value, value, "[]", offset, at)


def time_last(length, op: str = "", now: datetime | None = None, offset=0, at: str = TIME) -> Column:
    """The last ``length`` before now; ``>`` and ``>=`` mean older, ``<`` and ``<=`` newer."""
    end = timespan.micros_of(now or datetime.now(timezone.utc)) - timespan.duration(offset) // 1000
    edge = end - abs(timespan.duration(length)) // 1000
    if op == ">":
        return _time_pred(at, None, edge)
    if op == ">=":
        return _time_pred(at, None, edge + 1)
    return _time_pred(at, edge + 1 if op == "<" else edge, end)


def _hhmm(text: str) -> int:
    hours, minutes = text.split(":")
    return (int(hours) * 60 + int(minutes)) * 60_000_000


def day_range(start: str, end: str, offset=0, ends: str = "[]", at: str = TIME) -> Column:
    """Time of day between two hours; the range may pass midnight."""
    day = 86_400_000_000
    lo = _hhmm(start) + (ends[0] == "(")
    hi = _hhmm(end) - (ends[1] == ")")
    lo, hi = (0 if lo > day else lo), (day - 1 if hi < 0 else hi)
    clock = F.pmod(F.unix_micros(col(at).cast("timestamp")) + F.lit(timespan.duration(offset) // 1000), F.lit(day))
    pred = (clock >= lo) & (clock <= hi) if lo <= hi else (clock >= lo) | (clock <= hi)
    return F.coalesce(pred, F.lit(False))


def week_range(first: str, last: str, offset=0, ends: str = "[]", at: str = TIME) -> Column:
    """Weekday between two days, Sunday first; the range may pass Saturday."""
    a = (WEEKDAYS.index(first[:3].lower()) + (ends[0] == "(")) % 7
    b = (WEEKDAYS.index(last[:3].lower()) - (ends[1] == ")")) % 7
    day = F.dayofweek(col(at) + timespan.interval(timespan.duration(offset))) - 1
    pred = (day >= a) & (day <= b) if a <= b else (day >= a) | (day <= b)
    return F.coalesce(pred, F.lit(False))


# ---- streams ---------------------------------------------------------------


def label(name: str, op: str, value, at: str = STREAM) -> Column:
    """One test on a stream label: ``= != =~ !~ in not_in``."""
    text = F.coalesce(F.element_at(col(at), name), F.lit(""))
    tests: dict[str, Callable[[], Column]] = {
        "=": lambda: text == value,
        "!=": lambda: text != value,
        "=~": lambda: text.rlike(rf"^(?:{user_re(value)})\z"),
        "!~": lambda: ~text.rlike(rf"^(?:{user_re(value)})\z"),
        "in": lambda: text.isin(list(value)),
        "not_in": lambda: ~text.isin(list(value)),
    }
    return tests[op]()


def stream(*alternatives: Sequence[tuple], at: str = STREAM) -> Column:
    """Alternatives of label tests: ``stream([("app", "=", "web"), ("env", "!=", "dev")], [...])``."""
    return or_(*[and_(*[label(*test, at=at) for test in tests]) for tests in alternatives])


def stream_id(*ids: str) -> Column:
    return val(STREAM_ID).isin(list(ids)) if ids else F.lit(False)


# ---- any field -------------------------------------------------------------


def any_field(df: DataFrame, pattern: str, pred: Callable[[Column], Column]) -> Column:
    """True if some field whose name fits the pattern fulfils ``pred``."""
    tests = [pred(col(name)) for name in expand(df, [pattern])]
    if EXTRA in df.columns:
        start = pattern.rstrip("*")
        named = F.map_filter(col(EXTRA), lambda k, _: k.startswith(start) if pattern.endswith("*") else k == pattern)
        tests.append(F.coalesce(F.exists(F.map_values(named), lambda v: pred(v)), F.lit(False)))
    return or_(*tests)

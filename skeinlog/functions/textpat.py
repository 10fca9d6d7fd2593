"""Text patterns of format and extract, number collapsing, colour codes."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from skeinlog.functions.coerce import duration_text, num
from skeinlog.functions.filters import literal_re
from skeinlog.model import val

# ---- fixed values: collapsed forms, colour codes ---------------------------
# Numbers are words of decimal digits, or of at least four hex digits with a digit among them.
# The T and Z of a timestamp do not count as neighbouring letters.
NUMBER_RUN = (
    r"(?:(?<![\p{L}\p{Nd}_])|(?<=[0-9]T))"
    r"(?:0x[0-9a-fA-F]+|[0-9]+|(?=[a-fA-F]*[0-9])[0-9a-fA-F]{4,})"
    r"(?:(?![\p{L}\p{Nd}_])|(?=T[0-9]{2}:)|(?=Z(?![\p{L}\p{Nd}_])))"
)
PRETTY_FORMS = [
    (r"<N>-<N>-<N>-<N>-<N>", "<UUID>"),
    (r"<N>\.<N>\.<N>\.<N>", "<IP4>"),
    (r"<N>:<N>:<N>(?:[.,]<N>)?", "<TIME>"),
    (r"<N>[-/]<N>[-/]<N>", "<DATE>"),
    (r"<DATE>[T ]<TIME>(?:Z|[+-]<N>:<N>)?", "<DATETIME>"),
]
COLOR_CODE = "\\x1b\\[[0-9;]*[A-Za-z]"
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Piece:
    """Text before a placeholder, and the placeholder (None at the end, empty if it is skipped)."""

    text: str
    name: str | None
    option: str = ""


def parse_pattern(pattern: str) -> list[Piece]:
    """Split ``text<field>text`` into pieces; ``<_>`` and ``<*>`` are skipped fields, ``<opt:field>`` has an option."""
    pieces = []
    rest = pattern
    for m in re.finditer(r"([^<]*)<([^>]*)>", pattern):
        option, _, name = m[2].rpartition(":")
        name = "" if name.strip() in ("_", "*") else name.strip()
        pieces.append(Piece(html.unescape(m[1]), name, option.strip()))
        rest = pattern[m.end():]
    if "<" in rest:
        raise ValueError(f"missing '>' in {pattern!r}")
    if rest:
        pieces.append(Piece(html.unescape(rest), None))
    return pieces


def extract_regex(pattern: str) -> tuple[str, list[str]]:
    """Regex and field names of an extract pattern; the last field takes the rest of the value."""
    pieces = parse_pattern(pattern)
    names = [p.name for p in pieces if p.name]
    if not names:
        raise ValueError(f"{pattern!r} has no named field")
    if any(n.endswith("*") for n in names):
        raise ValueError("wildcard fields cannot be extracted")
    for before, piece in zip(pieces, pieces[1:]):
        if not piece.text:
            raise ValueError(f"text is missing between <{before.name}> and <{piece.name}>")
    body = ""
    for i, p in enumerate(pieces):
        last = i == len(pieces) - 1
        body += literal_re(p.text)
        if p.name is None:
            continue
        some = '.*' if last else '.*?'
        body += f'("(?:[^"\\\\]|\\\\.)*"|{some})' if p.name and p.option != "plain" else f"({some})" if p.name else f"(?:{some})"
    return "(?s)" + ("" if pieces[0].text else "^") + body, names


def unquoted(c: Column) -> Column:
    """A quoted value without its quotes and escapes."""
    decoded = F.get(F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>"), F.lit(0))
    return F.when(c.rlike(r'(?s)^".*"$'), F.coalesce(decoded, c)).otherwise(c)


def format_value(name: str, option: str) -> Column:
    """Field text in one of the forms: q, uc, lc, urlencode, urldecode, hexencode, hexdecode, base64encode,
    base64decode, time (ns to RFC3339), duration (ns), duration_seconds, ipv4, hexnumencode, hexnumdecode."""
    text = val(name)
    forms = {
        "": lambda: text,
        "plain": lambda: text,
        "q": lambda: F.to_json(F.array(text)).substr(F.lit(2), F.length(F.to_json(F.array(text))) - 2),
        "uc": lambda: F.upper(text),
        "lc": lambda: F.lower(text),
        "urlencode": lambda: F.url_encode(text),
        "urldecode": lambda: F.try_url_decode(text),
        "hexencode": lambda: F.hex(text.cast("binary")),
        "hexdecode": lambda: F.unhex(text).cast("string"),
        "base64encode": lambda: F.base64(text.cast("binary")),
        "base64decode": lambda: F.try_to_binary(text, F.lit("base64")).cast("string"),
        "time": lambda: F.date_format(F.timestamp_micros(F.floor(num(name) / 1000).cast("bigint")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        "duration": lambda: duration_text(num(name).cast("bigint")),
        "duration_seconds": lambda: (num(name) / F.lit(1e9)).cast("string"),
        "ipv4": lambda: F.concat_ws(".", *[
            (F.shiftright(num(name).cast("bigint"), s) % 256).cast("string") for s in (24, 16, 8, 0)]),
        "hexnumencode": lambda: F.lpad(F.hex(num(name).cast("bigint")), 16, "0"),
        "hexnumdecode": lambda: F.conv(text, 16, 10),
    }
    if option not in forms:
        raise ValueError(f"unknown format option {option!r}")
    return F.coalesce(forms[option](), F.lit(""))


def format_text(pattern: str) -> Column:
    parts = []
    for p in parse_pattern(pattern):
        if p.text:
            parts.append(F.lit(p.text))
        if p.name:
            parts.append(format_value(p.name, p.option))
    return F.concat(*parts) if parts else F.lit("")


def collapse(c: Column, prettify: bool = False) -> Column:
    """Numbers to ``<N>``; pretty forms join runs of numbers to dates, times, addresses and ids."""
    done = F.regexp_replace(c, NUMBER_RUN, "<N>")
    if prettify:
        for shape, name in PRETTY_FORMS:
            done = F.regexp_replace(done, shape, name)
    return done


def decolored(c: Column) -> Column:
    return F.regexp_replace(c, COLOR_CODE, "")

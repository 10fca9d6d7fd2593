"""Projection and row shape: keep, rename, format, extract, replace, pack, unpack, unroll, math."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinlog.functions import textpat, timespan
from skeinlog.functions.coerce import text_of
from skeinlog.functions.filters import WORD, literal_re, user_re, value_kind
from skeinlog.model import EXTRA, MSG, STREAM, STREAM_ID, TIME, col, expand, field_name, is_text, make_stream_id, out, quoted, val

MAX_DISCOVERED_KEYS = 1000


def assign(
    df: DataFrame,
    new: dict[str, Column],
    iff: Column | None = None,
    keep_original: bool = False,
    skip_empty: bool = False,
) -> DataFrame:
    """Set several fields at once, under the options that all updating operators share.

    ``iff`` leaves other rows as they are, ``keep_original`` only fills empty
    fields, ``skip_empty`` never overwrites a value with nothing.
    """
    columns = {}
    for name, c in new.items():
        target = field_name(name)
        exists = target in df.columns
        old = col(target) if exists else F.lit(None).cast("string")
        plain = iff is None and not keep_original and not skip_empty
        if plain or (iff is None and not exists):
            columns[target] = c
            continue
        had = val(target) != "" if exists else F.lit(False)
        if exists and not is_text(df, target):
            old = old.cast("string")
        test = F.lit(True) if iff is None else F.coalesce(iff, F.lit(False))
        if keep_original:
            test = test & ~had
        if skip_empty:
            test = test & (F.coalesce(c.cast("string"), F.lit("")) != "")
        columns[target] = F.when(test, c).otherwise(old)
    return df.withColumns(columns)


# ---- projection ------------------------------------------------------------


def fields(df: DataFrame, *patterns: str) -> DataFrame:
    """Keep the named fields and prefixes; a plain name without a column is an empty field."""
    if "*" in patterns:
        return df
    kept = {n: col(n) for n in expand(df, patterns)}
    for p in patterns:
        if not p.endswith("*") and field_name(p) not in kept:
            kept[field_name(p)] = F.lit(None).cast("string")
    return df.select(*[c.alias(n) for n, c in kept.items()])


def delete(df: DataFrame, *patterns: str) -> DataFrame:
    return df.drop(*expand(df, patterns))


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename fields, or all fields of a prefix; a field already named like the target is replaced."""
    for src, dst in names.items():
        if src.endswith("*") != dst.endswith("*"):
            raise ValueError("a prefix is renamed to a prefix")
        pairs = {n: dst[:-1] + n[len(src) - 1:] for n in expand(df, [src])} if src.endswith("*") else {field_name(src): field_name(dst)}
        pairs = {s: d for s, d in pairs.items() if s in df.columns and s != d}
        df = df.drop(*[d for d in pairs.values() if d not in pairs]).withColumnsRenamed(pairs)
    return df


def drop_empty_fields(df: DataFrame) -> DataFrame:
    """Empty text to null, empty entries out of the map, and rows with nothing left dropped."""
    columns, tests = [], []
    for n in df.columns:
        if n == EXTRA:
            kept = F.map_filter(col(n), lambda _, v: F.coalesce(v, F.lit("")) != "")
            columns.append(F.when(F.size(kept) > 0, kept).alias(n))
        else:
            columns.append((out(val(n)) if is_text(df, n) else col(n)).alias(n))
        tests.append(n)
    return df.select(*columns).dropna("all", subset=[quoted(n) for n in tests])


def filter(df: DataFrame, pred: Column) -> DataFrame:
    return df.where(pred)


# ---- text ------------------------------------------------------------------


def format(df: DataFrame, pattern: str, as_: str = MSG, **options) -> DataFrame:
    """Build text from fields: ``<field>`` or ``<option:field>``."""
    return assign(df, {as_: textpat.format_text(pattern)}, **options)


def extract(df: DataFrame, pattern: str, from_: str = MSG, **options) -> DataFrame:
    """Cut fields out of text by a pattern ``text<field>text``."""
    regex, names = textpat.extract_regex(pattern)
    text = val(from_)
    groups = {}
    for i, name in enumerate(names, 1):
        groups.setdefault(name, textpat.unquoted(F.regexp_extract(text, regex, i)))
    return assign(df, groups, **options)


def extract_regexp(df: DataFrame, pattern: str, from_: str = MSG, **options) -> DataFrame:
    """Named groups of a regex to fields; a dot also matches line breaks."""
    regex = user_re(pattern)
    names = _named_groups(regex)
    if not names:
        raise ValueError("the regex has no named group")
    new = {n: F.regexp_extract(val(from_), "(?s)" + regex, i) for i, n in names}
    return assign(df, new, **options)


def _named_groups(regex: str) -> list[tuple[int, str]]:
    """Numbers and names of the named groups."""
    found, number = [], 0
    for m in re.finditer(r"\\.|\[(?:\\.|[^\]\\])*\]|\((\?<(\w+)>|\?)?", regex):
        if not m[0].startswith("(") or (m[1] == "?"):
            continue
        number += 1
        if m[2]:
            found.append((number, m[2]))
    return found


def replace(df: DataFrame, old: str, new: str, at: str = MSG, limit: int = 0, iff: Column | None = None) -> DataFrame:
    """Replace text, the first ``limit`` places only if a limit is given."""
    text = val(at)
    if not limit:
        done = F.replace(text, F.lit(old), F.lit(new)) if old else text
    else:
        done = F.array_join(F.split(text, literal_re(old), limit + 1), new)
    return assign(df, {at: done}, iff=iff)


def replace_regexp(df: DataFrame, pattern: str, repl: str, at: str = MSG, limit: int = 0, iff: Column | None = None) -> DataFrame:
    """Replace by regex with ``$1`` or ``${name}`` in the replacement."""
    regex, text = user_re(pattern), val(at)
    if not limit:
        done = F.regexp_replace(text, regex, repl)
    elif "$" not in repl:
        done = F.array_join(F.split(text, regex, limit + 1), repl)
    else:
        done = _replace_first(text, regex, repl, limit)
    return assign(df, {at: done}, iff=iff)


def _group_count(regex: str) -> int:
    found = re.findall(r"\\.|\[(?:\\.|[^\]\\])*\]|(\((?!\?)|\(\?<\w+>)", regex)
    return sum(1 for x in found if x)


def _replace_first(text: Column, regex: str, repl: str, limit: int) -> Column:
    """The first matches replaced, each by its own groups, in one expression whatever the limit.

    All matches and the gaps between them come from the whole text, so anchors and boundaries see what is around them.
    """
    names, groups = {n: i for i, n in _named_groups(regex)}, _group_count(regex)
    arrays: dict[int, Column] = {}

    def group(i: int) -> Callable[[Column], Column]:
        arrays.setdefault(i, F.regexp_extract_all(text, F.lit(regex), F.lit(i)))
        return lambda k: F.coalesce(F.get(arrays[i], k), F.lit(""))

    makers: list[Callable[[Column], Column]] = []
    for m in re.finditer(r"\$\{(\w+)\}|\$(\d+)|\\(.)|([^$\\]+)|(.)", repl, re.S):
        if m[1] is not None:
            makers.append(group(int(m[1]) if m[1].isdigit() else names[m[1]]))
        elif m[2] is not None:
            digits = m[2]
            while len(digits) > 1 and int(digits) > groups:
                digits = digits[:-1]
            makers.append(group(int(digits)))
            if len(digits) < len(m[2]):
                makers.append(lambda k, rest=m[2][len(digits):]: F.lit(rest))
        else:
            makers.append(lambda k, same=m[3] or m[4] or m[5]: F.lit(same))
    # splitting leaves out an empty gap before a match of no width at the very start
    empty_first = (F.regexp_instr(text, F.lit(regex)) == 1) & (F.regexp_extract(text, regex, 0) == "")
    cut = F.split(text, regex, limit) if limit > 1 else F.array(text)
    gaps = F.when(empty_first, F.concat(F.array(F.lit("")), cut)).otherwise(F.split(text, regex, limit + 1))
    joined = F.transform(gaps, lambda g, k: F.when(k == 0, g).otherwise(F.concat(*[f(k - 1) for f in makers], g)))
    return F.array_join(joined, "")


def collapse_nums(df: DataFrame, at: str = MSG, prettify: bool = False, iff: Column | None = None) -> DataFrame:
    return assign(df, {at: textpat.collapse(val(at), prettify)}, iff=iff)


def decolorize(df: DataFrame, field: str = MSG) -> DataFrame:
    """Strip terminal colour codes."""
    return assign(df, {field: textpat.decolored(val(field))})


def len_(df: DataFrame, f: str, as_: str = MSG) -> DataFrame:
    """Length in bytes."""
    return assign(df, {as_: F.octet_length(val(f)).cast("bigint")})


def hash_(df: DataFrame, f: str, as_: str = MSG) -> DataFrame:
    """64-bit hash of a value."""
    return assign(df, {as_: F.xxhash64(val(f))})


def json_array_len(df: DataFrame, f: str, as_: str = MSG) -> DataFrame:
    """Number of items of a JSON array, 0 for other text."""
    return assign(df, {as_: F.coalesce(F.json_array_length(val(f)), F.lit(0)).cast("bigint")})


def _packed_names(df: DataFrame, patterns: Sequence[str]) -> list[str]:
    return expand(df, patterns or ["*"])


def pack_json(df: DataFrame, patterns: Sequence[str] = (), as_: str = MSG) -> DataFrame:
    """Fields as one JSON object of texts, empty ones left out."""
    parts = [out(text_of(df, n)).alias(n) for n in _packed_names(df, patterns)]
    return assign(df, {as_: F.to_json(F.struct(*parts)) if parts else F.lit("{}")})


def _logfmt_value(c: Column) -> Column:
    quoted_json = F.to_json(F.array(c))
    return F.when(c.rlike(r'[\s"=\\]'), quoted_json.substr(F.lit(2), F.length(quoted_json) - 2)).otherwise(c)


def pack_logfmt(df: DataFrame, patterns: Sequence[str] = (), as_: str = MSG) -> DataFrame:
    """Fields as ``k=v`` text, values quoted where needed, empty ones left out."""
    texts = [(n, text_of(df, n)) for n in _packed_names(df, patterns)]
    parts = [F.when(t != "", F.concat(F.lit(n + "="), _logfmt_value(t))) for n, t in texts]
    return assign(df, {as_: F.concat_ws(" ", *parts)})


# ---- unpacking -------------------------------------------------------------


def discover(keys: Column, df: DataFrame, bound: int = MAX_DISCOVERED_KEYS) -> tuple[list[str], bool]:
    """Distinct keys over all rows, in one distributed pass; at most ``bound`` names reach the driver.

    The most frequent keys win. The flag says whether some did not fit.
    """
    counted = df.select(F.explode(keys).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.orderBy(F.desc("n"), "k").limit(bound + 1).collect()
    return sorted(r["k"] for r in rows[:bound]), len(rows) > bound


def _unpacked(
    df: DataFrame, entries: Column, wanted: Sequence[str], prefix: str, bound: int = MAX_DISCOVERED_KEYS,
    read: Callable[[Column], Column] = lambda value: value, **options
) -> DataFrame:
    """Fields out of an array of (key, value); names beyond the discovery bound stay in the extra map. Keys are found
    without a look at values; ``read`` makes the text of a field out of a value.

    A key given twice keeps its first value. A field that only a wildcard names changes in those rows that hold it; a
    field named in full becomes empty in the others. Each row's entries are read once, however many fields there are.
    """
    source = df.withColumn("__entries", entries)
    source = source.withColumn("__keys", F.transform("__entries", lambda e: e["key"]))
    once = F.filter("__entries", lambda e, i: F.array_position("__keys", e["key"]) == i + 1)
    source = source.withColumn("__map", F.map_from_entries(F.transform(
        once, lambda e: F.struct(e["key"].alias("key"), F.coalesce(e["value"], F.lit("")).alias("value"))
    )))
    exact = [w for w in wanted if not w.endswith("*")]
    open_ended = [w[:-1] for w in wanted if w.endswith("*")]
    named, rest = list(exact), False
    if open_ended:
        keys = F.array_distinct("__keys")
        some = keys if "" in open_ended else F.filter(keys, lambda k: _any_of([k.startswith(p) for p in open_ended]))
        found, rest = discover(some, source, bound)
        exact += [k for k in found if k not in exact]
    done = source
    if exact:
        shape = T.StructType([T.StructField(k, T.StringType()) for k in exact])
        source = source.withColumn("__fields", F.from_json(F.to_json("__map"), shape))
        new = {}
        for k in exact:
            value, old = read(F.col("__fields").getField(k)), field_name(prefix + k)
            kept = val(old) if k not in named and old in df.columns else F.lit("")
            new[prefix + k] = F.coalesce(value, kept)
        done = assign(source, new, **options)
    if rest:
        left = F.map_filter("__map", lambda k, _: ~k.isin(exact) & _any_of([k.startswith(p) for p in open_ended]))
        more = F.transform_values(F.transform_keys(left, lambda k, _: F.concat(F.lit(prefix), k)), lambda _, v: read(v))
        old = col(EXTRA) if EXTRA in df.columns else F.create_map().cast("map<string,string>")
        keep = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(more), k))
        test = options.get("iff")
        merged = F.map_concat(keep, more)
        done = done.withColumn(EXTRA, merged if test is None else F.when(test, merged).otherwise(old))
    return done.drop("__entries", "__keys", "__map", "__fields")


def _any_of(tests: Sequence[Column]) -> Column:
    done = tests[0]
    for t in tests[1:]:
        done = done | t
    return done


# Objects on a live stream are flattened to this depth; deeper ones stay JSON text. On a table the depth is measured.
JSON_DEPTH = 5

# A JSON parser rewrites 1.50 and 1e3. Such numbers go through it as marked texts: everything up to a number outside of
# quotes, then the number. The mark is a private-use character.
MARK = "\ue0f1"
NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+(?![0-9.eE+-])"
BEFORE_NUMBER = r'\G((?:[^"0-9-]++|"(?:[^"\\]++|\\.)*+")*+)'


def _kept_numbers(text: Column) -> Column:
    """JSON text whose numbers are marked texts, if a parser would change one."""
    marked = F.regexp_replace(text, f"(?s){BEFORE_NUMBER}({NUMBER})", f'$1"{MARK}$2"')
    return F.when(text.rlike("[0-9][.eE]|[0-9]{16}|-0"), marked).otherwise(text)


def _as_written(value: Column) -> Column:
    """A value out of marked text: a number itself, or JSON text with its numbers."""
    inner = F.regexp_replace(value, f'"{MARK}({NUMBER})"', "$1")
    alone = F.when(value.startswith(MARK), value.substr(F.lit(2), F.length(value))).otherwise(inner)
    return F.when(value.contains(MARK), alone).otherwise(value)


def json_depth(text: Column) -> Column:
    """Levels of braces in a JSON text, those inside texts left out. Few texts have more than one pair; they are walked."""
    opened = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("{"), F.lit("")))
    braces = F.regexp_replace(text, r'(?s)"(?:[^"\\]++|\\.)*+"|[^{}"]++', "")
    walked = F.aggregate(
        F.split(braces, ""),
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda a, c: _deeper(a, F.when(c == "{", 1).when(c == "}", -1).otherwise(0)),
        lambda a: a["most"],
    )
    return F.when(opened <= 2, opened).otherwise(walked)


def _deeper(a: Column, by: Column) -> Column:
    now = a["now"] + by
    return F.struct(now.alias("now"), F.greatest(a["most"], now).alias("most"))


def flat_json(df: DataFrame, text: Column, name: str, preserve: Sequence[str] = (), depth: int | None = None) -> DataFrame:
    """Add the flat entries ``a.b`` -> text of a JSON object; preserved keys keep their JSON.

    One level is opened per step, and rows without a nested object skip the step. Without a depth the deepest text of
    a table is looked for in one pass over the texts. Values are to be read by ``_as_written``: numbers are marked.
    """
    if depth is None:
        depth = JSON_DEPTH if df.isStreaming else df.agg(F.max(json_depth(text))).first()[0] or 1
    df = df.withColumn(name, F.map_entries(F.from_json(_kept_numbers(text), "map<string,string>")))
    for _ in range(depth - 1):
        opened = F.flatten(F.transform(name, lambda e: _opened(e, preserve)))
        df = df.withColumn(name, F.when(F.exists(name, lambda e: _nested(e, preserve)), opened).otherwise(F.col(name)))
    return df


def _nested(e: Column, preserve: Sequence[str]) -> Column:
    nested = F.coalesce(e["value"].startswith("{"), F.lit(False))
    return nested & ~e["key"].isin(list(preserve)) if preserve else nested


def _opened(e: Column, preserve: Sequence[str]) -> Column:
    """Entries of a nested object under dotted names, or the entry itself."""
    itself = F.array(F.struct(e["key"].alias("key"), e["value"].alias("value")))
    inner = F.transform(
        F.map_entries(F.from_json(e["value"], "map<string,string>")),
        lambda x: F.struct(F.concat(e["key"], F.lit("."), x["key"]).alias("key"), x["value"].alias("value")),
    )
    return F.when(_nested(e, preserve), F.coalesce(inner, itself)).otherwise(itself)


def _step(key: str) -> str:
    """One step of a path, in the kind of quotes that the key does not hold."""
    return f'["{key}"]' if "'" in key else f"['{key}']"


def unpack_json(
    df: DataFrame,
    from_: str = MSG,
    fields: Sequence[str] = ("*",),
    preserve_keys: Sequence[str] = (),
    result_prefix: str = "",
    keep_original: bool = False,
    skip_empty: bool = False,
    iff: Column | None = None,
    bound: int = MAX_DISCOVERED_KEYS,
) -> DataFrame:
    """Fields of a JSON object. Named fields are read by path; ``*`` first finds the keys in one pass.

    At most ``bound`` names that a wildcard finds become columns, the most frequent ones; the others go to the extra map.
    """
    options = dict(keep_original=keep_original, skip_empty=skip_empty, iff=iff)
    text = val(from_)
    if all(not f.endswith("*") for f in fields) and not preserve_keys:
        parsed = F.try_parse_json(_kept_numbers(text))
        new = {}
        for f in fields:
            path = "$" + "".join(_step(p) for p in f.split("."))
            whole = "$" + _step(f)
            read = F.try_variant_get(parsed, path, "string")
            found = F.coalesce(read, F.try_variant_get(parsed, whole, "string") if "." in f else F.lit(None), F.lit(""))
            new[result_prefix + f] = _as_written(found)
        return assign(df, new, **options)
    entries = flat_json(df, text, "__json", preserve_keys)
    return _unpacked(entries, F.col("__json"), fields, result_prefix, bound, _as_written, **options).drop("__json")


LOGFMT = r'([^\s="]+)=("(?:[^"\\]|\\.)*"|[^\s"]*)'


def logfmt_entries(text: Column) -> Column:
    keys = F.regexp_extract_all(text, F.lit(LOGFMT), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(LOGFMT), F.lit(2))
    return F.zip_with(keys, values, lambda k, v: F.struct(k.alias("key"), textpat.unquoted(v).alias("value")))


def unpack_logfmt(
    df: DataFrame,
    from_: str = MSG,
    fields: Sequence[str] = ("*",),
    result_prefix: str = "",
    keep_original: bool = False,
    skip_empty: bool = False,
    iff: Column | None = None,
    bound: int = MAX_DISCOVERED_KEYS,
) -> DataFrame:
    """Fields of ``k=v k="v w"`` text; ``bound`` as for JSON."""
    options = dict(keep_original=keep_original, skip_empty=skip_empty, iff=iff)
    return _unpacked(df, logfmt_entries(val(from_)), fields, result_prefix, bound, **options)


# ---- fixed values: syslog shapes and names ---------------------------------
RFC3164 = r"^<(\d{1,3})>([A-Z][a-z]{2} [ \d]\d \d{2}:\d{2}:\d{2}) (\S+) (?:([^\s:\[]+)(?:\[([^\]]*)\])?: ?)?(.*)$"
RFC5424 = r"^<(\d{1,3})>1 (\S+) (\S+) (\S+) (\S+) (\S+) (-|(?:\[(?:[^\]\\\"]|\\.|\"(?:[^\"\\]|\\.)*\")*\])+)(?: (.*))?$"
SEVERITIES = ("emerg", "alert", "crit", "err", "warning", "notice", "info", "debug")
FACILITIES = ("kern", "user", "mail", "daemon", "auth", "syslog", "lpr", "news", "uucp", "cron", "authpriv", "ftp",
              "ntp", "security", "console", "solaris-cron", "local0", "local1", "local2", "local3", "local4", "local5", "local6", "local7")
# ----------------------------------------------------------------------------


def unpack_syslog(
    df: DataFrame, year: int, from_: str = MSG, offset="0s", result_prefix: str = "", keep_original: bool = False, iff: Column | None = None
) -> DataFrame:
    """Syslog fields of both common formats. ``year`` completes times that carry none, ``offset`` is their zone."""
    offset = timespan.duration(0 if offset == "0s" else offset)
    text = val(from_)
    new_format = text.rlike("(?s)" + RFC5424)
    a = lambda i: F.regexp_extract(text, "(?s)" + RFC5424, i)
    b = lambda i: F.regexp_extract(text, "(?s)" + RFC3164, i)
    pick = lambda i, j: F.when(new_format, F.when(a(i) == "-", "").otherwise(a(i))).otherwise(b(j))
    known = new_format | text.rlike("(?s)" + RFC3164)
    pri = pick(1, 1).try_cast("int")
    old_time = F.try_to_timestamp(F.concat(F.lit(f"{year} "), F.regexp_replace(b(2), "  ", " 0")), F.lit("yyyy MMM dd HH:mm:ss"))
    old_text = F.date_format(old_time - timespan.interval(offset), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    new = {
        "priority": pri.cast("string"),
        "facility": F.floor(pri / 8).cast("string"),
        "facility_keyword": F.get(F.array(*[F.lit(x) for x in FACILITIES]), F.floor(pri / 8).cast("int")),
        "severity": (pri % 8).cast("string"),
        "level": F.get(F.array(*[F.lit(x) for x in SEVERITIES]), pri % 8),
        "format": F.when(new_format, "rfc5424").when(known, "rfc3164"),
        "timestamp": F.when(new_format, F.when(a(2) == "-", "").otherwise(a(2))).otherwise(old_text),
        "hostname": pick(3, 3),
        "app_name": pick(4, 4),
        "proc_id": pick(5, 5),
        "msg_id": F.when(new_format, F.when(a(6) == "-", "").otherwise(a(6))).otherwise(""),
        "message": F.when(new_format, a(8)).when(known, b(6)).otherwise(text),
    }
    new = {result_prefix + k: F.coalesce(F.when(known | F.lit(k == "message"), v), F.lit("")) for k, v in new.items()}
    return assign(df, new, keep_original=keep_original, iff=iff)


def unpack_words(df: DataFrame, from_: str = MSG, as_: str | None = None, drop_duplicates: bool = False) -> DataFrame:
    """Words of a text as a JSON array."""
    words = F.regexp_extract_all(val(from_), F.lit(f"{WORD}+"), F.lit(0))
    return assign(df, {as_ or from_: F.to_json(F.array_distinct(words) if drop_duplicates else words)})


def split(df: DataFrame, sep: str, from_: str = MSG, as_: str | None = None) -> DataFrame:
    """Text to a JSON array; an empty separator cuts between characters."""
    text = val(from_)
    parts = F.split(text, literal_re(sep)) if sep else F.filter(F.split(text, ""), lambda x: x != "")
    return assign(df, {as_ or from_: F.to_json(parts)})


def unroll(df: DataFrame, *names: str, iff: Column | None = None) -> DataFrame:
    """JSON arrays to one row per position; shorter arrays give empty values.

    A row without an array in these fields stays one row, with empty values.
    """
    arrays = {}
    for n in names:
        items = F.coalesce(F.from_json(val(n), "array<string>"), F.array().cast("array<string>"))
        arrays[field_name(n)] = items if iff is None else F.when(iff, items).otherwise(F.array(val(n)))
    zipped = F.arrays_zip(*[a.alias(f"u{i}") for i, a in enumerate(arrays.values())])
    done = df.withColumn("__u", F.explode_outer(zipped))
    filled = {n: F.coalesce(F.col(f"__u.u{i}"), F.lit("")) for i, n in enumerate(arrays)}
    return done.withColumns(filled).drop("__u")


def time_add(df: DataFrame, d, at: str = TIME) -> DataFrame:
    """Shift a time field."""
    return df.withColumn(field_name(at), col(at) + timespan.interval(timespan.duration(d)))


def set_stream_fields(df: DataFrame, *patterns: str, iff: Column | None = None) -> DataFrame:
    """Rebuild the stream labels (and the stream id, if there is one) from fields."""
    names = expand(df, patterns)
    labels = F.create_map(*[x for n in names for x in (F.lit(n), val(n))]) if names else F.create_map().cast("map<string,string>")
    new = F.map_filter(labels, lambda _, v: v != "")
    if iff is not None and STREAM in df.columns:
        new = F.when(iff, new).otherwise(col(STREAM))
    done = df.withColumn(STREAM, new)
    return done.withColumn(STREAM_ID, make_stream_id()) if STREAM_ID in df.columns else done


def math_(df: DataFrame, **exprs: Callable[[], Column] | Column) -> DataFrame:
    """Several expressions in order; later ones see earlier results."""
    for name, e in exprs.items():
        df = df.withColumn(name, e() if callable(e) and not isinstance(e, Column) else e)
    return df


def value_type_profile(df: DataFrame) -> DataFrame:
    """Rows per field and kind of value."""
    names = expand(df, ["*"])
    pairs = F.array(*[F.struct(F.lit(n).alias("field_name"), value_kind(n).alias("kind")) for n in names])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.field_name", "p.kind").agg(F.count(F.lit(1)).alias("hits"))

"""Personal data: patterns, and a character tagger learned from what they find.

The tagger (tagger.Tagger) looks at every stretch of text around a digit or @ that no pattern claims, in overlapping
windows; their scores are averaged at each character and one path through the whole stretch is decoded. What it adds
must contain such a character and pass the same test as its kind's patterns, short of the exact form.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from skeinlog.llm import tagger
from skeinlog.llm.common import cut
from skeinlog.llm.tokens import slices

KINDS = ["email", "ip", "card", "phone"]
#: Windows from which the tagger learns, at most; different ones, of each kind an equal part, taken by hash from
#: the whole corpus.
SAMPLE = 1200
WINDOW, STRIDE, AROUND = 64, 32, 24

_ANY = re.compile(r"[0-9@+]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits that fails as a whole fails from inside too
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    d = _digits(text)
    return 14 <= len(d) <= 19 and luhn(d)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of all patterns, by start and then kind. Code points, end exclusive."""
    if not _ANY.search(text):
        return []
    out = [(a, b, 0) for a, b in _emails(text)]
    out += [(*m.span(), 1) for m in _IP.finditer(text) if _is_ip(m[0])]
    out += [(*m.span(), 2) for m in _CARD.finditer(text) if _is_card(m[0])]
    out += [(*m.span(), 3) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15] if "+" in text else []
    return sorted(out, key=lambda s: (s[0], s[2]))


def plausible(text: str, kind: int) -> bool:
    """What a span that only the tagger sees must be."""
    digits = len(_digits(text))
    if kind == 0:
        return bool(re.fullmatch(r"[^\s@]+@[^\s@]+\.[^\s@]+", text))
    if kind == 1:
        return bool(re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", text)) and _is_ip(text)
    return _is_card(text) if kind == 2 else 10 <= digits <= 15 and bool(re.fullmatch(r"[+(0-9][\x20().0-9/-]+[0-9]", text))


def _stretches(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Where a digit or @ is in no span: such characters with what is around them, joined where they meet."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    hit = ((points >= 48) & (points <= 57)) | (points == 64)
    for a, b, _ in spans:
        hit[a:b] = False
    at = np.flatnonzero(hit)
    if not len(at):
        return []
    fresh = np.flatnonzero(np.diff(at) > 2 * AROUND) + 1
    first, last = at[np.concatenate([[0], fresh])], at[np.concatenate([fresh - 1, [len(at) - 1]])]
    return list(zip(np.maximum(first - AROUND, 0).tolist(), np.minimum(last + AROUND + 1, len(text)).tolist(), strict=True))


def _tags(spans: list[tuple[int, int, int]], a: int, b: int) -> np.ndarray:
    """0 outside; 1 + 2 * kind where a span begins, one more inside it."""
    out = np.zeros(b - a, np.int64)
    for s, e, k in spans:
        if s < b and e > a:
            out[max(s - a, 0) : e - a] = 2 + 2 * k
            if s >= a:
                out[s - a] = 1 + 2 * k
    return out


def _examples(sample: int):
    """Windows with their tags and kind: one for each span of a text, and one for each stretch without, of the kind of a
    span that it touches or else of kind len(KINDS). Equal windows have one place. Of each kind a task puts out the `sample` of least place."""
    def least(some: set) -> set:
        return set(heapq.nsmallest(sample, some))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[set] = [set() for _ in range(len(KINDS) + 1)]
        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py() or ""
                spans = base_spans(text)
                at = [((s[0] + s[1]) // 2, s[2]) for s in spans]
                if _ANY.search(text):
                    at += [((a + b) // 2, len(KINDS)) for a, b in _stretches(text, spans)]
                for middle, kind in at:
                    a = max(0, middle - WINDOW // 2)
                    b = min(len(text), a + WINDOW)
                    chars, tags = (x.astype(np.uint8).tobytes() for x in (tagger.codes(text[a:b]), _tags(spans, a, b)))
                    if kind == len(KINDS) and any(tags):
                        kind = (next(t for t in tags if t) - 1) // 2
                    place = int.from_bytes(hashlib.blake2b(chars + tags, digest_size=8).digest(), "little", signed=True)
                    held[kind].add((place, chars, tags))
                    if len(held[kind]) > 4 * sample:
                        held[kind] = least(held[kind])
        found = [(k, *x) for k, some in enumerate(held) for x in least(some)]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate(kinds)], ["kind", "place", "chars", "tags"])

    return rows


def examples(docs: DataFrame, sample: int) -> list[Row]:
    """At most `sample` different windows: of each kind, and of those without a span, an equal part if there are so many,
    and the rest by place."""
    found = cut(docs.where(F.col("text").rlike("[0-9@+]")).select("text").mapInArrow(
        _examples(sample), "kind long, place long, chars binary, tags binary"
    ).distinct())
    kinds = range(len(KINDS) + 1)
    by_kind = [found.where(F.col("kind") == k).orderBy("place", "chars", "tags").limit(sample).collect() for k in kinds]
    share = sample // len(kinds)
    rows = {(r["place"], r["chars"], r["tags"]): r for some in by_kind for r in some[:share]}
    for r in sorted((r for some in by_kind for r in some[share:]), key=lambda r: (r["place"], r["chars"], r["tags"])):
        if len(rows) < sample:
            rows.setdefault((r["place"], r["chars"], r["tags"]), r)
    return [rows[k] for k in sorted(rows)]


def train(docs: DataFrame, sample: int = SAMPLE) -> tagger.Tagger | None:
    """A tagger from at most `sample` windows of the corpus, with digits drawn anew so that it learns forms."""
    rows = examples(docs, sample)
    if not rows:
        return None
    chars, tags = np.full((len(rows), WINDOW), tagger.CODES - 1), np.zeros((len(rows), WINDOW), np.int64)
    for i, r in enumerate(rows):
        chars[i, : len(r["chars"])] = np.frombuffer(bytes(r["chars"]), np.uint8)
        tags[i, : len(r["tags"])] = np.frombuffer(bytes(r["tags"]), np.uint8)
    digit = (chars >= 16) & (chars < 26)
    chars[digit] = 16 + np.random.default_rng(5).integers(0, 10, int(digit.sum()))
    return tagger.Tagger(1 + 2 * len(KINDS)).fit(chars, tags)


def added_spans(model: tagger.Tagger, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """What the tagger finds beside the patterns."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    todo = [(i, a, b) for i, t in enumerate(texts) if _ANY.search(t) for a, b in _stretches(t, base[i])]
    todo.sort(key=lambda s: s[2] - s[1])
    for k in range(0, len(todo), 256):
        some = todo[k : k + 256]
        length = np.array([b - a for _, a, b in some])
        score = np.zeros((len(some), int(length.max()), model.tags))
        weight = np.full(score.shape[:2], 1e-9)
        windows = [(j, o) for j, n in enumerate(length.tolist()) for o in range(0, max(n - STRIDE, 1), STRIDE)]
        inner = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]) + 1.0
        for w in range(0, len(windows), 512):
            part = windows[w : w + 512]
            chars = np.full((len(part), WINDOW), tagger.CODES - 1)
            for r, (j, o) in enumerate(part):
                i, a, b = some[j]
                c = tagger.codes(texts[i][a + o : min(b, a + o + WINDOW)])
                chars[r, : len(c)] = c
            for (j, o), s in zip(part, model.scores(chars), strict=True):
                n = min(WINDOW, int(length[j]) - o)
                score[j, o : o + n] += s[:n] * inner[:n, None]
                weight[j, o : o + n] += inner[:n]
        for (i, a, _), tags in zip(some, model.decode(score / weight[:, :, None], length), strict=True):
            starts = [p for p, t in enumerate(tags.tolist()) if t % 2 == 1]
            for p in starts:
                q = p + 1
                while q < len(tags) and tags[q] == tags[p] + 1:
                    q += 1
                s, e, kind = a + p, a + q, int(tags[p]) // 2
                while e < len(texts[i]) and "0" <= texts[i][e] <= "9" and "0" <= texts[i][e - 1] <= "9":
                    e += 1  # never half a number
                if plausible(texts[i][s:e], kind) and not any(x < e and y > s for x, y, _ in base[i]):
                    found[i].append((s, e, kind))
    return found



def find_pii(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs (a column text, others stay) with base and spans: arrays of (start, end, kind), by start and then
    kind. base has what the patterns find, spans that and what the tagger adds. Null text has none. Columns of these
    names are replaced. Without any example in the corpus there is no tagger.
    """
    docs = docs.drop("base", "spans")
    model = docs.sparkSession.sparkContext.broadcast(train(docs, sample))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def as_rows(all_: list[list[tuple[int, int, int]]]) -> pa.Array:
        return pa.array([[{"start": a, "end": b, "kind": KINDS[k]} for a, b, k in s] for s in all_], span)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                base = [base_spans(t) for t in texts]
                more = added_spans(model.value, texts, base) if model.value else [[] for _ in texts]
                every = [sorted(x + y, key=lambda s: (s[0], s[2])) for x, y in zip(base, more, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, as_rows(base), as_rows(every)], [*part.schema.names, "base", "spans"])

    kind = "array<struct<start:int,end:int,kind:string>>"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(rows, f"{schema}, base {kind}, spans {kind}")


def mask(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; overlapping spans count as one."""
    found = find_pii(docs, sample)
    piece = F.aggregate("spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("to")), lambda a, s: F.when(
        s.start < a.to, F.struct(a.out.alias("out"), F.greatest(a.to, s.end).alias("to"))
    ).otherwise(F.struct(
        F.concat(a.out, F.substring("text", a.to + 1, s.start - a.to), F.lit("<"), s.kind, F.lit(">")).alias("out"), s.end.alias("to")
    )))
    done = found.withColumn("__m", piece)
    whole = F.concat("__m.out", F.substring("text", F.col("__m.to") + 1, F.length("text")))
    return done.withColumn("text", F.when(F.size("spans") > 0, whole).otherwise(F.col("text"))).drop("__m", "base", "spans")

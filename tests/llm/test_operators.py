"""Each operator against a brute-force version on a small table with edge cases."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skeinlog.llm import decontaminate, line_dedup, lm, near_dedup, packing, pii, quality, sharding, substring_dedup, urls
from skeinlog.llm.components import components
from skeinlog.llm.queries import URL_RULES, tokenizer_paths

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def counted(rows):
    return collections.Counter(rows)


def split(text):
    return SPACE.findall(text or "")


def test_packing(small, none):
    out = packing.pack_documents(small, *tokenizer_paths())
    rows = out.collect()
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(tokenizer_paths()[0]).encode
    want = collections.Counter()
    for i, t in texts(small):
        ids = np.array(encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % 1024 or 1024
        edges = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want[i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert counted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    held = collections.defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in rows)
    assert len(held) <= 1.01 * -(-total // 1024) + 1
    assert packing.pack_documents(none, *tokenizer_paths()).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_plan_uses_every_piece_once(seed):
    draw = np.random.default_rng(seed)
    counts = collections.Counter(draw.integers(1, 1025, 3000).tolist())
    used = collections.Counter()
    for held, times in packing.plan(counts):
        assert sum(held) <= 1024
        for n in held:
            used[n] += times
    assert used == counts


def test_special_tokens_and_odd_characters_encode_like_the_file():
    fast, slow = packing.Encoder(*tokenizer_paths()), packing.Encoder(tokenizer_paths()[0])
    for t in ("", "a <|endoftext|> b", "漢字 かな", "tab\t\tand\n\n  spaces  ", "don't 123 4.5"):
        assert fast(t).tolist() == slow(t).tolist()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def test_pii(clashing, none):
    def fits(kind, t):
        d = re.sub("[^0-9]", "", t)
        if kind == "ip":
            return all(int(x) <= 255 for x in t.split("."))
        if kind == "card":
            return 14 <= len(d) <= 19 and pii.luhn(d)
        return kind == "email" or 10 <= len(d) <= 15

    found = pii.find_pii(clashing)
    assert set(clashing.columns) <= set(found.columns)
    rows = found.collect()
    assert len(rows) == clashing.count()
    for r in rows:
        want = sorted(
            (m.start(), n, m.end(), k) for n, (k, p) in enumerate(PATTERNS.items())
            for m in re.finditer(p, r["text"] or "") if fits(k, m[0])
        )
        assert [(s["start"], s["end"], s["kind"]) for s in r["base"]] == [(a, e, k) for a, _, e, k in want]
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))
    assert pii.find_pii(none).count() == 0
    masked = pii.mask(clashing.where("doc_id = 9014")).first()["text"]
    assert masked.startswith("<email>@d.e call <phone> or <card> at <ip>") and "4111" not in masked


def test_examples_hold_every_kind_beside_thousands_of_copies(spark):
    copy = [f"text {k} of many copies, call +1 555 123 {4567 + k} now" for k in range(40)]
    few = ["mail some.one@example.org today", "card 4111 1111 1111 1111 paid", "host 10.20.30.40 is up", "room 12 has 3 chairs"]
    rows = [(t,) for t in copy * 50 + few]
    found = pii.examples(spark.createDataFrame(rows, "text string").repartition(4), 20)
    windows = [(bytes(r["chars"]), bytes(r["tags"])) for r in found]
    assert len(windows) == len(set(windows)) == 20
    begun = {t for _, tags in windows for t in tags if t % 2}
    assert begun == {1 + 2 * k for k in range(len(pii.KINDS))}
    assert any(not any(tags) for _, tags in windows)


def test_tagger_learns_held_out_spans():
    draw = np.random.default_rng(3)
    chars, tags = draw.integers(65, 91, (400, 24)), np.zeros((400, 24), np.int64)
    for i in range(400):
        a = draw.integers(0, 16)
        chars[i, a : a + 6], tags[i, a : a + 6] = draw.integers(16, 26, 6), 2
        tags[i, a] = 1
    model = pii.tagger.Tagger(3).fit(chars[:300], tags[:300], epochs=20)
    got = model.decode(model.scores(chars[300:]), np.full(100, 24))
    assert np.mean([np.array_equal(x, y) for x, y in zip(got, tags[300:], strict=True)]) > 0.9


def test_tagger_gradients():
    draw = np.random.default_rng(0)
    model = pii.tagger.Tagger(3, size=3, embedding=2)
    chars, tags = draw.integers(0, 90, (4, 6)), draw.integers(0, 3, (4, 6))
    _, g = model.gradients(chars, tags)
    for name, at in (("forward", (1, 5)), ("backward", (3, 2)), ("out", (2, 1)), ("move", (0, 2)), ("embed", (int(chars[1, 2]), 1))):
        e = 1e-5
        model.p[name][at] += e
        up = model.gradients(chars, tags)[0]
        model.p[name][at] -= 2 * e
        down = model.gradients(chars, tags)[0]
        model.p[name][at] += e
        assert abs((up - down) / (2 * e) - g[name][at]) < 1e-5


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:p] + b[p + 1 :] == a for p in range(len(b)))


def order(i, t, version):
    return (i is not None, i or 0, version)


def versions(df):
    return {(r[0], r[1]): r[2] for r in df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()}


def test_line_dedup(spark, small, clashing, none):
    lines = spark.createDataFrame(
        [(100 + k, "shared beginning of a line, then %s and the rest of it\n" % x) for k, x in enumerate(["x", "y", "xy", "xz", "", "ü", "üü"])],
        "doc_id long, text string",
    )
    table = small.select("doc_id", "text").union(lines)
    version = versions(table)
    docs = sorted({(i, t) for i, t in texts(table)}, key=lambda d: order(*d, version[d]))
    first, n = {}, 0
    for i, t in docs:
        for k, x in enumerate((t or "").split("\n")):
            if SPACE.search(x):
                first.setdefault(x, (n, i, t, k))
                n += 1
    long = [x for x in first if len(x.encode()) >= line_dedup.LEAST]
    by_length = collections.defaultdict(list)
    for x in long:
        by_length[len(x)].append(x)
    gone = set()
    for x in long:
        for near in (len(x) - 1, len(x), len(x) + 1):
            for y in by_length[near]:
                if first[y][0] < first[x][0] and (x[:4] == y[:4] or x[-4:] == y[-4:]) and one_edit(x, y):
                    gone.add(x)
    want = {}
    for i, t in docs:
        out, removed, filled = [], 0, 0
        for k, x in enumerate((t or "").split("\n")):
            if not SPACE.search(x):
                out.append(x)
                continue
            filled += 1
            if x in gone or first[x][1:] != (i, t, k):
                removed += 1
            else:
                out.append(x)
        want[i, t] = (filled, removed, "\n".join(out) if t is not None else None)
    assert len(gone) >= 4
    # as given, the table may hold a document twice: the result has a row for each
    rows = line_dedup.with_kept_lines(table).collect()
    assert len(rows) == table.count()
    for r in rows:
        assert (r["n_lines"], r["n_removed"], r["kept"]) == want[r["doc_id"], r["text"]]
    kept = line_dedup.keep_lines(clashing)
    assert kept.columns == clashing.columns and kept.count() == clashing.count()
    assert line_dedup.dedup_lines(none).count() == 0


def clashing_texts(spark, make):
    """Two texts under null whose doc_key agrees in its low 24 bits, and what doc_key gives, in its order."""
    # pairs of this many texts clash about 30 times
    keyed = spark.range(32_000).select(F.concat(F.lit(make(0)), F.col("id").cast("string"), F.lit(make(1))).alias("t"))
    keyed = keyed.withColumn("k", F.xxhash64("t"))
    low = keyed.groupBy((F.col("k").bitwiseAND(F.lit((1 << 24) - 1))).alias("b")).agg(F.sort_array(F.collect_list(F.struct("k", "t"))).alias("all"))
    pair = low.where("size(all) > 1").orderBy("b").first()["all"][:2]
    return [r["t"] for r in pair]


def test_texts_of_one_id_whose_hashes_agree_in_part_stay_apart(spark):
    shape = "doc_id long, text string"
    tail = " ".join(f"t{k}" for k in range(30))
    a, b = clashing_texts(spark, lambda side: ("start ", f" {tail}")[side])
    # the later text repeats the earlier one's tail; the first two words of each stay
    rows = substring_dedup.remove_repeats(spark.createDataFrame([(None, a), (None, b)], shape)).collect()
    assert sorted((r["n_removed"], r["kept"]) for r in rows) == sorted([(0, a), (30, b[: -len(tail) - 1])])
    a, b = clashing_texts(spark, lambda side: ("a line of its own before the number ", "\nanother line that both of them hold")[side])
    rows = line_dedup.dedup_lines(spark.createDataFrame([(None, a), (None, b), (None, b)], shape)).collect()
    assert len(rows) == 3 and sorted({r["n_removed"] for r in rows}) == [0, 1]
    assert {r["kept"] for r in rows if r["n_removed"] == 0} == {a}
    assert {r["kept"] for r in rows if r["n_removed"] == 1} == {b.split("\n")[0]}


def test_line_hashes_agree_with_python():
    assert line_dedup.one_edit("abc", "abd") and line_dedup.one_edit("abc", "ab") and line_dedup.one_edit("abc", "xabc")
    assert not line_dedup.one_edit("abc", "abc") and not line_dedup.one_edit("abc", "acb")


def test_substring_dedup(small, none):
    version = versions(small)
    docs = sorted({(i, t) for i, t in texts(small)}, key=lambda d: order(*d, version[d]))
    seen, want = {}, {}
    for n, (i, t) in enumerate(docs):
        w = split(t)
        for s in range(len(w) - 19):
            seen.setdefault(tuple(w[s : s + 20]), (n, s))
    for n, (i, t) in enumerate(docs):
        w = split(t)
        gone = set()
        for s in range(len(w) - 19):
            if seen[tuple(w[s : s + 20])] < (n, s):
                gone.update(range(s, s + 20))
        want[i, hashlib.sha256(" ".join(x for p, x in enumerate(w) if p not in gone).encode()).hexdigest(), len(w), len(gone)] = 1
    rows = substring_dedup.remove_repeats(small).collect()
    assert len(rows) == small.count()
    got = {(r["doc_id"], hashlib.sha256(r["kept"].encode()).hexdigest(), r["n_words"], r["n_removed"]) for r in rows}
    assert got == set(want)
    assert any(r["n_removed"] for r in rows)
    assert substring_dedup.remove_repeats(none).count() == 0


def test_automaton_finds_first_ends():
    a = substring_dedup.Automaton()
    a.add("a b c d".split())
    a.add("b c d e".split())
    assert list(a.first_ends("x b c d e".split(), 2)) == [(2, 2), (3, 3), (4, 8)]


def test_quality(clashing, none):
    stats = quality.quality_stats(clashing.withColumnRenamed("stats", "stats_"))
    for r in stats.collect():
        t = r["text"] or ""
        w = split(t)
        seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        twice = {p for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
        lines = [x for x in t.split("\n") if SPACE.search(x)]
        s = r["stats"]
        assert (s["n_words"], s["word_chars"], s["n_symbols"], s["n_dup_lines"], s["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(map(t.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(twice),
        )
    kept = quality.keep_good(clashing)
    assert kept.columns == clashing.columns and 0 < kept.count() < clashing.count()
    assert quality.keep_good(none).count() == 0


def test_quality_finds_labelled_junk(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    judged = quality.judge(quality.quality_stats(docs).cache()).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    open_ = judged.where("NOT base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n"))
    share = {r["quality"]: r["kept"] for r in open_.collect()}
    assert share[1] > 0.98 and share.get(0, 0) < 0.1


def planted_votes(spark, right, wrong, silent=0.2, good=0.75, n=30000):
    """Votes of independent rules of known accuracy on documents of known class, as counts of patterns."""
    r = random.Random(5)
    counts = collections.Counter()
    for _ in range(n):
        is_good = r.random() < good
        votes = []
        for hit_good, hit_bad in zip(right, wrong, strict=True):
            vote = (1 if r.random() < hit_good else -1) if is_good else (-1 if r.random() < hit_bad else 1)
            votes.append(0 if r.random() < silent else vote)
        counts[tuple(votes)] += 1
    names = [f"v{k}" for k in range(len(right))]
    return names, spark.createDataFrame([(*v, c) for v, c in counts.items()], [*names, "n"])


@pytest.mark.parametrize("right, wrong", [
    ([0.95, 0.9, 0.97, 0.85, 0.99, 0.8], [0.8, 0.7, 0.6, 0.75, 0.5, 0.65]),
    ([0.95, 0.9, 0.97, 0.85, 0.99, 0.4], [0.8, 0.7, 0.6, 0.75, 0.5, 0.55]),  # the last rule is worse than chance
])
def test_votes_of_known_accuracy_are_recovered(spark, right, wrong):
    names, patterns = planted_votes(spark, right, wrong)
    model = quality.fit_votes(patterns.coalesce(1), names)
    assert abs(model["good"] - 0.75) < 0.05
    for k, v in enumerate(names):
        assert abs(model["right", v] - right[k]) < 0.05 and abs(model["wrong", v] - wrong[k]) < 0.05
        assert abs(model["silent", v] - 0.2) < 0.02
    assert quality.fit_votes(patterns.limit(0), names)["good"] == quality.GOOD


def test_a_noisy_rule_loses_its_say(spark):
    """One vote against a document counts while its rule is sound, and no longer when it votes at random."""
    right, wrong = [0.98, 0.97, 0.99, 0.95], [0.85, 0.8, 0.9, 0.7]
    against = spark.createDataFrame([(1, 0, 0, -1)], ["v0", "v1", "v2", "v3"])
    say = []
    for r, w in ((0.995, 0.9), (0.5, 0.5)):
        names, patterns = planted_votes(spark, [*right[:3], r], [*wrong[:3], w])
        model = quality.fit_votes(patterns.coalesce(1), names)
        say.append(against.select(quality._posterior(names, model)).first()[0])
    assert say[0] < 0.5 < 0.9 < say[1]


def test_lm(spark, small, none, tmp_path):
    small.write.parquet(f"{tmp_path}/d.parquet")
    docs = spark.read.parquet(f"{tmp_path}/d.parquet")
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c, tokens = collections.Counter(), []
    for i, t in texts(docs):
        w = [*split((t or "").translate(LOW)), None]
        tokens.append((i, w))
        if not held(i):
            c.update(w)
    total, kinds = sum(c.values()), len(c)
    want = collections.Counter(
        (i is None, i or 0, held(i), len(w), sum(c[x] > 0 for x in w), total, round(sum(np.log10((c[x] + 1) / (total + kinds + 1)) for x in w), 3))
        for i, w in tokens
    )
    rows = lm.score_documents(docs).collect()
    got = collections.Counter(
        (r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3)) for r in rows
    )
    assert got == want
    assert all(r["score"] < 0 for r in rows)
    size = {(i, len((t or "").encode())) for i, t in texts(docs)}
    assert all(r["bits_per_byte"] is None or any(i == r["doc_id"] and abs(-r["score"] / math.log10(2) / n - r["bits_per_byte"]) < 1e-6 for i, n in size if n) for r in rows)
    # rows that do not come from files, in blocks of few bytes, score the same
    again = lm.score_documents(docs.repartition(3))
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], round(r["score"], 1))
    lm.BLOCK_BYTES, kept = 20_000, lm.BLOCK_BYTES
    try:
        assert collections.Counter(key(r)[:3] for r in again.collect()) == collections.Counter(key(r)[:3] for r in rows)
    finally:
        lm.BLOCK_BYTES = kept
    none.write.parquet(f"{tmp_path}/e.parquet")
    assert lm.score_documents(spark.read.parquet(f"{tmp_path}/e.parquet")).count() == 0


def test_bits_of_a_context_add_up_to_one():
    from skeinlog.llm import context_mix as cm

    table = np.zeros((2, cm.SLOTS), np.float32)
    weights, seen = cm.start_weights(), np.zeros((cm.GATES, cm.BINS, 2))
    learned, times = [b"the", b"then", b"thence", b"thenard", b"of"], np.array([9, 2, 5, 1, 5])
    cm.count(learned, times, table)
    cm.learn(learned, times, np.zeros(5, np.int64), table, weights, seen, np.full(2, 0.1))
    refined = cm.refinement(seen)

    def chance(*words, least=0):
        """Of words that were not learned from, among those that were."""
        text, n = learned + list(words), np.concatenate([times, np.zeros(len(words), np.int64)])
        return 10 ** cm.log10_probability(text, n, np.full(len(text), least), table, weights, refined)[len(learned) :]

    # all texts of no or one byte, and all others by their first byte
    bytes_ = [bytes([b]) for b in range(256) if b != 0x20]
    p0 = chance(b"")[0]
    assert 0 < p0 < 1 and p0 + chance(*bytes_).sum() < 1
    assert chance(*[b"a" + x for x in bytes_]).sum() < 1
    # the same past the bytes that words counted together share
    assert chance(b"then", *[b"then" + x for x in bytes_]).sum() < 1
    assert chance(b"thenc", *[b"thenc" + x for x in bytes_]).sum() < 1
    known, unknown = chance(b"the", b"qzx")
    assert known > unknown
    # what follows all of the word so far counts only where its context lies whole among the words
    assert chance(b"thence")[0] != chance(b"thence", least=9)[0]


def test_counts_after_all_of_the_word_so_far():
    from skeinlog.llm import context_mix as cm

    rng = np.random.default_rng(5)
    words = sorted({bytes(rng.integers(97, 99, rng.integers(0, 9)).astype(np.uint8)) for _ in range(300)})
    times = rng.integers(0, 4, len(words))
    bits = cm.Bits(words)
    use, counts = cm.alike(bits, times, np.zeros(len(words), np.int64))
    at = 0
    for w in words:
        for k, byte in enumerate(w + b" "):
            for j in range(8):
                seen = [0, 0]
                for v, n in zip(words, times.tolist(), strict=True):
                    v += b" "
                    if len(v) > k and v[:k] == w[:k] and v[k] >> (8 - j) == byte >> (8 - j):
                        seen[v[k] >> (7 - j) & 1] += n
                assert counts[j][:, at].tolist() == (seen if k >= cm.SHARED else [0, 0])
            assert use[at] == (k >= cm.SHARED)
            at += 1


@pytest.mark.parametrize("most", [3, 7, 50])
def test_words_that_begin_alike_stay_together(most, monkeypatch):
    from skeinlog.llm import context_mix as cm

    monkeypatch.setattr(lm, "CHUNK", most)
    rng = np.random.default_rng(most)
    words = sorted({bytes(rng.integers(97, 99, rng.integers(1, 12)).astype(np.uint8)) for _ in range(80)})
    n = np.arange(len(words))
    rows = [pa.RecordBatch.from_arrays([pa.array([w.decode() for w in words[i : i + 9]]), pa.array(n[i : i + 9])], ["word", "n"]) for i in range(0, len(words), 9)]
    got = list(lm._together(iter(rows)))
    assert [w for text, _, _ in got for w in text] == words and np.concatenate([x for _, x, _ in got]).tolist() == n.tolist()
    for text, _, least in got:
        assert len(text) <= most
        mine = set(text)
        for w, first in zip(text, least.tolist(), strict=True):
            for k in range(cm.SHARED, len(w) + 1):
                whole = all(v in mine for v in words if v[:k] == w[:k])
                assert whole == (k >= first), (w, k)


def shingles(t):
    w = split((t or "").translate(LOW))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, small, clashing, none, percent):
    base = [f"word{k}" for k in range(120)]
    copies = []
    for k in range(40):  # a cloud of variants around one text
        w = list(base)
        for j in range(k % 6):
            w[(k * 17 + j * 29) % 120] = f"edit{k}x{j}"
        copies.append((20_000 + k, " ".join(w)))
    table = small.select("doc_id", "text").union(spark.createDataFrame(copies, "doc_id long, text string"))
    rows = near_dedup.near_duplicates(table, percent).collect()
    assert len(rows) == table.count()
    docs = [(i, shingles(t)) for i, t in set(texts(table)) if i is not None]
    root = {i: i for i, _ in docs}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, s) in enumerate(docs):
        for j, t in docs[:n]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        elif r["doc_id"] != 9008:  # two texts under one id
            assert r["component_id"] == top(r["doc_id"]) and r["kept"] == (top(r["doc_id"]) == r["doc_id"])
    kept = near_dedup.keep_first(clashing, percent)
    assert kept.columns == clashing.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert 9004 in ids and 9005 not in ids
    assert near_dedup.near_duplicates(none).count() == 0


def test_texts_of_one_id_are_near_duplicates_each_on_its_own(spark):
    base = [f"word{k}" for k in range(120)]
    near, twin, far = " ".join(base), " ".join([*base, "more"]), " ".join(f"other{k}" for k in range(60))
    apart = [" ".join(f"x{j}y{k}" for k in range(40)) for j in range(3)]
    both = [" ".join(f"both{k}" for k in range(n)) for n in (60, 61)]  # near each other, under one id
    rows = [(3, twin), (5, far), (5, near), (5, near), *[(5, t) for t in apart], (7, both[0]), (7, both[1]), (8, apart[0])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    version = versions(table)
    told = near_dedup.near_duplicates(table).collect()
    assert len(told) == len(rows)
    got = {(r["doc_id"], r["version"]): (r["component_id"], r["kept"]) for r in told}
    first = min(both, key=lambda t: version[7, t])
    want = {(3, twin): (3, True), (5, far): (5, True), (5, near): (3, False), (8, apart[0]): (5, False)}
    want |= {(5, t): (5, True) for t in apart} | {(7, t): (7, t == first) for t in both}
    assert got == {(i, version[i, t]): v for (i, t), v in want.items()}
    kept = counted(texts(near_dedup.keep_first(table)))
    assert kept == counted(k for k, v in want.items() if v[1])


def test_components(spark):
    draw = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in draw.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5)]
    root = {x: x for p in links for x in p}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    got = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for x in root if any(x in p and p[0] != p[1] for p in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_decontamination(spark, sf, clashing, none):
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text")
    more = [(None, "several texts of this table hold in full one passage"), (7001, "Unï cödé"), (7002, "cödé"), (7003, ""), (7004, None),
            (7005, "passage of twelve words that several texts of this table"), (7005, "w0"), (7006, "nowhere to be found"), (7006, "nowhere to be found")]
    items = items.union(spark.createDataFrame(more, items.schema))
    windows = collections.defaultdict(set)
    for i, t in [(r[0], r[1]) for r in items.collect()]:
        w = ALNUM.findall((t or "").translate(LOW))
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[s : s + n])].add(i)
    rows = decontaminate.contamination(clashing, items).collect()
    assert len(rows) == clashing.count()
    want = collections.Counter()
    for i, t in texts(clashing):
        w = ALNUM.findall((t or "").translate(LOW))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        want[i, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))] += 1
    assert collections.Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in rows) == want
    kept = decontaminate.drop_contaminated(clashing, items)
    assert kept.columns == clashing.columns
    assert kept.count() == sum(n for (_, _, hit, _), n in want.items() if not hit)
    assert decontaminate.contamination(none, items).count() == 0
    assert decontaminate.contamination(clashing, items.where("false")).where("n_hit > 0").count() == 0


def test_urls(spark):
    given = ["http://A.Example.ORG/en/123", "https://example.org", "ftp://x.com/de/1?q", "no scheme", "", None, "://org/", "http://org/es/", "http://b.example.org/es/#x",
             "http://notexample.org/es/", "http://x.com/fr", "http://example.org/EN/1", "http://a..org/x", "http://u@h.com:80/de/", "http://x.com/de/a\nb"]
    pages = spark.createDataFrame([(k % 13 or None, u, "clash", "clash") for k, u in enumerate(given * 2)], "page_id long, url string, rule string, host string")
    rules = spark.createDataFrame([*URL_RULES, ("example.org", "/es/", "allow"), (None, "/", "block"), ("com", None, "block"), ("", "/", "block")], "host string, path string, verdict string")
    out = urls.filter_urls(pages, rules).collect()
    assert len(out) == len(given) * 2
    for r in out:
        m = re.search(r"(?s)://([^/?#]*)([^?#]*)", r["url"] or "")
        host, path = (m[1].translate(LOW), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, best[1], best[2])
    assert urls.filter_urls(pages.where("false"), rules).count() == 0
    assert urls.filter_urls(pages, rules.where("false")).where("rule IS NOT NULL").count() == 0


@pytest.mark.parametrize("limit", [500, 20_000, 10**9])
def test_sharding(small, clashing, none, limit):
    out = sharding.shard(clashing, ["doc_id"], F.octet_length("text"), limit)
    rows = out.select("doc_id", "text", "shard", "shard_bits", "shard_bytes", "shard_rows").collect()
    assert counted((r["doc_id"], r["text"]) for r in rows) == counted(texts(small))
    held = collections.defaultdict(list)
    for r in rows:
        held[r["shard"]].append(len((r["text"] or "").encode()))
        assert len(r["shard"]) == r["shard_bits"] + 1
    for r in rows:
        assert (r["shard_bytes"], r["shard_rows"]) == (sum(held[r["shard"]]), len(held[r["shard"]]))
        assert r["shard_bytes"] <= limit or r["shard_rows"] == 1
    names = sorted(held)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False))
    assert sharding.shard(none, ["doc_id"], F.octet_length("text"), limit).count() == 0


def test_places_follow_from_rows_and_copies_are_parted(spark):
    """Two runs over rows in another order give each row the same shard, and a hot group of copies is split as well."""
    rows = [(i, f"text {i}") for i in range(200)] + [(7, "copied " * 9)] * 60 + [(None, None)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"shard": F.lit("x"), "m": F.create_map(F.lit("k"), F.col("doc_id"))})
    runs = []
    for parts in (1, 7):
        out = sharding.shard(df.repartition(parts), ["doc_id"], F.octet_length("text"), 300).select("doc_id", "text", "shard", "shard_bytes").collect()
        assert len(out) == len(rows) and all(r["shard_bytes"] <= 300 for r in out)
        runs.append({(r["doc_id"], r["shard"]) for r in out if r["text"] and r["text"].startswith("text")})
    assert len(runs[0]) == 200
    # what is not a copy of a hot row lies below the same prefix of its hash, however deep the copies made the directory
    by = [{d: s for d, s in run} for run in runs]
    assert all(by[0][d].startswith(by[1][d]) or by[1][d].startswith(by[0][d]) for d in by[0])


def test_sharding_query_writes_whole_rows(spark, sf):
    from skeinlog.llm import queries
    from skeinlog.llm.common import shared_folder

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    root = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(root))
    rows = queries.op10(spark, sf).collect()
    (name,) = [x for x in set(os.listdir(root)) - before if x.startswith("skeinlog-shards-")]
    written = spark.read.parquet(f"{root}/{name}")
    assert counted(map(tuple, written.select(*docs.columns).collect())) == counted(map(tuple, docs.collect()))
    want = {
        r["doc_id"]: sum(len(x.encode()) if isinstance(x, str) else 8 for x in r if x is not None) for r in docs.collect()
    }
    assert {r["doc_id"]: r["n_bytes"] for r in rows} == want
    held = collections.Counter()
    for r in rows:
        held[r["shard"]] += r["n_bytes"]
    assert all(r["shard_bytes"] == held[r["shard"]] <= sharding.LIMIT or r["shard_rows"] == 1 for r in rows)

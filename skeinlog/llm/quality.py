"""Quality rules as weak supervision: each rule votes good, bad or not at all, and expectation-maximisation finds how far
to trust which. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinlog.llm.common import bind, cut

SPACES = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_shouts"]
#: Rounds of expectation-maximisation at most, and the change of an estimate below which it stops.
ROUNDS, STILL = 40, 5e-4
#: Starting point: share of good documents; how often a rule that votes is right on good and on bad ones. Rules seldom
#: speak against a good document, and each knows one kind of junk only.
GOOD, RIGHT, WRONG = 0.85, 0.999, 0.2
#: Belief in RIGHT, as votes of this share of all documents. Votes against a document would otherwise fit "bad" as well
#: as "good but unlucky" where only one rule ever speaks; nothing pulls the other estimates.
PRIOR = 0.01
#: Votes, half of either kind, that keep an estimate off 0 and 1.
GUARD = 0.01


def _counted(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more; windows are compared by a 64-bit hash.

    Only a text that has such windows sorts them, as (hash, place), so that equal ones are neighbours.
    """
    def hashes(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: (
            (x.h == F.get(s, k + 1).h) | ((k > 0) & (x.h == F.get(s, k - 1).h))
        ))
        return bind(F.sort_array(F.transform(twice, lambda x: x.i)), lambda p: F.aggregate(
            F.transform(p, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3)))),
            F.lit(0).cast("long"), lambda a, x: a + x,
        ))

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(bind(
            F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered,
        ))

    return bind(words, lambda w: F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(bind(hashes(w), count)))


def quality_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds one struct column, stats, of long numbers. Null text counts as empty; no text is shortened."""
    t = F.coalesce(F.col(text), F.lit(""))
    filled = F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    facts = {
        "n_words": bind(_words(t), F.size),
        "word_chars": F.length(F.translate(t, SPACES, "")),
        "n_symbols": _counted(t, SYMBOLS),
        "n_dup_lines": bind(filled, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": _repeat_words(_words(t)),
        "n_upper": _counted(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "n_letters": _counted(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
        "n_shouts": _counted(t, "!?"),
    }
    return docs.withColumn("stats", F.struct(*[v.cast("long").alias(k) for k, v in facts.items()]))


@dataclass(frozen=True)
class Rule:
    """Votes bad from `bad` on and good up to `good`; abstains between, and where its measure is null."""

    name: str
    measure: Column
    good: float
    bad: float

    @property
    def vote(self) -> Column:
        return F.when(self.measure >= self.bad, F.lit(-1)).when(self.measure <= self.good, F.lit(1)).otherwise(F.lit(0))


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole))


def default_rules(s: str = "stats") -> list[Rule]:
    """Measures of junk, each 0 for clean text; s is the column of quality_stats."""
    mean = _share(f"{s}.word_chars", f"{s}.n_words")
    return [
        Rule("odd_words", F.abs(mean - 6), 3, 7),
        Rule("symbols", _share(f"{s}.n_symbols", f"{s}.n_words"), 0.02, 0.1),
        Rule("dup_lines", _share(f"{s}.n_dup_lines", f"{s}.n_words"), 0.005, 0.05),
        Rule("repeats", _share(f"{s}.n_repeat_words", f"{s}.n_words"), 0.2, 0.4),
        Rule("capitals", _share(f"{s}.n_upper", f"{s}.n_letters"), 0.15, 0.4),
        Rule("shouts", _share(f"{s}.n_shouts", f"{s}.n_words"), 0.05, 0.2),
    ]


def _log_odds(votes: list[str], model: dict) -> Column:
    """Log of P(good | votes) / P(bad | votes). A rule that abstains says nothing."""
    out = F.lit(math.log(model["good"] / (1 - model["good"])))
    for v in votes:
        right, wrong = model["right", v], model["wrong", v]
        out = out + F.when(F.col(v) == 1, math.log(right / (1 - wrong))).when(
            F.col(v) == -1, math.log((1 - right) / wrong)
        ).otherwise(0.0)
    return out


def _posterior(votes: list[str], model: dict) -> Column:
    return 1 / (1 + F.exp(-_log_odds(votes, model)))


def fit_votes(patterns: DataFrame, votes: list[str], rounds: int = ROUNDS) -> dict:
    """Expectation-maximisation over the counts of vote patterns (columns: the votes and n), at most 3^rules rows.

    "right", v: how often rule v, when it votes on a good document, votes good; "wrong", v: when it votes on a bad one,
    votes bad; "silent", v: how often it abstains, on good and bad alike. Estimates are free: a rule may turn out to be
    no better than chance, or worse. The start tells which class is called good; PRIOR is the only pull. Each round is
    one aggregate that returns one row. Without rows the starting point stays.
    """
    start = {"good": GOOD} | {("right", v): RIGHT for v in votes} | {("wrong", v): WRONG for v in votes}
    start |= {("silent", v): 0.0 for v in votes}
    model = dict(start)
    for _ in range(rounds):
        p = _posterior(votes, model)
        sums = [F.sum("n").alias("all"), F.sum(p * F.col("n")).alias("good")]
        for k, v in enumerate(votes):
            for name, vote in (("plus", 1), ("minus", -1)):
                held = F.when(F.col(v) == vote, F.col("n")).otherwise(0)
                sums += [F.sum(p * held).alias(f"{name}_good_{k}"), F.sum((1 - p) * held).alias(f"{name}_bad_{k}")]
        got = patterns.agg(*sums).first()
        if not got["all"]:
            return start

        def rate(hit: float, miss: float, belief: float = 0.0) -> float:
            return (hit + belief * RIGHT + GUARD / 2) / (hit + miss + belief + GUARD)

        new = {"good": rate(got["good"], got["all"] - got["good"])}
        for k, v in enumerate(votes):
            right, off = got[f"plus_good_{k}"], got[f"minus_good_{k}"]
            wrong, missed = got[f"minus_bad_{k}"], got[f"plus_bad_{k}"]
            new["right", v], new["wrong", v] = rate(right, off, PRIOR * got["all"]), rate(wrong, missed)
            new["silent", v] = max(0.0, 1 - (right + off + wrong + missed) / got["all"])
        change = max(abs(new[k] - model[k]) for k in new)
        model = new
        if change < STILL:
            break
    return model


def judge(stats: DataFrame, rules: list[Rule] | None = None, least: float = 0.5) -> DataFrame:
    """Adds p_good, base_failed and kept to rows that have the column stats, which must be cheap to read again.

    base_failed: under 50 words, or over half of the words in repeated windows. kept: not base_failed, and a posterior
    of being good of at least `least`. Rows without text fail; columns of the new names are replaced.
    """
    rules = default_rules() if rules is None else rules
    votes = [f"__vote_{r.name}" for r in rules]
    voted = stats.withColumns({v: r.vote for v, r in zip(votes, rules, strict=True)})
    failed = (F.col("stats.n_words") < 50) | (100 * F.col("stats.n_repeat_words") > 50 * F.col("stats.n_words"))
    # what fails anyway would teach the rules only how to find it
    patterns = cut(voted.where(~failed).groupBy(*votes).agg(F.count(F.lit(1)).alias("n")))
    model = fit_votes(patterns, votes)
    return (
        voted.withColumns({"p_good": _posterior(votes, model), "base_failed": failed})
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least))
        .drop(*votes)
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that the rules keep, with their own columns, whatever their names."""
    held = docs.select(F.struct("*").alias("__doc"), F.col(text).alias("__text"))
    out = judge(cut(quality_stats(held, "__text").drop("__text")))
    return out.where("kept").select("__doc.*")

"""Quality rules with weak supervision, in DataFrame functions only.

Every rule votes good (1), bad (-1) or abstains (0) on a text.  Expectation-maximisation estimates, without labels, the
share of good texts and how each rule votes on good and on bad ones; a text stays if its posterior probability of being
good is at least a half.  The model sees only counts of vote patterns, of which there are at most 3^rules whatever the
size of the corpus, so one iteration is one small aggregation; statistics cover every text.

Texts are measured in the row; nothing is exploded or shuffled but the pattern counts.  A null text has no words.  Rows
are judged one by one, so repeated rows and null keys are no special case; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.projection import materialise

#: Fixed values of the contract: what separates words, and the symbols that count.
SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
SPAN = 5
SENTENCE_END = r"[.!?\u2026][\"'\u201D\u00BB)]?[\x20\x09-\x0D]*+$"


def measure(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``keep`` and ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_shouts, n_letters, n_ended``.

    All are counts over the whole text; ``n_ended`` are the lines that end like a sentence.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    cut = docs.select(
        *keep,
        F.filter(F.split(body, f"[{SPACE}]+"), lambda w: w != "").alias("_words"),
        F.filter(F.split(body, "\n", -1), lambda line: line.rlike(f"[^{SPACE}]")).alias("_lines"),
        F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(body, "[^!?]+", "")).cast("long").alias("n_shouts"),
        F.length(F.regexp_replace(body, r"\P{L}+", "")).cast("long").alias("n_letters"),
    )
    windows = F.size("_words") - (SPAN - 1)
    starts = F.when(windows > 0, F.sequence(F.lit(0), windows - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(F.col("_words"), i + k) for k in range(SPAN))))
    hashed = cut.withColumn("_hashes", hashes)
    # Different hashes prove different windows; only texts with an equal pair of hashes compare the words themselves.
    again = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    grams = F.transform(starts, lambda i: F.struct(F.slice("_words", i + 1, SPAN).alias("g"), i.alias("i")))
    ordered = hashed.withColumn("_sorted", F.when(again, F.array_sort(grams)))

    def repeated(x, k):
        same = lambda j: F.coalesce(F.get(F.col("_sorted"), j)["g"] == x["g"], F.lit(False))
        return F.when(same(k - 1) | same(k + 1), x["i"])

    found = F.array_sort(F.filter(F.transform("_sorted", repeated), lambda i: i.isNotNull()))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        found, start,
        lambda acc, i: F.struct((acc["n"] + i + SPAN - F.greatest(i, acc["end"])).alias("n"), (i + SPAN).alias("end")),
        lambda acc: acc["n"],
    )
    return ordered.select(
        *keep, F.size("_words").cast("long").alias("n_words"), F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols", F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "n_shouts", "n_letters",
        F.size(F.filter("_lines", lambda line: line.rlike(SENTENCE_END))).cast("long").alias("n_ended"),
    )


@dataclass(frozen=True)
class VotingRule:
    """Bad where ``bad`` holds, else good where ``good`` holds, else no vote.  Both are SQL over the measures."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), -1).when(F.expr(self.good), 1).otherwise(0)


RULES = (
    VotingRule("length", "n_words < 10", "n_words >= 20"),
    VotingRule("repetition", "100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 5 * n_words"),
    VotingRule("symbols", "100 * n_symbols > 10 * n_words", "100 * n_symbols <= 3 * n_words"),
    VotingRule("lines", "100 * n_dup_lines > 30 * n_lines", "n_lines >= 2 AND 100 * n_dup_lines <= 10 * n_lines"),
    VotingRule("word_length", "word_chars > 14 * n_words OR 2 * word_chars < 5 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    VotingRule("letters", "100 * n_letters < 75 * word_chars", "100 * n_letters >= 90 * word_chars"),
    VotingRule("endings", "100 * n_ended < 30 * n_lines", "100 * n_ended >= 60 * n_lines"),
    VotingRule("shouting", "100 * n_shouts > 25 * n_words", "100 * n_shouts <= 5 * n_words"),
)
BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"
VOTES = (-1, 0, 1)


@dataclass(frozen=True)
class VoteModel:
    """``good`` is the share of good texts; ``given[rule][vote]`` the pair (probability if good, if bad)."""

    good: float
    given: dict[str, dict[int, tuple[float, float]]]

    def log_odds(self) -> Column:
        total = F.lit(math.log(self.good / (1 - self.good)))
        for rule, by_vote in self.given.items():
            for vote, (if_good, if_bad) in by_vote.items():
                total = total + F.when(F.col(f"_v_{rule}") == vote, math.log(if_good / if_bad)).otherwise(0.0)
        return total

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))


def initial_model(rules: Sequence[VotingRule], good: float = 0.85, alarm: float = 0.03, found: float = 0.4) -> VoteModel:
    """A bad vote on ``alarm`` of the good and ``found`` of the bad texts: each rule knows one of many defects."""
    return VoteModel(good, {r.name: {-1: (alarm, found), 0: (1.0, 1.0), 1: (1 - alarm, 1 - found)} for r in rules})


def estimate(patterns: DataFrame, rules: Sequence[VotingRule], *, rounds: int = 20, tolerance: float = 1e-5, smooth: float = 1.0, lift: float = 2.0) -> VoteModel:
    """EM over ``(_v_<rule>..., n)``.  Each round is one aggregation to a single row.

    A rule never turns round: its bad vote stays at least ``lift`` times likelier on bad texts than on good ones, which
    keeps the two classes from changing places.  Abstaining tells nothing about the class.
    """
    model = initial_model(rules)
    for _ in range(rounds):
        weighed = patterns.withColumn("_q", model.posterior())
        sums = [F.sum(F.col("n")).alias("n"), F.sum(F.col("n") * F.col("_q")).alias("q")]
        for r in rules:
            for v in (-1, 1):
                at = F.when(F.col(f"_v_{r.name}") == v, F.col("n")).otherwise(0)
                name = f"{r.name}_{'bad' if v < 0 else 'good'}"
                sums += [F.sum(at).alias(f"n_{name}"), F.sum(at * F.col("_q")).alias(f"q_{name}")]
        row = weighed.agg(*sums).first()
        if not row["n"]:
            return model
        n, q = float(row["n"]), float(row["q"])
        good = min(0.99, max(0.01, (q + smooth) / (n + 2 * smooth)))
        given = {}
        for r in rules:
            n_bad, n_good = row[f"n_{r.name}_bad"], row[f"n_{r.name}_good"]
            q_bad, q_good = row[f"q_{r.name}_bad"], row[f"q_{r.name}_good"]
            alarm = min(0.4, (q_bad + smooth) / (q_good + q_bad + 2 * smooth))
            found = max(lift * alarm, (n_bad - q_bad + smooth) / (n_bad - q_bad + n_good - q_good + 2 * smooth))
            given[r.name] = {-1: (alarm, found), 0: (1.0, 1.0), 1: (1 - alarm, 1 - found)}
        moved = abs(good - model.good) + sum(abs(given[r.name][v][c] - model.given[r.name][v][c]) for r in rules for v in VOTES for c in (0, 1))
        model = VoteModel(good, given)
        if moved < tolerance:
            break
    return model


def judge(docs: DataFrame, keep: Sequence[str], *, text: str = "text", rules: Sequence[VotingRule] = RULES, least: float = 0.5) -> DataFrame:
    """``keep``, the measures, ``base_failed``, ``p_good`` and ``kept``.  The measures are stored once and read twice."""
    measured = materialise(measure(docs, keep, text))
    votes = measured.select("*", *(r.vote().alias(f"_v_{r.name}") for r in rules))
    names = [f"_v_{r.name}" for r in rules]
    patterns = materialise(votes.groupBy(*names).agg(F.count("*").alias("n")))
    model = estimate(patterns, rules)
    failed = F.expr(BASE_FAILED)
    p = model.posterior()
    return votes.select(*keep, *(c for c in measured.columns if c not in keep), failed.alias("base_failed"), p.alias("p_good"), (~failed & (p >= least)).alias("kept"))

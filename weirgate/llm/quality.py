"""Quality rules joined by weak supervision, in DataFrame functions only.

Each rule looks at one measure of a text and votes good, bad, or abstains. No rule decides alone: expectation
maximisation over how often each pattern of votes occurs in the whole corpus estimates what each vote is worth,
without labels, and a text is kept when the probability that it is good, given its votes, is high enough. Rules
overlap on purpose: a flaw that only one rule sees cannot be told from an error of that rule.

The measures are taken once per text within its row, so nothing is exploded or shuffled. What the fit sees is a
table of vote patterns, of at most ``3 ** len(RULES)`` rows whatever the corpus. The fitted weights return as
constants of one expression.

Null, empty and blank texts have no words; they fail the base rules. Repeated rows are judged alike, each by itself
and counted as often as they stand there; a null doc_id stays null. Very long texts are one row of arrays each. An empty
table gives no rows. Only the text matters; other columns, whatever their names, are not read. Where good and bad weigh
the same (a probability of just one half) the text is kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import stage

GOOD, BAD, ABSTAIN = 1, -1, 0
#: A text is kept at this probability of being good.
KEEP_FROM = 0.5
FEWEST_WORDS = 50
REPEATED_PERCENT = 50
ROUNDS, SETTLED = 500, 1e-10
#: Where the fit starts: the probability of each vote in (bad, good) texts. A bad vote tells much and a good one little.
#: As a prior it weighs as much as so many texts of either class, whatever the size of the corpus.
START = {GOOD: (0.30, 0.80), BAD: (0.50, 0.03), ABSTAIN: (0.20, 0.17)}
START_GOOD = 0.8
PRIOR_TEXTS = 10.0

_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class QualityRule:
    """Votes bad where ``bad`` holds, good where ``good`` does, and abstains in between or where both are null."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.expr(f"CASE WHEN {self.bad} THEN {BAD} WHEN {self.good} THEN {GOOD} ELSE {ABSTAIN} END")


RULES = (
    QualityRule("length", "n_words < 50", "n_words >= 80"),
    QualityRule("symbols", "n_symbols > 0.10 * n_words", "n_symbols <= 0.02 * n_words"),
    QualityRule("symbol_chars", "n_symbols > 0.05 * word_chars", "n_symbols <= 0.01 * word_chars"),
    QualityRule("letters", "n_lettered < 0.80 * n_words", "n_lettered >= 0.95 * n_words"),
    QualityRule("repeats", "n_repeat_words > 0.40 * n_words", "n_repeat_words <= 0.20 * n_words"),
    QualityRule("lines", "n_dup_lines >= 3 AND n_dup_lines > 0.30 * n_lines", "n_dup_lines <= 0.10 * n_lines"),
    QualityRule("word_length", "word_chars < 3 * n_words OR word_chars > 12 * n_words", "word_chars BETWEEN 3.5 * n_words AND 9 * n_words"),
    QualityRule("capitals", "n_capitals > 0.40 * word_chars", "n_capitals <= 0.15 * word_chars"),
    QualityRule("variety", "n_kinds < 0.20 * least(n_words, 400)", "n_kinds >= 0.35 * least(n_words, 400)"),
)


def _removed(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that rules look at, of every row."""
    plain = F.btrim(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(_BLANKS))
    split = docs.select(
        "doc_id",
        F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, "[ \\t\\n\\x0B\\f\\r]+")).alias("words"),
        F.filter(F.split(F.col("text").cast("string"), "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != "").alias("lines"),
    )
    triple = "transform(sequence(0, size(words) - 3), i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)))"
    hashed = split.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.array_join("words", "").alias("joined"),
        F.size(F.array_distinct("words")).alias("n_kinds"),
        F.size(F.filter("words", lambda w: w.rlike("\\p{L}"))).alias("n_lettered"),
        F.coalesce(F.size("lines"), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("lines") - F.size(F.array_distinct("lines")), F.lit(0)).cast("bigint").alias("n_dup_lines"),
        F.when(F.size("words") >= 3, F.expr(triple)).otherwise(F.array().cast("array<bigint>")).alias("triples"),
    )
    # Only texts that repeat a triple need theirs in order; equal neighbours are then the repeated ones.
    repeats = F.size(F.array_distinct("triples")) < F.size("triples")
    placed = F.sort_array(F.expr("transform(triples, (h, i) -> struct(h AS h, i AS i))"))
    ordered = hashed.select(
        "doc_id",
        "n_words",
        F.length("joined").cast("bigint").alias("word_chars"),
        _removed(F.col("joined"), _SYMBOLS).cast("bigint").alias("n_symbols"),
        _removed(F.col("joined"), _CAPITALS).cast("bigint").alias("n_capitals"),
        "n_kinds",
        "n_lettered",
        "n_lines",
        "n_dup_lines",
        F.when(repeats, placed).alias("placed"),
    )
    again = "filter(placed, (x, k) -> coalesce(get(placed, k - 1).h = x.h, false) OR coalesce(get(placed, k + 1).h = x.h, false))"
    starts = ordered.withColumn("starts", F.expr(f"sort_array(transform({again}, x -> x.i))")).drop("placed")
    covered = """aggregate(starts, struct(0 AS e, 0L AS n),
        (s, p) -> struct(p + 3 AS e, s.n + p + 3 - greatest(p, s.e) AS n), s -> s.n)"""
    return starts.withColumn("n_repeat_words", F.coalesce(F.expr(covered), F.lit(0)).cast("bigint")).drop("starts")


def fit(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """The share of good texts, and per rule the probability of each vote in (bad, good) texts.

    ``patterns`` are votes with their number. Rules are independent given the class. Each round gives every pattern its
    probability of either class, and counts votes by it; ``START`` tells the classes apart in the first round and is
    soon outweighed by the texts.
    """
    width = len(patterns[0][0]) if patterns else 0
    total = sum(n for _, n in patterns)
    share, table = START_GOOD, [dict(START) for _ in range(width)]
    before = -math.inf
    for _ in range(ROUNDS):
        sums = [{v: [PRIOR_TEXTS * p for p in start] for v, start in START.items()} for _ in range(width)]
        good = likelihood = 0.0
        for votes, n in patterns:
            p = [math.log(1 - share), math.log(share)]
            for rule, v in zip(table, votes):
                p = [p[0] + math.log(rule[v][0]), p[1] + math.log(rule[v][1])]
            top = max(p)
            mass = sum(math.exp(x - top) for x in p)
            likelihood += n * (top + math.log(mass))
            of_good = math.exp(p[1] - top) / mass
            good += n * of_good
            for rule, v in zip(sums, votes):
                rule[v][0] += n * (1 - of_good)
                rule[v][1] += n * of_good
        share = (good + PRIOR_TEXTS * START_GOOD) / (total + PRIOR_TEXTS)
        table = []
        for held in sums:
            whole = [sum(h[k] for h in held.values()) for k in (0, 1)]
            table.append({v: (h[0] / whole[0], h[1] / whole[1]) for v, h in held.items()})
        if abs(likelihood - before) <= SETTLED * total:
            break
        before = likelihood
    return share, table


def posterior(share: float, table: list[dict[int, tuple[float, float]]], rules=RULES) -> Column:
    """The probability that a text is good, from its vote columns."""
    odds = F.lit(math.log(share / (1 - share)))
    for rule, worth in zip(rules, table):
        weight = {v: math.log(p[1] / p[0]) for v, p in worth.items()}
        vote = F.col(f"vote_{rule.name}")
        odds = odds + F.when(vote == GOOD, weight[GOOD]).when(vote == BAD, weight[BAD]).otherwise(weight[ABSTAIN])
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, rules: tuple[QualityRule, ...] = RULES) -> DataFrame:
    """doc_id, the measures, base_failed, p_good and kept of every row.

    Base rules come first: fewer than 50 words, or more than half of them in repeated triples, is never kept.
    """
    measured = stage(measures(docs), "measures")
    votes = measured.select("*", *[r.vote().alias(f"vote_{r.name}") for r in rules])
    names = [f"vote_{r.name}" for r in rules]
    patterns = votes.groupBy(*names).agg(F.count("*").alias("n")).collect()  # 3 ** len(rules) rows at most
    share, table = fit(sorted((tuple(r[:-1]), r["n"]) for r in patterns))
    base_failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    judged = votes.withColumn("base_failed", base_failed).withColumn("p_good", posterior(share, table, rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_FROM)).drop(*names)

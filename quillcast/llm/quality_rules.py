"""Quality rules as weak supervision, DataFrame operations only.

Rules vote good, bad or abstain. Documents are counted by vote pattern, at most three to
the number of rules, and expectation-maximisation over these counts estimates how often
each rule casts each vote on good and on bad documents. The posterior probability of
being good decides, instead of every rule having to pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import SPACES, narrowed, split_words
from quillcast.session import written

GOOD, BAD, ABSTAIN = 1, -1, 0
OUTCOMES = (GOOD, BAD, ABSTAIN)

#: Frequent function words of the languages in use.
FUNCTION_WORDS = (
    "the of and to in is that it for with was on as are be this "
    "der die das und ist nicht ein eine zu den von mit auf sich des dem "
    "le la les de des et un une est que dans pour sur en du au "
    "el los las que y en un una por con para del se no su lo"
).split()

#: Pseudo-counts: how often each vote is taken to have been seen in each class.
SMOOTHING = 2.0


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, lambdas inside body included."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more."""

    def covered(windows: Column) -> Column:
        def same(at: Column, other: Column) -> Column:
            return F.coalesce(F.get(windows, at)["words"] == F.get(windows, other)["words"], F.lit(False))

        places = F.filter(F.sequence(F.lit(0), F.size(windows) - 1), lambda at: same(at, at + 1) | same(at, at - 1))
        starts = F.transform(places, lambda at: F.get(windows, at)["at"])
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda s: F.array(s, s + 1, s + 2)))))

    def of(words: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda at: F.struct(
                F.concat_ws(" ", F.get(words, at), F.get(words, at + 1), F.get(words, at + 2)).alias("words"), at.alias("at")
            ),
        )
        return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(F.sort_array(windows), covered))

    return let(words, of).cast("long")


def _length_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the counts that rules look at; null texts count as empty."""
    rows = narrowed(docs, id=id_col, text=text_col).select("id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("id", "text", split_words(F.col("text"), SPACES).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    n_lines = let(lines, lambda found: F.struct(F.size(found).alias("n"), (F.size(found) - F.size(F.array_distinct(found))).alias("dup")))
    common = F.array(*(F.lit(word) for word in sorted(set(FUNCTION_WORDS))))
    return rows.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        _length_without(F.col("text"), SPACES).cast("long").alias("word_chars"),
        (F.length("text") - _length_without(F.col("text"), r"[#*$%&|<>]+")).cast("long").alias("n_symbols"),
        n_lines.alias("lines"),
        _repeated_words(F.col("words")).alias("n_repeat_words"),
        (F.length("text") - _length_without(F.col("text"), r"\p{Lu}+")).alias("n_capitals"),
        (F.length("text") - _length_without(F.col("text"), r"\p{L}+")).alias("n_letters"),
        (F.length("text") - _length_without(F.col("text"), r"[!?]+")).alias("n_shouts"),
        F.size(F.array_intersect("words", common)).alias("n_function_words"),
    ).select("*", F.col("lines.n").cast("long").alias("n_lines"), F.col("lines.dup").cast("long").alias("n_dup_lines")).drop("lines")


def _rule(good: Column, bad: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def rules() -> dict[str, Column]:
    """Votes over the columns of ``measures``."""
    words, letters = F.greatest("n_words", F.lit(1)), F.greatest("n_letters", F.lit(1))
    symbols, repeats = F.col("n_symbols") / words, F.col("n_repeat_words") / words
    dup, caps = F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), F.col("n_capitals") / letters
    shouts, length = F.col("n_shouts") / words, F.col("word_chars") / words
    letter_share = F.col("n_letters") / F.greatest("word_chars", F.lit(1))
    function_words = F.col("n_function_words")
    return {
        "length": _rule(F.col("n_words") >= 50, F.col("n_words") < 20),
        "symbols": _rule(symbols < 0.02, symbols > 0.1),
        "duplicate_lines": _rule((F.col("n_dup_lines") == 0) & (F.col("n_lines") > 3), dup > 0.3),
        "repeats": _rule(repeats < 0.1, repeats > 0.3),
        "capitals": _rule(caps < 0.15, caps > 0.3),
        "shouting": _rule(shouts < 0.05, shouts > 0.2),
        "word_length": _rule((length > 3) & (length < 9), (length < 2) | (length > 14)),
        "letters": _rule(letter_share > 0.85, letter_share < 0.65),
        "function_words": _rule(function_words >= 4, (function_words == 0) & (F.col("n_words") >= 20)),
    }


@dataclass(frozen=True)
class VoteModel:
    """Prior of a good document, and per class and rule the probability of each vote."""

    prior: float
    good: dict[str, dict[int, float]]
    bad: dict[str, dict[int, float]]

    def log_odds(self) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, chances in self.good.items():
            votes = F.lit(0.0)
            for outcome in OUTCOMES:
                votes = F.when(F.col(rule) == outcome, math.log(chances[outcome] / self.bad[rule][outcome])).otherwise(votes)
            odds = odds + votes
        return odds

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))

    def accuracies(self) -> dict[str, float]:
        """How often a rule is right where it votes."""
        right = {rule: self.prior * self.good[rule][GOOD] + (1 - self.prior) * self.bad[rule][BAD] for rule in self.good}
        cast = {rule: self.prior * (1 - self.good[rule][ABSTAIN]) + (1 - self.prior) * (1 - self.bad[rule][ABSTAIN]) for rule in self.good}
        return {rule: right[rule] / cast[rule] for rule in right}


def fit(patterns: DataFrame, names: list[str], rounds: int = 50, tolerance: float = 1e-6) -> VoteModel:
    """Expectation-maximisation over ``patterns``: one column per rule and their count ``n``.

    The first guess takes documents with a bad vote for bad. One aggregation per round
    yields one row of sums; only that row reaches the driver.
    """
    bad_votes = sum(F.when(F.col(name) == BAD, 1).otherwise(0) for name in names)
    chance: Column = F.when(bad_votes == 0, 0.95).otherwise(0.1)
    model, before = None, None
    for _ in range(rounds):
        sums = {
            (name, outcome, of): F.sum(F.when(F.col(name) == outcome, F.col("n") * weight).otherwise(0.0)).alias(f"{name}:{outcome}:{of}")
            for name in names
            for outcome in OUTCOMES
            for of, weight in (("good", F.col("p")), ("bad", 1 - F.col("p")))
        }
        weighted = patterns.withColumn("p", chance)
        row = weighted.agg(F.sum(F.col("n") * F.col("p")).alias("good"), F.sum("n").alias("all"), *sums.values()).first()
        total, good = float(row["all"] or 0), float(row["good"] or 0)

        def chances(of: str, weight: float, row=row) -> dict[str, dict[int, float]]:
            return {
                name: {outcome: ((row[f"{name}:{outcome}:{of}"] or 0.0) + SMOOTHING) / (weight + 3 * SMOOTHING) for outcome in OUTCOMES}
                for name in names
            }

        model = VoteModel((good + SMOOTHING) / (total + 2 * SMOOTHING), chances("good", good), chances("bad", total - good))
        chance = model.posterior()
        if before is not None and abs(model.prior - before) < tolerance:
            break
        before = model.prior
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.5) -> DataFrame:
    """(id, counts, base_failed, votes, posterior, kept) per row of ``docs``.

    ``base_failed`` marks texts under 50 words or with over half their words in repeated
    three-word windows; others are kept if the posterior reaches ``keep_at``. Null and
    empty texts have no words and fail. Repeated rows come back repeated, null ids stay;
    an empty table gives no rows. Other columns are ignored. Votes of all documents
    count in the estimation.
    """
    votes = rules()
    voted = written(measures(docs, id_col, text_col).select("*", *(vote.alias(f"vote_{name}") for name, vote in votes.items())), "votes")
    names = [f"vote_{name}" for name in votes]
    patterns = written(voted.groupBy(*names).agg(F.count("*").cast("double").alias("n")), "patterns")
    model = fit(patterns, names)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        voted.withColumn("base_failed", failed)
        .withColumn("posterior", model.posterior())
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_at))
    )

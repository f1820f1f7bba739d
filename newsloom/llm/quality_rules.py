"""Quality rules as weak supervision, in Spark expressions only.

Each rule votes "good" (1), "bad" (-1) or abstains (0) on the counts of a whole text. How far a rule
can be trusted is not set by hand: expectation-maximisation estimates the accuracy of each rule's
good and bad votes from how the rules agree over all documents, and the posterior probability that a text is good replaces the
demand that it pass every rule. Equal vote patterns are counted first, so an iteration reads at most
3 ** rules rows whatever the number of documents. Estimates start from, and are drawn a little
towards, `START`; `PULL` is the weight of that as a share of a rule's votes.

The two plain limits stay as they are: a text with fewer than 50 words, or with over half its words
in repeated three-word windows, fails. NULL and empty texts have no words and fail. Texts of any length
are counted whole. Repeated rows are judged each on its own. An empty table gives an empty result. Only
id and text are carried, so other columns may have any names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.text_stats import base_counts, shape_counts, share, with_tokens
from newsloom.session import stage

START = 0.9
PULL = 0.1
LEAST = 1e-6
PRIOR_LIMITS = (0.05, 0.95)
ROUNDS = 30
SETTLED = 1e-4
KEEP = 0.5


def _vote(bad: Column, good: Column | None = None) -> Column:
    vote = F.when(bad, -1)
    return (vote if good is None else vote.when(good, 1)).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes over the counts. Few rules speak for a text; the others only speak against one."""
    length = share("word_chars", "n_words")
    return {
        "word_length": _vote((length < 2.5) | (length > 14)),
        "symbols": _vote(share("n_symbols", "n_words") > 0.2),
        "shouting": _vote((share("n_shouted", "n_words") > 0.4) & (F.col("n_words") >= 10)),
        "marks": _vote(share("n_marks", "n_words") > 0.2),
        "repeats": _vote(share("n_repeat_words", "n_words") > 0.3),
        "dup_lines": _vote((share("n_dup_lines", "n_lines") > 0.3) & (F.col("n_lines") >= 3)),
        "vocabulary": _vote(share("n_distinct", "n_words") < 0.15 - F.least(F.lit(0.1), F.col("n_words") / 100_000)),
        "stopwords": _vote((F.col("n_stopwords") < 2) & (F.col("n_words") >= 30), F.col("n_stopwords") >= 4),
        "sentences": _vote((F.col("n_ends") == 0) & (F.col("n_words") >= 50), share("n_ends", "n_words").between(0.005, 0.35)),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass
class Trust:
    """Share of good texts, and how the rules vote: {rule: {vote: (weight on good texts, weight on bad texts)}}."""

    prior: float = 0.8
    votes: dict[str, dict[int, tuple[float, float]]] = field(default_factory=dict)

    def accuracy(self, rule: str, vote: int) -> float:
        """How often the rule is right when it casts this vote."""
        good, bad = self.votes[rule][vote]
        return (good if vote == 1 else bad) / (good + bad)

    def weights(self, rule: str) -> dict[int, float]:
        """The log of how much likelier a good text gets each vote than a bad one, abstaining included."""
        good, bad = (sum(of) for of in zip(*self.votes[rule].values()))
        return {v: math.log(max(g / good, LEAST) / max(b / bad, LEAST)) for v, (g, b) in self.votes[rule].items()}

    def posterior(self) -> Column:
        logit = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule in self.votes:
            for vote, weight in self.weights(rule).items():
                logit = logit + F.when(F.col(rule) == vote, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))


def _split(n: float, good: float, vote: int, pull: float) -> tuple[float, float]:
    """`n` votes, `good` of them on good texts, with some more that are right at the rate of `START`."""
    extra = pull * n + 1 if vote else 0
    right = extra * START
    return good + (right if vote == 1 else extra - right), n - good + (extra - right if vote == 1 else right)


def estimate(votes: DataFrame, names: list[str]) -> Trust:
    """Expectation-maximisation over counted vote patterns."""
    patterns = stage(votes.groupBy(*names).agg(F.count("*").alias("_n")).repartition(1))
    cells = [(k, v) for k in names for v in (-1, 0, 1)]
    counts = patterns.agg(F.sum("_n").alias("all"), *[F.sum(F.when(F.col(k) == v, F.col("_n")).otherwise(0)).alias(f"{k}{v}") for k, v in cells]).first()
    trust = Trust()
    if not counts["all"]:
        return trust
    for k in names:
        # Before any round a vote is taken to be right at the rate of `START`.
        shares = {-1: 1 - START, 0: trust.prior, 1: START}
        trust.votes[k] = {v: _split(counts[f"{k}{v}"], counts[f"{k}{v}"] * shares[v], v, 0) for v in (-1, 0, 1)}
    for _ in range(ROUNDS):
        weighted = patterns.withColumn("_q", trust.posterior() * F.col("_n"))
        good = [F.sum(F.when(F.col(k) == v, F.col("_q")).otherwise(0.0)).alias(f"{k}{v}") for k, v in cells]
        row = weighted.agg(F.sum("_q").alias("good"), *good).first()
        new = Trust(min(max(row["good"] / counts["all"], PRIOR_LIMITS[0]), PRIOR_LIMITS[1]))
        new.votes = {k: {v: _split(counts[f"{k}{v}"], row[f"{k}{v}"], v, PULL) for v in (-1, 0, 1)} for k in names}
        moved = max([abs(new.prior - trust.prior), *(abs(new.accuracy(k, v) - trust.accuracy(k, v)) for k in names for v in (-1, 1))])
        trust = new
        if moved < SETTLED:
            break
    return trust


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, votes, the posterior `quality` and `kept`, one row per document."""
    votes = rules()
    counts = with_tokens(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", *[c.alias(n) for n, c in (base_counts() | shape_counts()).items()])
    staged = stage(counts.withColumns({"base_failed": base_failed()} | {f"vote_{k}": v for k, v in votes.items()}))
    trust = estimate(staged.where(~F.col("base_failed")), [f"vote_{k}" for k in votes])
    quality = trust.posterior()
    return staged.withColumn("quality", quality).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP))

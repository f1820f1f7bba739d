"""Quality classifier: a sparse ensemble of conjunctive rules, compiled to Spark expressions.

Features are statistics of whole texts, all Spark expressions. On a bounded sample of labelled rows
(`SAMPLE_PER_CLASS` of each class, in a fixed pseudo-random order; class weights restore the true shares) small boosted trees are grown in numpy; every path from
a root is a candidate rule, a conjunction of feature limits. A logistic model with an L1 penalty keeps
a few of them, the penalty chosen on a part of the sample. Scoring is then one column: intercept plus
the weights of the rules that hold, through the logistic function. Nothing runs in Python per row.

NULL and empty texts have all statistics 0 and get a score like any other. NULL labels are left out,
of several labels of a row the largest counts. With one class only, all scores are its share; with
no label at all they are 0.5. Rows that repeat an id are learned once and scored each; an empty table
gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_sample, fresh
from newsloom.llm.text_stats import TRIPLES, WORDS, base_counts, shape_counts, share, with_tokens

SAMPLE_PER_CLASS = 4000
TREES = 40
DEPTH = 3
CUTS = 24
SHRINK = 0.3
LEAST_ROWS = 8
PENALTIES = (0.03, 0.01, 0.003, 0.001)
STEPS = 400
APART = 5

FEATURES = (
    "words", "word_length", "symbols", "shouted", "marks", "dup_lines", "distinct", "triples", "stopwords", "digits", "ends", "line_words",
)

# A rule is a conjunction of (feature number, whether above, limit).
Rule = tuple[tuple[int, bool, float], ...]


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without its text, with one column per feature, prefixed `f_`."""
    counts = {k: c for k, c in (base_counts() | shape_counts()).items() if k != "n_repeat_words"}
    counts["n_triples"] = F.size(TRIPLES).cast("long")
    counts["n_distinct_triples"] = F.size(F.array_distinct(TRIPLES)).cast("long")
    kept = [c for c in docs.columns if c != text]
    counted = with_tokens(docs.withColumnRenamed(text, "text")).select(*kept, *[c.alias(f"_{n}") for n, c in counts.items()])
    values = {
        "words": F.log1p(F.col("_n_words").cast("double")),
        "word_length": share("_word_chars", "_n_words"),
        "symbols": share("_n_symbols", "_n_words"),
        "shouted": share("_n_shouted", "_n_words"),
        "marks": share("_n_marks", "_n_words"),
        "dup_lines": share("_n_dup_lines", "_n_lines"),
        "distinct": share("_n_distinct", "_n_words"),
        "triples": share("_n_distinct_triples", "_n_triples"),
        "stopwords": share("_n_stopwords", "_n_words"),
        "digits": share("_n_digits", "_n_words"),
        "ends": share("_n_ends", "_n_words"),
        "line_words": share("_n_words", "_n_lines"),
    }
    return counted.select(*kept, *[values[f].alias(f"f_{f}") for f in FEATURES])


@dataclass
class Ensemble:
    intercept: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def score(self) -> Column:
        """The probability as a column over the feature columns."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for feature, above, limit in rule:
                column = F.col(f"f_{FEATURES[feature]}")
                holds = holds & (column > limit if above else column <= limit)
            total = total + F.when(holds, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    def describe(self) -> list[str]:
        """The rules as text, the weightiest first."""
        shown = lambda r: " and ".join(f"{FEATURES[f]} {'>' if a else '<='} {t:.4g}" for f, a, t in r)
        return [f"{w:+.3f} if {shown(r)}" for r, w in sorted(self.rules, key=lambda x: -abs(x[1]))]


def _grow(x: np.ndarray, residual: np.ndarray, weight: np.ndarray, rows: np.ndarray, path: Rule, found: list[Rule], value: np.ndarray) -> None:
    """Split `rows` where the weighted squares of the residuals fall most; collect every path."""
    w, r = weight[rows], residual[rows]
    mean = (w * r).sum() / w.sum()
    value[rows] = mean
    if path:
        found.append(path)
    if len(path) == DEPTH or len(rows) < 2 * LEAST_ROWS:
        return
    best = (1e-9, None)
    for feature in range(x.shape[1]):
        column = x[rows, feature]
        for limit in np.unique(np.quantile(column, np.linspace(0.02, 0.98, CUTS))):
            left = column <= limit
            n = int(left.sum())
            if n < LEAST_ROWS or len(rows) - n < LEAST_ROWS:
                continue
            wl = w[left].sum()
            sl, s = (w[left] * r[left]).sum(), (w * r).sum()
            gain = sl**2 / wl + (s - sl) ** 2 / (w.sum() - wl) - s**2 / w.sum()
            if gain > best[0]:
                best = (gain, (feature, float(limit), left))
    if best[1] is None:
        return
    feature, limit, left = best[1]
    _grow(x, residual, weight, rows[left], (*path, (feature, False, limit)), found, value)
    _grow(x, residual, weight, rows[~left], (*path, (feature, True, limit)), found, value)


def _holds(x: np.ndarray, rules: list[Rule]) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for n, rule in enumerate(rules):
        for feature, above, limit in rule:
            out[:, n] *= x[:, feature] > limit if above else x[:, feature] <= limit
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _lasso(z: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """L1-penalised logistic regression by accelerated proximal steps; the intercept is free."""
    weight = weight / weight.sum()
    step = 4 / (np.linalg.norm(z * np.sqrt(weight)[:, None], 2) ** 2 + 1)
    b, beta = 0.0, np.zeros(z.shape[1])
    vb, v, t = b, beta.copy(), 1.0
    for _ in range(STEPS):
        error = weight * (_sigmoid(vb + z @ v) - y)
        nb = vb - step * error.sum()
        moved = v - step * (z.T @ error)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vb, v = nb + (t - 1) / nt * (nb - b), new + (t - 1) / nt * (new - beta)
        b, beta, t = nb, new, nt
    return float(b), beta


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, seed: int = 11) -> Ensemble:
    weight = np.ones(len(y)) if weight is None else weight
    share_good = float((weight * y).sum() / weight.sum()) if len(y) else 0.5
    if share_good in (0.0, 1.0) or len(y) < 4 * LEAST_ROWS:
        held = min(max(share_good, 1e-6), 1 - 1e-6)
        return Ensemble(float(np.log(held / (1 - held))))
    random = np.random.default_rng(seed)
    raw = np.full(len(y), np.log(share_good / (1 - share_good)))
    paths: list[Rule] = []
    for _ in range(TREES):
        rows = np.sort(random.permutation(len(y))[: max(4 * LEAST_ROWS, len(y) // 2)])
        p = _sigmoid(raw)
        value, found = np.zeros(len(y)), []
        _grow(x, (y - p) / np.maximum(p * (1 - p), 0.05), weight * np.maximum(p * (1 - p), 0.05), rows, (), found, value)
        for rule in found:
            if len(rule) == DEPTH or rule not in paths:
                paths.append(rule)
        leaves = [r for r in found if not any(r == o[: len(r)] and len(o) > len(r) for o in found)]
        if leaves:
            held = _holds(x, leaves)
            raw = raw + SHRINK * np.clip(held @ np.array([value[rows][_holds(x[rows], [r])[:, 0] > 0].mean() for r in leaves]), -4, 4)
    rules = list(dict.fromkeys(paths))
    held = _holds(x, rules)
    _, first = np.unique(held, axis=1, return_index=True)
    first = np.sort(first)
    rules, held = [rules[i] for i in first], held[:, first]
    apart = np.arange(len(y)) % APART == 0
    best = (np.inf, PENALTIES[0])
    for penalty in PENALTIES:
        b, beta = _lasso(held[~apart], y[~apart], weight[~apart], penalty)
        p = np.clip(_sigmoid(b + held[apart] @ beta), 1e-6, 1 - 1e-6)
        loss = -(weight[apart] * (y[apart] * np.log(p) + (1 - y[apart]) * np.log(1 - p))).sum() / weight[apart].sum()
        best = min(best, (loss, penalty))
    b, beta = _lasso(held, y, weight, best[1])
    return Ensemble(b, [(rules[i], float(beta[i])) for i in np.flatnonzero(np.abs(beta) > 1e-6)])


def train(labelled: DataFrame, label: str = "quality", texts: DataFrame | None = None) -> Ensemble:
    """An ensemble from the bounded sample of the labelled rows.

    `labelled` has doc_id, text and the label. Where it is a join, `texts` with the same doc_id and text is
    the table to read the chosen texts from, so that the join itself stays narrow.
    """
    names = [F.col("doc_id").alias("d"), F.col("text")]
    usable = labelled.where(F.col(label).isNotNull()).select(*names, F.col(label).cast("int").alias("y"))
    sizes = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count("*").alias("n")).collect()}
    sample = bounded_sample(usable, "y", "d", SAMPLE_PER_CLASS, None if texts is None else texts.select(*names))
    rows = with_features(sample).orderBy("n", "y").collect()
    if not rows:
        return Ensemble()
    y = np.array([r["y"] for r in rows], dtype=float)
    x = np.array([[r[f"f_{f}"] for f in FEATURES] for r in rows], dtype=float)
    taken = {k: max(1, int((y == k).sum())) for k in sizes}
    return fit(x, y, np.array([sizes[int(k)] / taken[int(k)] for k in y]))


def score(docs: DataFrame, model: Ensemble, text: str = "text", output: str = "score") -> DataFrame:
    """`docs` without its text, with the score; a column of the output's name is replaced.

    The other columns travel as one struct, so none can clash with a feature.
    """
    some = fresh(docs.columns, "_some")
    kept = F.struct(F.lit(True).alias(some), *[F.col(c) for c in docs.columns if c not in (text, output)])
    scored = with_features(docs.select(kept.alias("_kept"), F.col(text)), text).select("_kept.*", model.score().alias(output))
    return scored.drop(some)

"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees are grown on a bounded sample of labelled documents; each path from a root is a rule, a
conjunction of comparisons. A logistic model with lasso penalty keeps few of the rules, and these become one
Spark column expression. Texts are read whole; null and empty texts have all statistics 0 and get a score.

Labels: one per id, the smaller where they differ; null labels are left out. Without labels, or with one
kind alone, the score is the share of label 1 (0.5 without any). Empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.llm.quality_rules import STATISTICS, statistics

#: At most so many labelled documents are used, those of least MD5 of their id.
MOST_LABELLED = 20_000
TREES, DEPTH, LEAST_LEAF = 40, 3, 20
PENALTY = 0.002
CUT = 0.7
#: Ratios of statistics, as (numerator, denominator).
RATIOS = (("word_chars", "n_words"), ("n_symbols", "n_words"), ("n_stop_words", "n_words"), ("n_shouted", "n_words"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"), ("n_words", "n_lines"))
FEATURES = (*[f"{a}_per_{b}" for a, b in RATIOS], "n_words", "n_lines")

Condition = tuple[str, bool, float]


@dataclass(frozen=True)
class Ensemble:
    """Rules with weights; a condition is (feature, above, value): feature > value, else feature <= value."""

    bias: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for name, above, value in rule:
                holds = holds & ((F.col(name) > value) if above else (F.col(name) <= value))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def features(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the columns FEATURES."""
    out = statistics(df, text_col)
    ratios = [F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0).alias(f"{a}_per_{b}") for a, b in RATIOS]
    kept = [c for c in df.columns if c not in (*STATISTICS, *FEATURES)]
    return out.select(*[f"`{c}`" for c in kept], *ratios, F.col("n_words").cast("double").alias("n_words"), F.col("n_lines").cast("double").alias("n_lines"))


def _tree(x: np.ndarray, cuts: list[np.ndarray], binned: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[list[tuple[Condition, ...]], np.ndarray]:
    """Paths of one tree fitted to gradients, and its prediction for each row."""
    paths: list[tuple[Condition, ...]] = []
    value = np.zeros(len(x))

    def grow(rows: np.ndarray, path: tuple[Condition, ...]) -> None:
        g, h = grad[rows].sum(), hess[rows].sum()
        best = (1e-6, -1, 0)
        if len(path) < DEPTH and len(rows) >= 2 * LEAST_LEAF:
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                n = np.cumsum(np.bincount(binned[rows, f], minlength=len(c) + 1))[:-1]
                gl = np.cumsum(np.bincount(binned[rows, f], grad[rows], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, f], hess[rows], len(c) + 1))[:-1]
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                gain[(n < LEAST_LEAF) | (len(rows) - n < LEAST_LEAF)] = -1
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k)
        if best[1] < 0:
            value[rows] = g / (h + 1)
            return
        _, f, k = best
        for above in (False, True):
            part = rows[(binned[rows, f] > k) == above]
            longer = (*path, (FEATURES[f], above, float(cuts[f][k])))
            paths.append(longer)
            grow(part, longer)

    grow(np.arange(len(x)), ())
    return paths, value


def _lasso(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic weights of 0/1 columns by accelerated proximal gradient; the bias is not penalised."""
    n, m = r.shape
    bias, w, z, b = float(np.log(y.mean() / (1 - y.mean()))), np.zeros(m), np.zeros(m), 0.0
    b = bias
    size = 4 / max(1.0, float(np.linalg.norm(r, 2) ** 2 / n) + 1)
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(r @ z + b)))
        d = p - y
        new = z - size * (r.T @ d) / n
        new = np.sign(new) * np.maximum(np.abs(new) - size * penalty, 0)
        new_bias = b - size * d.mean()
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        z, b = new + (last - 1) / t * (new - w), new_bias + (last - 1) / t * (new_bias - bias)
        w, bias = new, new_bias
    return bias, w


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> Ensemble:
    """Rules from rows of FEATURES and labels 0 or 1."""
    if not len(y) or y.min() == y.max():
        share = float((y.sum() + 1) / (len(y) + 2))
        return Ensemble(float(np.log(share / (1 - share))), ())
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.01, 0.99, 48))) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    found: dict[tuple[Condition, ...], None] = {}
    total = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        paths, value = _tree(x, cuts, binned, y - p, p * (1 - p))
        found |= dict.fromkeys(tuple(sorted(p)) for p in paths)
        total += 0.3 * value
    rules = list(found)
    held = np.stack([np.logical_and.reduce([(x[:, FEATURES.index(f)] > v) == above for f, above, v in rule]) for rule in rules], axis=1).astype(np.float64) if rules else np.zeros((len(y), 0))
    bias, w = _lasso(held, y, penalty)
    return Ensemble(bias, tuple((rules[k], float(w[k])) for k in np.flatnonzero(np.abs(w) > 1e-4)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def one_of_each(sample: DataFrame) -> DataFrame:
    """One row of each doc_id of a sample: that of the least text hash, so that reruns agree and the bound on ids is one on rows."""
    rest = [c for c in sample.columns if c != "doc_id"]
    return sample.groupBy("doc_id").agg(F.min(F.struct(F.md5(F.coalesce("text", F.lit("")).cast("binary")), *rest)).alias("__row")).select("doc_id", *[F.col("__row")[c].alias(c) for c in rest])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", most: int = MOST_LABELLED) -> Ensemble:
    """An ensemble from the labelled ids that are not held out, ``most`` at most, a row for each."""
    usable = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.min(label_col).alias("__label")).orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(most)
    sample = one_of_each(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    rows = features(sample).select("doc_id", "__label", *FEATURES).orderBy("doc_id").toPandas()
    return fit(rows[list(FEATURES)].to_numpy(np.float64), (rows["__label"] == 1).to_numpy(np.float64))


def scored(docs: DataFrame, ensemble: Ensemble) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted."""
    out = features(docs.select("doc_id", "text")).withColumn("score", ensemble.score())
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))

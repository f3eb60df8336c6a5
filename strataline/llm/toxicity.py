"""Toxicity by classifier chains: linear models for categories in order, each given the ones before it.

Features of a text are its words and their beginnings, by hash; those that tell most on a bounded sample of
labelled documents are kept. A later model is trained with the probabilities that models which have not
seen a document give it for the earlier categories; models for use are then fitted on the whole sample.

Texts are read whole; null and empty texts have no features and get the models' base rates. Labels: one row
per id, the larger where they differ, null as 0. Without labels every probability is 0 and nothing is toxic.
Repeated rows get equal results, an empty table an empty one; features of equal weight are taken in the order of
their hashes, so that reruns agree. The cut is the one that serves best (by F1, the least of equals) for the
probabilities that models which have not seen a labelled document give it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.llm.rule_ensemble import one_of_each
from strataline.llm.shingles import _BLANK, _BYTE, _LOWER, blocks, mix, powers
from strataline.session import discard, materialise

#: (category, condition on the labels), in the order of the chain.
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))
MOST_LABELLED = 6_000
MOST_FEATURES = 1_500
#: A feature must be in so many documents of the sample.
LEAST_DOCUMENTS = 4
PREFIXES = (4, 5, 6, 7)
FOLDS = 4
PENALTY = 5e-5
STEPS = 300
#: The cut where the sample has no document of the last category, or none without.
CUT = 0.5

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(128) if not chr(b).isalnum()]] = True


def feature_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Distinct hashes of each text's words and word beginnings; ASCII case and punctuation are ignored."""
    with np.errstate(over="ignore"):
        for some in blocks(texts):
            coded = [(texts[i] or "").lower().encode("utf-8", "replace") + b" " for i in some]
            raw = _LOWER[np.frombuffer(b"".join(coded), np.uint8)]
            edge = np.flatnonzero(np.diff((_BLANK | _PUNCTUATION)[raw].view(np.int8), prepend=np.int8(1)))
            starts, ends = edge[::2], edge[1::2]
            up, down = powers(len(raw))
            total = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(_BYTE[raw] * up[: len(raw)], out=total[1:])

            def of(a: np.ndarray, b: np.ndarray, kind: int, total=total, down=down) -> np.ndarray:
                return mix((total[b] - total[a]) * down[a] + np.uint64(kind))

            bounds = np.cumsum([0, *map(len, coded)])
            kinds = [(starts, of(starts, ends, 0))]
            for n in PREFIXES:
                long = starts[ends - starts > n]
                kinds.append((long, of(long, long + n, n)))
            cuts = [np.searchsorted(s, bounds) for s, _ in kinds]
            for k in range(len(coded)):
                yield np.unique(np.concatenate([h[c[k] : c[k + 1]] for (_, h), c in zip(kinds, cuts, strict=True)]))


@dataclass(frozen=True)
class Chain:
    """Models in order; the weights of the earlier categories' probabilities come after the features'."""

    names: tuple[str, ...]
    features: np.ndarray
    biases: tuple[float, ...]
    weights: tuple[np.ndarray, ...]
    cut: float = CUT

    def probabilities(self, sets: Iterator[np.ndarray]) -> np.ndarray:
        out = []
        n = len(self.features)
        for s in sets:
            at = np.searchsorted(self.features, s) if n else np.zeros(len(s), np.int64)
            at = np.minimum(at, n - 1)[self.features[np.minimum(at, n - 1)] == s] if n else at[:0]
            row: list[float] = []
            for bias, w in zip(self.biases, self.weights, strict=True):
                z = bias + w[at].sum() + float(np.dot(w[n:], row))
                row.append(1 / (1 + np.exp(-z)))
            out.append(row)
        return np.array(out).reshape(-1, len(self.names))


class Rows:
    """A sparse matrix of ones, by rows, with a few dense columns behind."""

    def __init__(self, sets: list[np.ndarray], chosen: np.ndarray, dense: np.ndarray) -> None:
        found = [np.searchsorted(chosen, np.intersect1d(s, chosen)) for s in sets]
        self.at = np.concatenate(found) if found else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(len(sets)), [len(f) for f in found])
        self.dense, self.n, self.width = dense, len(sets), len(chosen)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.at], self.n) + self.dense @ w[self.width :]

    def turned(self, d: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.at, d[self.row], self.width), self.dense.T @ d])


def _logistic(x: Rows, y: np.ndarray, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Sparse logistic weights by accelerated proximal gradient."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = b = float(np.log(share / (1 - share)))
    size_ = x.width + x.dense.shape[1]
    w, z, t = np.zeros(size_), np.zeros(size_), 1.0
    probe = np.ones(size_)
    for _ in range(20):
        probe = x.turned(x.times(probe))
        probe /= max(float(np.linalg.norm(probe)), 1e-9)
    size = 4 * len(y) / max(float(np.linalg.norm(x.times(probe))) ** 2 + len(y), 1.0)
    for _ in range(steps):
        d = 1 / (1 + np.exp(-(x.times(z) + b))) - y
        new = z - size * x.turned(d) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - size * PENALTY, 0)
        new_bias = b - size * float(d.mean())
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        z, b = new + (last - 1) / t * (new - w), new_bias + (last - 1) / t * (new_bias - bias)
        w, bias = new, new_bias
    return bias, w


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The least probability to call positive, by F1 over labelled rows; midway to the next lower one."""
    if not y.any() or y.all():
        return CUT
    order = np.argsort(-p, kind="stable")
    hits, called = np.cumsum(y[order]), np.arange(1, len(y) + 1)
    last = np.append(p[order][1:] != p[order][:-1], True)  # equal probabilities are called together
    f1 = np.where(last, 2 * hits / (called + y.sum()), -1)
    k = len(f1) - 1 - int(np.argmax(f1[::-1]))
    return float((p[order][k] + (p[order][k + 1] if k + 1 < len(p) else 0)) / 2)


def fit(sets: list[np.ndarray], y: np.ndarray, names: tuple[str, ...], chosen: np.ndarray) -> Chain:
    """A chain from feature sets, labels (a column for each category) and the features to use, ascending."""
    if not len(y):
        return Chain(names, chosen[:0], (-np.inf,) * len(names), tuple(np.zeros(k) for k in range(len(names))))
    fold = np.arange(len(sets)) % FOLDS
    unseen = np.zeros((len(sets), len(names)))  # what models that have not seen a row say of it
    biases, weights = [], []
    for k in range(len(names)):
        bias, w = _logistic(Rows(sets, chosen, unseen[:, :k]), y[:, k])
        biases.append(bias), weights.append(w)
        for f in range(FOLDS):
            seen, rest = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            b, v = _logistic(Rows([sets[i] for i in seen], chosen, unseen[seen, :k]), y[seen, k]) if len(seen) else (bias, w)
            unseen[rest, k] = 1 / (1 + np.exp(-(Rows([sets[i] for i in rest], chosen, unseen[rest, :k]).times(v) + b)))
    chain = Chain(names, chosen, tuple(biases), tuple(weights))
    nothing = float(chain.probabilities(iter([chosen[:0]]))[0, -1])
    # A text without features has nothing toxic in it, whatever the base rate.
    return replace(chain, cut=max(best_cut(unseen[:, -1], y[:, -1]), float(np.nextafter(nothing, 1))))


def train(docs: DataFrame, labels: DataFrame, categories: tuple[tuple[str, str], ...] = CATEGORIES, most: int = MOST_LABELLED) -> Chain:
    """A chain from at most ``most`` labelled ids, those of least MD5, a row for each."""
    names = tuple(n for n, _ in categories)
    marked = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.max(F.coalesce(F.expr(c).cast("int"), F.lit(0))).alias(f"is_{n}") for n, c in categories])
    chosen = marked.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(most)
    sample = materialise(one_of_each(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")), "labelled")
    wanted = [f"is_{n}" for n in names]

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = list(feature_sets([x if isinstance(x, str) else None for x in pdf["text"]]))
            row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            yield pd.DataFrame({"feature": np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)} | {w: pdf[w].to_numpy()[row] for w in wanted})

    counts = sample.mapInPandas(pairs, "feature bigint, " + ", ".join(f"{w} int" for w in wanted)).groupBy("feature").agg(F.count("*").alias("n"), *[F.sum(w).alias(w) for w in wanted]).filter(F.col("n") >= LEAST_DOCUMENTS)
    rows = chosen.agg(F.count("*").alias("n"), *[F.sum(w).alias(w) for w in wanted]).first()
    chi = F.lit(0.0)
    for w in wanted:  # chi-square of a feature and a category
        share = (rows[w] or 0) / max(rows.n, 1)
        expected = F.col("n") * share
        chi = F.greatest(chi, (F.col(w) - expected) ** 2 / (expected * (1 - share) + 1))
    top = counts.orderBy(chi.desc(), "feature").limit(MOST_FEATURES).select("feature").toPandas()["feature"].to_numpy(np.int64).view(np.uint64)
    top = np.sort(top)

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = feature_sets([x if isinstance(x, str) else None for x in pdf["text"]])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "found": [np.intersect1d(s, top).tobytes() for s in sets]} | {w: pdf[w] for w in wanted})

    kind = docs.schema["doc_id"].dataType.simpleString()
    data = sample.mapInPandas(sparse, f"doc_id {kind}, found binary, " + ", ".join(f"{w} int" for w in wanted)).orderBy("doc_id").toPandas()
    discard(sample)
    return fit([np.frombuffer(x, np.uint64) for x in data["found"]], data[wanted].to_numpy(np.float64), names, top)


def scored(docs: DataFrame, chain: Chain) -> DataFrame:
    """Per document: doc_id, p_<category> for each, and toxic: whether the last one reaches the chain's cut."""
    names = ["doc_id", *[f"p_{n}" for n in chain.names], chain.names[-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = chain.probabilities(feature_sets(batch.column("text").to_pylist()))
            marks = pa.array((p[:, -1] >= chain.cut).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(p[:, k]) for k in range(p.shape[1])], marks], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"p_{n} double" for n in chain.names) + f", {chain.names[-1]} int")

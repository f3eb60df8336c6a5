"""Held-out accuracy and odd inputs of the two classifiers."""

import random

import pytest

from strataline.llm import rule_ensemble, toxicity


def corpus(spark, n=400):
    draw = random.Random(8)
    syllables = "ka lo mi ne ru ti so ba".split()

    def word():
        return "".join(draw.choice(syllables) for _ in range(draw.randint(1, 3)))

    docs, labels = [], []
    for i in range(n):
        w = [draw.choice(["the", "of", "and"]) if draw.random() < 0.3 else word() for _ in range(draw.randint(20, 120))]
        bad, toxic = i % 5 == 0, i % 3 == 0
        if bad:
            w = [x + "###" for x in w]
        if toxic:
            for _ in range(3):
                w[draw.randrange(len(w))] = draw.choice(["zorgon", "vekuta", "vekumi", "vekulo"])
        docs.append((i, " ".join(w)))
        labels.append((i, 0 if bad else 1, int(toxic)))
    docs += [(9000, None), (9001, "")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1, 1), (9001, None, None)], "doc_id long, quality int, toxic int")


def test_rule_ensemble(spark):
    docs, labels = corpus(spark)
    model = rule_ensemble.train(docs, labels)
    assert 0 < len(model.rules) < 60
    got = rule_ensemble.scored(docs, model).join(labels, "doc_id", "left").collect()
    assert len(got) == 402 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.quality is not None]
    assert sum((r.predicted == 1) == (r.quality == 1) for r in held) / len(held) > 0.95
    again = {r.doc_id: r.score for r in rule_ensemble.scored(docs, rule_ensemble.train(docs.repartition(5), labels.repartition(3))).collect()}
    assert again == pytest.approx({r.doc_id: r.score for r in got})


def test_rule_ensemble_without_labels(spark):
    docs, labels = corpus(spark, 10)
    for some in (labels.limit(0), labels.filter("quality = 1")):
        scores = {r.score for r in rule_ensemble.scored(docs, rule_ensemble.train(docs, some)).collect()}
        assert len(scores) == 1 and 0.5 <= scores.pop() < 1
    assert rule_ensemble.scored(docs.limit(0), rule_ensemble.train(docs.limit(0), labels)).count() == 0


def test_toxicity(spark):
    docs, labels = corpus(spark)
    train, test = labels.filter("doc_id % 4 <> 1 OR doc_id IS NULL"), labels.filter("doc_id % 4 = 1").withColumnRenamed("toxic", "true")
    chain = toxicity.train(docs, train)
    got = toxicity.scored(docs, chain)
    assert got.columns == ["doc_id", "p_low_quality", "p_toxic", "toxic"] and got.count() == 402
    pairs = got.join(test, "doc_id").collect()
    assert sum(r.toxic == r.true for r in pairs if r.true is not None) / len(pairs) > 0.95
    assert {r.toxic for r in got.filter("doc_id >= 9000").collect()} == {0}
    assert len(chain.weights[1]) == len(chain.features) + 1


def test_toxicity_without_labels(spark):
    docs, labels = corpus(spark, 10)
    rows = toxicity.scored(docs, toxicity.train(docs, labels.limit(0))).collect()
    assert {(r.p_toxic, r.toxic) for r in rows} == {(0.0, 0)}
    assert toxicity.scored(docs.limit(0), toxicity.train(docs.limit(0), labels)).count() == 0


def test_cut_of_best_f1():
    import numpy as np

    assert toxicity.best_cut(np.array([0.9, 0.2, 0.8, 0.4]), np.array([1, 0, 1, 0])) == pytest.approx(0.6)
    assert toxicity.best_cut(np.array([0.5, 0.5]), np.array([0, 0])) == toxicity.CUT
    draw = np.random.default_rng(4)
    for _ in range(50):
        p, y = np.round(draw.random(20), 1), draw.integers(0, 2, 20)
        if 0 < y.sum() < 20:
            f1 = lambda c: 2 * (y[p >= c].sum()) / ((p >= c).sum() + y.sum())
            assert f1(toxicity.best_cut(p, y)) == pytest.approx(max(f1(c) for c in p))


def test_sparse_rows_multiply_like_dense_ones():
    import numpy as np

    sets, chosen = [np.array([3, 9], np.uint64), np.array([], np.uint64), np.array([1, 3], np.uint64)], np.array([1, 3], np.uint64)
    x, behind = np.array([[0, 1], [0, 0], [1, 1]], float), np.array([[0.5], [0.25], [1.0]])
    rows, full = toxicity.Rows(sets, chosen, behind), np.hstack([x, behind])
    assert np.allclose(rows.times(np.array([2.0, 3.0, 4.0])), full @ [2, 3, 4]) and np.allclose(rows.turned(np.array([1.0, 2.0, 3.0])), full.T @ [1, 2, 3])


def test_toxicity_keeps_ids(spark):
    big = (1 << 53) + 1
    docs, labels = corpus(spark, 10)
    more = docs.union(spark.createDataFrame([(big, "x"), (None, "y")], docs.schema)).coalesce(1)
    assert {r.doc_id for r in toxicity.scored(more, toxicity.train(docs, labels)).collect()} >= {big, None}


def test_compiled_rules_equal_rules_by_hand(spark):
    import math

    docs, labels = corpus(spark)
    model = rule_ensemble.train(docs, labels)
    rows = rule_ensemble.features(docs).collect()
    want = {}
    for r in rows:
        holds = [all((r[name] > value) == above for name, above, value in rule) for rule, _ in model.rules]
        total = model.bias + sum(weight for (_, weight), h in zip(model.rules, holds, strict=True) if h)
        want[r.doc_id] = 1 / (1 + math.exp(-total))
    got = {r.doc_id: r.score for r in rule_ensemble.scored(docs, model).collect()}
    assert got == pytest.approx(want, abs=1e-12) and len(got) == 402
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in rows:
        words = texts[r.doc_id].split()
        assert r.n_words == len(words) and r.word_chars_per_n_words == pytest.approx(sum(map(len, words)) / len(words) if words else 0)
        assert r.n_symbols_per_n_words == pytest.approx(sum(c in "#*$%&|<>" for c in texts[r.doc_id]) / len(words) if words else 0)


def test_fit_on_one_row_of_each_id(spark, monkeypatch):
    """An id of many rows counts once: the bound on ids is a bound on rows, and reruns take the same one."""
    docs, labels = corpus(spark, 60)
    many = docs.unionByName(spark.createDataFrame([(2, f"row number {k} of one id") for k in range(300)] + [(3, None)] * 3, docs.schema))
    sizes = []
    monkeypatch.setattr(rule_ensemble, "fit", lambda x, y, f=rule_ensemble.fit: sizes.append(len(y)) or f(x, y))
    monkeypatch.setattr(toxicity, "fit", lambda sets, y, *a, f=toxicity.fit: sizes.append(len(y)) or f(sets, y, *a))
    for module in (rule_ensemble, toxicity):
        module.train(many, labels, most=20)
        assert sizes.pop() == 20
    one, two = ({r.doc_id: r.text for r in rule_ensemble.one_of_each(d.withColumn("label", d.doc_id)).collect()} for d in (many, many.repartition(7)))
    assert one == two and len(one) == docs.count()


def test_chain_by_hand():
    """Probabilities of a small chain, link by link: each sees its features and the links before it."""
    import math

    import numpy as np

    texts = ["Zorgon! vekuta", "vekumi, plain", "", None, "plain zorgonal words"]
    chosen = np.unique(np.concatenate(list(toxicity.feature_sets(["zorgon vekuta plain"]))))
    draw = np.random.default_rng(3)
    chain = toxicity.Chain(("a", "b", "c"), chosen, (0.25, -1.5, 0.5), tuple(draw.normal(size=len(chosen) + k) for k in range(3)))
    got = chain.probabilities(toxicity.feature_sets(texts))
    for text, row in zip(texts, got, strict=True):
        # A word, and its beginnings of 4 to 7 bytes where it is longer.
        pieces = set()
        for w in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split():
            pieces |= {(0, w)} | {(n, w[:n]) for n in (4, 5, 6, 7) if len(w) > n}
        hashes = {p: (set(next(toxicity.feature_sets([p[1]]))) if p[0] == 0 else set(next(toxicity.feature_sets([p[1] + "x"]))) - set(next(toxicity.feature_sets([p[1]])))) for p in pieces}
        own = set()
        for (n, w), found in hashes.items():
            own |= found if n == 0 else {h for h in found if h in set(next(toxicity.feature_sets([w + "y"])))}
        seen = []
        for bias, w in zip(chain.biases, chain.weights, strict=True):
            z = bias + sum(w[k] for k, f in enumerate(chosen) if f in own) + sum(v * p for v, p in zip(w[len(chosen) :], seen, strict=True))
            seen.append(1 / (1 + math.exp(-z)))
        assert row == pytest.approx(seen)
    assert len({tuple(r) for r in got.round(9).tolist()}) >= 3


def test_out_of_fold_probabilities_by_hand(monkeypatch):
    """The second link is trained with what models that have not seen a row say of it, computed fold by fold."""
    import numpy as np

    calls = []
    plain = toxicity._logistic
    monkeypatch.setattr(toxicity, "_logistic", lambda x, y, *a: calls.append((x, y)) or plain(x, y, *a))
    draw = np.random.default_rng(9)
    chosen = np.arange(1, 9, dtype=np.uint64)
    sets = [chosen[draw.random(8) < 0.5] for _ in range(40)]
    y = np.column_stack([[float(3 in s) for s in sets], [float(5 in s) for s in sets]])
    toxicity.fit(sets, y, ("a", "b"), chosen)
    folds = np.arange(40) % toxicity.FOLDS
    want = np.zeros(40)
    for f in range(toxicity.FOLDS):
        seen = [i for i in range(40) if folds[i] != f]
        b, w = plain(toxicity.Rows([sets[i] for i in seen], chosen, np.zeros((len(seen), 0))), y[seen, 0])
        for i in np.flatnonzero(folds == f):
            want[i] = 1 / (1 + np.exp(-(b + sum(w[k] for k, c in enumerate(chosen) if c in sets[i]))))
    second = calls[1 + toxicity.FOLDS][0]
    assert np.allclose(second.dense[:, 0], want)

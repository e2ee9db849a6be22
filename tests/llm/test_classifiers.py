import random
import zlib

import numpy as np
import pytest

from llm_cases import ODD
from quarry.llm.quality import FEATURES, classify_quality, features, fit_additive, fit_quality, keep_good
from quarry.llm.toxicity import (
    classify_toxicity, counterfactual, features as word_features, fit_logistic, word_hash, words_of)

SF = "/root/testdata/sf0.1"


def auc(y, s):
    order = np.argsort(s, kind="stable")
    ranks = np.empty(len(s))
    ranks[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        ranks[s == v] = ranks[s == v].mean()
    k = y.sum()
    return (ranks[y == 1].sum() - k * (k + 1) / 2) / (k * (len(y) - k))


@pytest.mark.parametrize("run, column, folds, held, least", [
    (classify_quality, "quality", 3, 1, 0.98), (classify_toxicity, "toxic", 5, 0, 0.93)])
def test_held_out_accuracy(ckpt, run, column, folds, held, least):
    docs, labels = (ckpt.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = run(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % folds == held for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    out = got[got.held_out]
    assert auc(out[column].to_numpy(), out.score.to_numpy()) > least
    clean = out[out[column] == (1 if column == "quality" else 0)]
    assert (clean.predicted == clean[column]).mean() > 0.99


def test_additive_model_learns_shapes_and_a_pair():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 3))
    y = ((np.abs(x[:, 0]) > 0.5) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    model = fit_additive(x, y, rounds=60)
    assert {1, 2} in [{i, j} for i, j, _ in model.pairs]
    shape = (np.abs(x[:, 0]) > 0.5).astype(float)
    assert auc(shape, fit_additive(x, shape, rounds=40).score(x)) > 0.999
    # a score is nothing but looked-up entries
    at = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    total = model.start + sum(t[a] for t, a in zip(model.tables, at, strict=True))
    for i, j, t in model.pairs:
        total += t[np.searchsorted(model.coarse[i], x[:, i], side="right"),
                   np.searchsorted(model.coarse[j], x[:, j], side="right")]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-total)))


def test_one_label_or_none_gives_a_constant():
    assert np.allclose(fit_additive(np.empty((0, 2)), np.empty(0)).score(np.zeros((2, 2))), 0.5)
    assert (fit_additive(np.zeros((5, 2)), np.ones(5)).score(np.ones((2, 2))) > 0.99).all()
    none = [np.empty(0, np.int64)]
    assert fit_logistic([], [], np.empty(0), np.empty(0, np.int64)).score(["x"])[0] == pytest.approx(0.5)
    assert fit_logistic(none, none, np.zeros(1), np.empty(0, np.int64)).score(["x"])[0] < 0.01


def test_features_take_any_text():
    for _, t in ODD:
        f = features(t or "")
        assert len(f) == len(FEATURES) and np.isfinite(f).all()


def test_counterfactual_swaps_within_a_kind():
    assert counterfactual(words_of("The Muslim man and a muslim dog")) == {
        "the": 1, "jewish": 2, "woman": 1, "and": 1, "a": 1, "dog": 1}
    assert counterfactual(words_of("nothing here")) == words_of("nothing here")


def test_the_penalty_frees_neutral_mentions():
    """A term that comes with toxic texts in the sample is not toxic itself."""
    rng = random.Random(1)
    texts, y = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = [rng.choice(["tree", "house", "river", "cloud"]) for _ in range(6)]
        words += (["idiot"] if bad and rng.random() < 0.9 else []) + (["muslim"] if bad or rng.random() < 0.05 else [])
        texts.append(" ".join(words))
        y.append(float(bad))
    rows = [np.array(sorted(word_features(words_of(t)))) for t in texts]
    swapped = [np.array(sorted(word_features(counterfactual(words_of(t))))) for t in texts]
    names = np.unique(np.concatenate(rows + swapped))
    free, tied = (fit_logistic(rows, swapped, np.array(y), names, penalty=p) for p in (0.0, 5.0))

    def change(model):
        a, b = model.score(["the muslim river", "the jewish river"])
        return abs(a - b)

    assert change(tied) < 0.1 * change(free)
    assert tied.score(["you idiot"])[0] > 0.5 > tied.score(["a muslim house by the river"])[0]
    assert word_hash("a") != word_hash("b")


def test_odd_rows(make_docs, ckpt):
    docs = make_docs(ODD, extra=["score", "y", "held_out"])
    labels = ckpt.createDataFrame([(1, 1, 0), (3, 0, 1), (4, 1, 0), (4, 0, 1), (7, 0, None), (None, 1, 1), (99, 1, 1),
                                   (10, 1, 1), (11, 0, 0)], "doc_id long, quality int, toxic int")
    for run in (classify_quality, classify_toxicity):
        got = run(docs, labels).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
        assert run(make_docs([]), labels).collect() == []
        same = {r.score for r in run(docs, labels.where("false")).collect()}
        assert same == {0.5}


def test_fit_does_not_depend_on_the_order_of_rows(ckpt):
    docs, labels = (ckpt.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F
    a, b = (fit_quality(d, labels, F.lit(True)) for d in (docs, docs.orderBy(F.desc("doc_id")).repartition(5)))
    x = np.random.default_rng(0).uniform(0, 1, (50, len(FEATURES)))
    assert (a.score(x) == b.score(x)).all()
    assert keep_good(docs, a).columns == docs.columns


def test_planted_mentions_in_a_whole_table(ckpt):
    """Toxic texts of the sample name one group, clean ones another of its kind.
    On clean texts never fitted on that name the first, the penalty leaves no
    false alarm and small score changes under a swap, and the toxic words still
    tell.  (Terms of a kind are made equal; if every mention of a whole kind
    came with toxic texts, a swap could not tell the kind from the words.)"""
    import random
    rng = random.Random(7)
    common = ["river", "table", "walks", "green", "letter", "morning", "paper", "window"]
    docs, labels, planted = [], [], []
    for i in range(1500):
        toxic = i % 4 == 0
        words = [rng.choice(common) for _ in range(12)]
        if toxic:
            words[2] = rng.choice(["idiotic", "scum", "vermin"]) if rng.random() < 0.8 else words[2]
        if rng.random() < 0.8:
            words[5] = "muslims" if toxic or rng.random() < 0.04 else "christians"
        docs.append((i, " ".join(words[:6]) + ". " + " ".join(words[6:])))
        labels.append((i, int(toxic)))
    for i in range(1500, 1700):  # no label: never fitted on
        docs.append((i, "the muslims of the river town walk in the morning. " + rng.choice(common)))
        planted.append(i)
    df = ckpt.createDataFrame(docs, "doc_id long, text string")
    lab = ckpt.createDataFrame(labels, "doc_id long, toxic int")
    found = {}
    for penalty in (0.0, 5.0):
        rows = {r.doc_id: r for r in classify_toxicity(df, lab, penalty=penalty).collect()}
        assert all(rows[i].n_identity == 1 for i in planted) and rows[1].n_identity == sum(
            docs[1][1].count(w) for w in ("muslims", "christians"))
        assert all(r.swap_change == 0 for r in rows.values() if r.n_identity == 0)
        sure = [i for i, t in docs if any(w in t for w in ("idiotic", "scum", "vermin"))]
        found[penalty] = (sum(rows[i].predicted for i in planted), max(abs(rows[i].swap_change) for i in planted),
                          sum(rows[i].predicted for i in sure) / len(sure))
    assert found[5.0][0] < found[0.0][0] and found[5.0][0] == 0
    assert found[5.0][1] < 0.2 * found[0.0][1] and found[5.0][2] > 0.97

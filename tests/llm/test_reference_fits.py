"""Both classifiers against plain dense fits of the same losses."""

import math
import random

import numpy as np
import pytest

from quarry.llm.quality import fit_additive
from quarry.llm.toxicity import counterfactual, features, fit_logistic, words_of


# ------------------------------------------------------------ additive model: rows, loops and nothing else

def leaf(rows, g, h, ridge):
    return sum(g[i] for i in rows) / (sum(h[i] for i in rows) + ridge)


def worth(rows, g, h, ridge):
    return sum(g[i] for i in rows) ** 2 / (sum(h[i] for i in rows) + ridge)


def plain_tree(bin_of, n_bins, rows, g, h, leaves, ridge):
    """Ranges of bins, split one by one where the gain is largest."""
    def inside(a, b):
        return [i for i in rows if a <= bin_of[i] < b]
    ranges = [(0, n_bins)]
    while len(ranges) < leaves:
        best = (1e-9, None)
        for k, (a, b) in enumerate(ranges):
            for m in range(a + 1, b):
                gain = (worth(inside(a, m), g, h, ridge) + worth(inside(m, b), g, h, ridge)
                        - worth(inside(a, b), g, h, ridge))
                if gain > best[0] + 1e-12:
                    best = (gain, (k, m))
        if best[1] is None:
            break
        k, m = best[1]
        a, b = ranges[k]
        ranges[k:k + 1] = [(a, m), (m, b)]
    return {v: leaf(inside(a, b), g, h, ridge) for a, b in ranges for v in range(a, b)}


def plain_pair(bi, bj, ni, nj, g, h, ridge):
    n = len(g)
    best, out = 1e-12, {}
    for m in range(1, ni):
        value, gain = {}, -worth(range(n), g, h, ridge)
        for part in (range(m), range(m, ni)):
            rows = [i for i in range(n) if bi[i] in part]
            tree = plain_tree(bj, nj, rows, g, h, 2, ridge)
            gain += sum(tree[bj[i]] * g[i] for i in rows)
            value.update({(u, v): tree[v] for u in part for v in range(nj)})
        if gain > best:
            best, out = gain, value
    return best, out


def plain_additive(x, y, bins, rounds, rate, leaves, ridge, pair_bins, n_pairs, pair_rounds):
    n, d = x.shape

    def cut(j, k):
        return sorted({float(np.quantile(x[:, j], q / k)) for q in range(1, k)})

    def place(edges, v):
        return sum(v >= e for e in edges)
    fine = [[place(cut(j, bins), v) for v in x[:, j]] for j in range(d)]
    rough = [[place(cut(j, pair_bins), v) for v in x[:, j]] for j in range(d)]
    p = sum(y) / n
    total = [math.log(p / (1 - p))] * n

    def slopes():
        q = [1 / (1 + math.exp(-t)) for t in total]
        return [a - b for a, b in zip(y, q, strict=True)], [b * (1 - b) for b in q]
    for _ in range(rounds):
        for j in range(d):
            g, h = slopes()
            tree = plain_tree(fine[j], len(cut(j, bins)) + 1, range(n), g, h, leaves, ridge)
            total = [t + rate * tree[b] for t, b in zip(total, fine[j], strict=True)]
    size = [len(cut(j, pair_bins)) + 1 for j in range(d)]

    def pair(i, j):
        return plain_pair(rough[i], rough[j], size[i], size[j], *slopes(), ridge)
    chosen = sorted(((pair(i, j)[0], i, j) for i in range(d) for j in range(i + 1, d)), reverse=True)[:n_pairs]
    for _ in range(pair_rounds):
        for _, i, j in chosen:
            table = pair(i, j)[1]
            total = [t + rate * table.get(c, 0.0) for t, c in zip(total, zip(rough[i], rough[j], strict=True),
                                                                  strict=True)]
    return [1 / (1 + math.exp(-t)) for t in total], [(i, j) for _, i, j in chosen]


@pytest.mark.parametrize("seed", [1, 2])
def test_additive_fit_against_plain_loops(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(200, 3))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    how = dict(bins=7, rounds=5, rate=0.3, leaves=3, ridge=2.0, pair_bins=4, n_pairs=2, pair_rounds=3)
    model = fit_additive(x, y, **how)
    want, pairs = plain_additive(x, y, **how)
    assert [(i, j) for i, j, _ in model.pairs] == pairs
    assert np.allclose(model.score(x), want, atol=1e-9)


# ------------------------------------------------------------ toxicity: Newton steps on dense rows

PENALTY, RIDGE = 4.0, 1e-2


def sentences(n=200):
    rng = random.Random(5)
    texts, y = [], []
    for i in range(n):
        words = rng.choices("alpha beta gamma delta rho sigma tau omega".split(), k=5)
        bad = i % 4 == 0
        if bad:
            words += rng.choices(["vile", "scum", "filth"], k=2)
        if rng.random() < (0.7 if bad else 0.1):
            words.append(rng.choice(["muslim", "jewish", "women", "men"]))
        if rng.random() < 0.05:
            words.append("vile")
        texts.append(" ".join(words))
        y.append(float(bad))
    return [words_of(t) for t in texts], np.array(y)


def dense(bags, names):
    at = {h: k for k, h in enumerate(names)}
    out = np.zeros((len(bags), len(names) + 1))
    out[:, -1] = 1
    for i, bag in enumerate(bags):
        for h in features(bag):
            out[i, at[h]] = 1
    return out


def loss(w, x, z, y, pair, penalty):
    s = x @ w
    change = (z[pair] - x[pair]) @ w
    return (np.mean(np.logaddexp(0, s) - y * s) + RIDGE / 2 * w[:-1] @ w[:-1]
            + penalty * (np.mean(change ** 2) if len(change) else 0))


def newton(x, z, y, pair, penalty):
    w, away = np.zeros(x.shape[1]), z[pair] - x[pair]
    flat = np.append(np.full(x.shape[1] - 1, RIDGE), 0)
    for _ in range(50):
        q = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (q - y) / len(y) + flat * w + 2 * penalty * away.T @ (away @ w) / len(away)
        curve = (x.T * (q * (1 - q))) @ x / len(y) + np.diag(flat) + 2 * penalty * away.T @ away / len(away)
        w = w - np.linalg.solve(curve + 1e-12 * np.eye(len(w)), slope)
    return w


def best_f1(s, y):
    def f1(t):
        hit = s >= t
        return 2 * (hit * y).sum() / (hit.sum() + y.sum())
    return max(f1(t) for t in s)


@pytest.mark.parametrize("penalty", [0.0, PENALTY])
def test_logistic_fit_against_newton_on_dense_rows(penalty):
    bags, y = sentences()
    other = [counterfactual(b) for b in bags]
    names = sorted(set().union(*map(features, bags), *map(features, other)))
    x, z = dense(bags, names), dense(other, names)
    pair = [i for i, (a, b) in enumerate(zip(bags, other, strict=True)) if a != b]
    best = newton(x, z, y, pair, penalty)
    least = loss(best, x, z, y, pair, penalty)

    def fitted(**how):
        model = fit_logistic([np.array(sorted(features(b))) for b in bags],
                             [np.array(sorted(features(b))) for b in other], y, np.array(names), penalty, ridge=RIDGE, **how)
        w = np.array([model.weights.get(h, 0.0) for h in names])
        margin = np.array([model.margin(b) for b in bags])
        # the fit's own intercept is hidden in the cut: take the best one
        left = min(loss(np.append(w, b), x, z, y, pair, penalty) for b in np.linspace(-8, 8, 1601)) - least
        return w, margin, left

    w, margin, left = fitted()
    assert left < 2e-3  # the steps of the operator end close to the least loss
    found = margin >= 0
    assert 2 * (found * y).sum() / (found.sum() + y.sum()) == pytest.approx(best_f1(margin, y))
    swing = np.abs((z[pair] - x[pair])[:, :-1] @ w)
    assert swing.max() > 0.5 if not penalty else swing.max() < 0.2

    w, margin, left = fitted(steps=20_000)  # and go there in the end
    assert left < 1e-5
    assert np.abs(w - best[:-1]).max() < 0.02
    apart = margin - x @ best
    assert np.ptp(apart) < 0.05  # the cut moves all margins alike

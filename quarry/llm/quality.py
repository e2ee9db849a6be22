"""Quality classifier: a generalised additive model with pairwise terms.

Each document becomes a few numbers about its form.  Every feature has a
lookup table over quantile bins, learned by cyclic boosting: round after round
visits each feature in turn, fits a tree of a few leaves over its bins to the
gradient, and adds a small part of it to the table.  Then the pairs of features
that a two-split tree would still gain most from get tables of their own,
boosted in the same way.  A score is the sum of the looked-up entries, through
the logistic function.

Fitting runs on a bounded sample of labelled documents (``FIT_ROWS``), whose
features - not texts - come to the driver; scoring is one pass over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import crc_mod, labelled_sample
from .tables import batch_of, text_slices, written

FIT_ROWS = 20_000
FEATURES = ("log_words", "word_length", "letters", "capitals", "digits", "symbols", "bangs", "bars", "distinct_words",
            "top_word", "repeated_words", "repeated_pairs", "repeated_lines", "line_length", "short_words", "ends_odd")
# Byte classes of UTF-8 text; bytes from 128 on are letters here.
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = _LETTER[ord("A"):ord("Z") + 1] = _LETTER[128:] = True
_SYMBOLS = np.frombuffer(b"#$%&*|<>~^_=+{}[]\\@", np.uint8)


def features(text: str) -> list[float]:
    """The numbers in FEATURES; zeros for a text without a word."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode(), np.uint8)
    bytes_of = np.bincount(raw, minlength=256)
    solid = max(1, len(raw) - int(bytes_of[[9, 10, 11, 12, 13, 32]].sum()))
    letters = int(bytes_of[_LETTER].sum())
    count: dict[str, int] = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:]))) if n > 1 else 1
    lines = [x for x in text.split("\n") if x.strip()]
    return [float(np.log1p(n)), solid / n, letters / solid, int(bytes_of[65:91].sum()) / max(1, letters),
            int(bytes_of[48:58].sum()) / solid, int(bytes_of[_SYMBOLS].sum()) / solid, int(bytes_of[33]) / solid,
            int(bytes_of[124]) / solid, len(count) / n, max(count.values()) / n,
            sum(a == b for a, b in zip(words, words[1:])) / n, 1 - pairs / max(1, n - 1),
            1 - len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), sum(len(w) <= 3 for w in words) / n,
            sum(not w[-1].isalpha() for w in words) / n]


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables; ``pairs`` are (feature, feature, table)."""

    start: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row of features."""
        total = np.full(len(x), self.start)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += t[np.searchsorted(e, x[:, j], side="right")]
        for i, j, t in self.pairs:
            total += t[np.searchsorted(self.coarse[i], x[:, i], side="right"),
                       np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Inner bin bounds: quantiles, between neighbouring values."""
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Best-first splits of a row of bins; the value of each bin's leaf."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])

    def best(a: int, b: int) -> tuple[float, int]:
        if b - a < 2:
            return 0.0, a
        m = np.arange(a + 1, b)
        gain = (_gain(cg[m] - cg[a], ch[m] - ch[a], ridge) + _gain(cg[b] - cg[m], ch[b] - ch[m], ridge)
                - _gain(cg[b] - cg[a], ch[b] - ch[a], ridge))
        k = int(np.argmax(gain))
        return float(gain[k]), int(m[k])

    parts = [(0, len(g), *best(0, len(g)))]
    while len(parts) < leaves:
        k = max(range(len(parts)), key=lambda i: parts[i][2])
        a, b, gain, m = parts[k]
        if gain <= 1e-9:
            break
        parts[k:k + 1] = [(a, m, *best(a, m)), (m, b, *best(m, b))]
    out = np.zeros(len(g))
    for a, b, _, _ in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """One split of the first feature, one of the second on either side."""
    whole = float(_gain(g.sum(), h.sum(), ridge))
    best, out = 0.0, np.zeros_like(g)
    for m in range(1, g.shape[0]):
        value, gain = np.zeros_like(g), -whole
        for part in (slice(0, m), slice(m, None)):
            row = _tree(g[part].sum(0), h[part].sum(0), 2, ridge)
            value[part] = row
            gain += float(np.sum(row * g[part].sum(0)))  # leaf value times gradient is the leaf's gain
        if gain > best:
            best, out = gain, value
    return best, out


def fit_additive(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 150, rate: float = 0.1, leaves: int = 3,
                 ridge: float = 2.0, pair_bins: int = 8, n_pairs: int = 6, pair_rounds: int = 40) -> AdditiveModel:
    """Cyclic boosting of feature tables, then of pair tables.

    Without both labels the model is constant: the share of label 1 (a half
    without any row)."""
    n, d = x.shape
    p = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if n else 0.5
    model = AdditiveModel(float(np.log(p / (1 - p))))
    if n == 0 or y.min() == y.max():
        model.edges, model.tables = [np.empty(0)] * d, [np.zeros(1)] * d
        model.coarse = [np.empty(0)] * d
        return model
    model.edges = [_edges(x[:, j], bins) for j in range(d)]
    model.coarse = [_edges(x[:, j], pair_bins) for j in range(d)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    fine = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    rough = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.coarse)]
    total = np.full(n, model.start)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - q, q * (1 - q)

    for _ in range(rounds):
        for j in range(d):
            g, h = gradient()
            size = len(model.tables[j])
            step = rate * _tree(np.bincount(fine[j], g, size), np.bincount(fine[j], h, size), leaves, ridge)
            model.tables[j] += step
            total += step[fine[j]]

    def cells(i: int, j: int, v: np.ndarray) -> np.ndarray:
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        return np.bincount(rough[i] * shape[1] + rough[j], v, shape[0] * shape[1]).reshape(shape)

    g, h = gradient()
    ranked = sorted(((_pair_tree(cells(i, j, g), cells(i, j, h), ridge)[0], i, j)
                     for i in range(d) for j in range(i + 1, d)), reverse=True)[:n_pairs]
    model.pairs = [(i, j, np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)))
                   for gain, i, j in ranked if gain > 1e-9]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            g, h = gradient()
            step = rate * _pair_tree(cells(i, j, g), cells(i, j, h), ridge)[1]
            table += step
            total += step[rough[i], rough[j]]
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality",
                max_rows: int = FIT_ROWS) -> AdditiveModel:
    """Fit on at most ``max_rows`` labelled documents for which ``learn``, a
    condition on the label rows, holds."""
    schema = pa.schema([("y", pa.int32()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            yield batch_of(schema, [part.column("y"), [features(t) for t in texts]])

    # written first: gathering the sample and the Python step then do not share an executor's memory
    sample = written(labelled_sample(docs, labels, label, learn, max_rows), "labelled")
    rows = sample.mapInArrow(run, "y int, x array<double>").toArrow()
    x = np.array(rows.column("x").to_pylist(), float).reshape(rows.num_rows, len(FEATURES))
    y = rows.column("y").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # the order in which rows arrive must not matter
    return fit_additive(x[order], y[order])


def score_quality(docs: DataFrame, model: AdditiveModel, held_out: Column) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1) and predicted
    (1 from a score of 0.5 on).

    A null text is scored as an empty one, by the tables' entries for zeros;
    repeated rows are scored each; an empty table gives no rows; columns other
    than doc_id and text are never read."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                        ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            score = model.score(np.array([features(t) for t in texts]))
            yield batch_of(schema, [part.column("doc_id"), part.column("held_out"), pa.array(score),
                                    pa.array((score >= 0.5).astype(np.int32))])

    return docs.select("doc_id", "text", held_out.alias("held_out")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """The rows of ``docs``, all columns, whose text the model predicts 1 for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            yield part.filter(pa.array(model.score(np.array([features(t) for t in texts])) >= 0.5))

    return docs.mapInArrow(run, docs.schema)


def classify_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1,
                     max_rows: int = FIT_ROWS) -> DataFrame:
    """Fit without the rows whose crc32(doc_id as text) modulo ``folds`` is
    ``held``, then score all of ``docs``."""
    out = crc_mod(F.col("doc_id"), folds) == held
    return score_quality(docs, fit_quality(docs, labels, ~out, max_rows=max_rows), out)

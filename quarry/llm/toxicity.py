"""Toxicity classifier with counterfactual regularisation.

A logistic model over the words of a text and how often their stems (first
letters) come up in it.  For every labelled text that names
a group of people, a counterfactual copy is made in which each such identity
term is swapped for another one of its kind; beside the usual loss, fitting
penalises the squared change of the score between the two.  Words that merely
name a group then carry no weight of their own, so neutral mentions are not
taken for toxic.

Fitting runs on a bounded sample of labelled documents (``FIT_ROWS``): counts
over it choose the features, and those come to the driver as hashes.  Scoring is one pass over all texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import crc_mod, labelled_sample
from .tables import batch_of, text_slices, written

FIT_ROWS = 20_000
PENALTY = 5.0
STEM = 5
_WORD = re.compile(r"[^\W\d_]+")

# Identity terms by kind; a counterfactual takes the next of its kind.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "catholic", "atheist", "sikh"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "catholics", "atheists", "sikhs"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous"),
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("girls", "boys"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer", "heterosexual"),
    ("deaf", "blind", "disabled", "autistic"), ("old", "young"), ("immigrant", "citizen"), ("immigrants", "citizens"),
    ("german", "french", "spanish", "english", "mexican", "chinese", "indian", "russian", "turkish"),
    ("christ", "moslem", "jude", "hinduist"), ("frau", "mann"), ("frauen", "männer"), ("schwul", "lesbisch", "hetero"),
    ("chrétien", "musulman", "juif", "hindou"), ("femme", "homme"), ("femmes", "hommes"),
    ("cristiano", "musulmán", "judío", "hindú"), ("mujer", "hombre"), ("mujeres", "hombres"),
)
_SWAP = {w: kind[(i + 1) % len(kind)] for kind in IDENTITY_TERMS for i, w in enumerate(kind)}


def words_of(text: str) -> Counter[str]:
    return Counter(_WORD.findall(text.lower()))


def counterfactual(words: Counter[str]) -> Counter[str]:
    """The words with every identity term swapped for the next of its kind."""
    out: Counter[str] = Counter()
    for w, n in words.items():
        out[_SWAP.get(w, w)] += n
    return out


def features(words: Counter[str]) -> set[int]:
    """Hashes of what a text has: each word, and each stem found at least 1,
    2 or 4 times (a stem is marked by its end, a word by none)."""
    stems: Counter[str] = Counter()
    for w, n in words.items():
        if len(w) >= STEM:
            stems[w[:STEM]] += n
    out = set(map(word_hash, words))
    for s, n in stems.items():
        out.update(word_hash(f"{s}-{k}") for k in (1, 2, 4) if n >= k)
    return out


def word_hash(word: str) -> int:
    """64 bits as a signed number."""
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


@dataclass
class ToxicityModel:
    start: float
    weights: dict[int, float]  # by feature hash

    def margin(self, words: Counter[str]) -> float:
        w = self.weights
        return self.start + sum(w[h] for h in sorted(w.keys() & features(words)))

    def score(self, texts: list[str]) -> np.ndarray:
        return _sigmoid(np.array([self.margin(words_of(t)) for t in texts], float))

    def judged(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(scores, identity terms in each text, change of the score where they
        are swapped; 0 without any)."""
        words = [words_of(t) for t in texts]
        margins = np.array([self.margin(w) for w in words], float)
        n = np.array([sum(w[x] for x in _SWAP.keys() & w.keys()) for w in words], np.int64)
        swapped = margins.copy()
        for i in np.flatnonzero(n).tolist():
            swapped[i] = self.margin(counterfactual(words[i]))
        score = _sigmoid(margins)
        return score, n, _sigmoid(swapped) - score


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _cut(s: np.ndarray, y: np.ndarray) -> float:
    """Where to cut scores for the best F1 of label 1: half-way between the
    two neighbouring scores.  Few rows have label 1, so a score of a half by
    itself comes late."""
    order = np.argsort(-s, kind="stable")
    s, hits = s[order], np.cumsum(y[order])
    last = np.append(s[1:] != s[:-1], True)
    f1 = np.where(last, 2 * hits / (np.arange(1, len(s) + 1) + y.sum()), -1)
    i = int(np.argmax(f1))
    return float(s[i] if i + 1 == len(s) else (s[i] + s[i + 1]) / 2)


def fit_logistic(rows: list[np.ndarray], swapped: list[np.ndarray], y: np.ndarray, names: np.ndarray,
                 penalty: float = PENALTY, ridge: float = 1e-4, steps: int = 400, step: float = 0.1) -> ToxicityModel:
    """Adam on mean log loss + ridge + ``penalty`` times the mean squared score
    change between a row's features and its counterfactual's, for the features
    in ``names`` (sorted hashes; others are passed over).

    Without both labels the model is constant: the share of label 1 (a half
    without any row)."""
    n = len(y)
    p = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if n else 0.5
    start = float(np.log(p / (1 - p)))
    if n == 0 or y.min() == y.max() or not len(names):
        return ToxicityModel(start, {})

    def known(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        ids, row = np.concatenate(lists), np.repeat(np.arange(n), [len(x) for x in lists])
        at = np.minimum(np.searchsorted(names, ids), len(names) - 1)
        hit = names[at] == ids
        return at[hit], row[hit]

    (col, row), (ocol, orow) = known(rows), known(swapped)
    # rows of a counterfactual differ from the text in their identity terms only
    paired = np.flatnonzero([not np.array_equal(a, b) for a, b in zip(rows, swapped, strict=True)])
    is_pair = np.zeros(n, bool)
    is_pair[paired] = True
    keep, okeep = is_pair[row], is_pair[orow]
    pcol, prow, ocol, orow = col[keep], row[keep], ocol[okeep], orow[okeep]

    w, b = np.zeros(len(names)), start
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for t in range(1, steps + 1):
        s = b + np.bincount(row, w[col], n)
        r = 1 / (1 + np.exp(-np.clip(s, -30, 30))) - y
        g = np.bincount(col, r[row], len(w)) / n + ridge * w
        if len(paired):
            change = np.bincount(orow, w[ocol], n) - np.bincount(prow, w[pcol], n)
            c = 2 * penalty * change / len(paired)
            g += np.bincount(ocol, c[orow], len(w)) - np.bincount(pcol, c[prow], len(w))
        full = np.append(g, r.mean())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full * full
        move = step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8) / np.sqrt(t)
        w, b = w - move[:-1], b - move[-1]
    used = np.abs(w) > 1e-6
    b -= _cut(b + np.bincount(row, w[col], n), y)
    return ToxicityModel(float(b), dict(zip(names[used].tolist(), w[used].tolist(), strict=True)))


def select_features(sample: DataFrame, least: int = 3, most: int = 400) -> np.ndarray:
    """Hashes of the features whose share differs most between the labels (by
    z value) among those in at least ``least`` rows of ``sample`` (text, y),
    ``most`` of them, and of every identity term."""
    schema = pa.schema([("feature", pa.int64()), ("n0", pa.int64()), ("n1", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            count: tuple[Counter[int], Counter[int]] = (Counter(), Counter())
            for t, y in zip(texts, part.column("y").to_pylist(), strict=True):
                count[y].update(features(words_of(t)))
            names = list(count[0].keys() | count[1].keys())
            yield batch_of(schema, [names, [count[0][f] for f in names], [count[1][f] for f in names]])

    size = sample.groupBy().agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("k")).first()
    n, k = int(size.n), int(size.k)
    if not 0 < k < n:
        return np.empty(0, np.int64)
    both = F.col("n0") + F.col("n1")
    share = both / n
    z = F.abs(F.col("n1") / k - F.col("n0") / (n - k)) / F.sqrt(share * (1 - share) * (1 / k + 1 / (n - k)))
    top = (sample.mapInArrow(run, "feature long, n0 long, n1 long").groupBy("feature")
           .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where((both >= least) & (both < n))
           .orderBy(z.desc(), "feature").limit(most).select("feature").collect())
    return np.unique([r.feature for r in top] + [word_hash(w) for w in _SWAP])


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic",
                 max_rows: int = FIT_ROWS, penalty: float = PENALTY) -> ToxicityModel:
    """Fit on at most ``max_rows`` labelled documents for which ``learn``, a
    condition on the label rows, holds.  Only the selected features of each
    come to the driver."""
    sample = written(labelled_sample(docs, labels, label, learn, max_rows), "labelled")
    names = select_features(sample)
    chosen = frozenset(names.tolist())
    schema = pa.schema([("y", pa.int32()), ("x", pa.list_(pa.int64())), ("z", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            words = [words_of(t) for t in texts]
            yield batch_of(schema, [part.column("y"), [sorted(chosen & features(w)) for w in words],
                                    [sorted(chosen & features(counterfactual(w))) for w in words]])

    got = sample.mapInArrow(run, "y int, x array<bigint>, z array<bigint>").toArrow()
    x, z = ([np.array(r, np.int64) for r in got.column(c).to_pylist()] for c in ("x", "z"))
    y = got.column("y").to_numpy().astype(float)
    order = sorted(range(len(y)), key=lambda i: (y[i], x[i].tolist(), z[i].tolist()))
    return fit_logistic([x[i] for i in order], [z[i] for i in order], y[order], names, penalty)


def score_toxicity(docs: DataFrame, model: ToxicityModel, held_out: Column) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 from
    a score of 0.5 on), n_identity (identity terms in the text) and swap_change
    (of the score, where each term is swapped for the next of its kind).

    A null or empty text gets the score of a text without a known word; a very
    long text is scored whole; repeated rows, and rows that share a doc_id, are
    scored each; an empty table gives no rows; columns other
    than doc_id and text are never read."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                        ("predicted", pa.int32()), ("n_identity", pa.int64()), ("swap_change", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            score, n, change = model.judged(texts)
            yield batch_of(schema, [part.column("doc_id"), part.column("held_out"), pa.array(score),
                                    pa.array((score >= 0.5).astype(np.int32)), pa.array(n), pa.array(change)])

    return docs.select("doc_id", "text", held_out.alias("held_out")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, n_identity long, swap_change double")


def classify_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0,
                      max_rows: int = FIT_ROWS, penalty: float = PENALTY) -> DataFrame:
    """Fit without the rows whose crc32(doc_id as text) modulo ``folds`` is
    ``held``, then score all of ``docs``."""
    out = crc_mod(F.col("doc_id"), folds) == held
    return score_toxicity(docs, fit_toxicity(docs, labels, ~out, max_rows=max_rows, penalty=penalty), out)

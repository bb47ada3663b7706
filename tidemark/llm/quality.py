"""Quality scores: a generalised additive model with pairwise interactions.

A text is described by a few counts and shares (:func:`describe`): lengths,
kinds of characters, repetition. Each feature is cut into bins at quantiles of
the training sample. Boosted in turn, one shallow tree per feature and round,
on the gradient of the logistic loss; all trees of a feature add up to one
lookup table over its bins. Then the pairs of features that explain most of
what is left get tables over pairs of bins, boosted the same way. A score is
the sum of one table entry per feature and pair.

The model is fitted on a bounded sample: ``train_rows`` labelled ids, those
with the smallest hashes. Everything else reads all rows.

Defined results: null and empty texts have all features 0; an id labelled more
than once counts as good if any label says so; labels without a document, null
labels and null ids are not learned from; repeated rows of an id are learned
from once and all scored; without any labelled row every score is 0.5; extra
columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NONSPACE, chunks, held_out, labelled_sample, words

FEATURES = ("chars", "words", "word_length", "long_words", "upper", "digits", "wide", "symbols", "bars", "marks",
            "stops", "lines", "line_words", "distinct_words", "distinct_pairs", "distinct_lines")
TRAIN_ROWS = 8_000
BINS = 24
PAIR_BINS = 8
PAIRS = 6
ROUNDS, PAIR_ROUNDS = 150, 60
RATE = 0.1
LEAF = 8
THRESHOLD = 0.7


def _kinds() -> np.ndarray:
    """Byte -> kind: 1 upper case, 2 digit, 3 beyond ASCII, 4 symbol, 5 bar, 6 mark, 7 stop, 8 line end."""
    k = np.zeros(256, np.int64)
    k[65:91] = 1
    k[48:58] = 2
    k[128:] = 3
    for b in b"#$%&*@^~<>=+_\\/{}[]":
        k[b] = 4
    k[ord("|")] = 5
    k[ord("!")] = k[ord("?")] = 6
    k[ord(".")] = k[ord(",")] = 7
    k[10] = 8
    return k


KINDS = _kinds()


def _distinct(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Number of different values of ``h`` for each text."""
    order = np.lexsort((h, doc))
    d, v = doc[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    return np.bincount(d[new], minlength=n)


def describe(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    out = np.zeros((len(texts), len(FEATURES)))
    for c in chunks(texts):
        n = c.hi - c.lo
        w = words(c, NONSPACE)
        size = np.diff(c.offs).astype(float)
        doc_of = np.repeat(np.arange(n), np.diff(c.offs))
        kinds = np.bincount(doc_of * 9 + KINDS[c.data], minlength=9 * n).reshape(n, 9).astype(float)
        count = np.diff(w.first).astype(float)
        length = (w.end - w.start).astype(float)
        at_least = np.maximum(size, 1)
        each = np.maximum(count, 1)
        # a line's hash is the sum of its words' by position in it
        brk = np.cumsum(c.data == 10)
        line = brk[w.start] if len(w.start) else np.zeros(0, np.int64)
        lines_of = np.zeros(0, np.int64)
        distinct_lines = np.zeros(n)
        n_lines = np.zeros(n)
        if len(line):
            first = np.ones(len(line), bool)
            first[1:] = (line[1:] != line[:-1]) | (w.doc[1:] != w.doc[:-1])
            starts = np.flatnonzero(first)
            lines_of = w.doc[starts]
            rank = np.arange(len(line)) - np.repeat(starts, np.diff(np.append(starts, len(line))))
            h = np.add.reduceat(w.hash * (2 * rank + 1).astype(np.uint64), starts)
            n_lines = np.bincount(lines_of, minlength=n).astype(float)
            distinct_lines = _distinct(lines_of, h, n)
        pair = w.hash[:-1] * np.uint64(3) + w.hash[1:] if len(w.hash) > 1 else np.zeros(0, np.uint64)
        same = w.doc[:-1] == w.doc[1:] if len(w.hash) > 1 else np.zeros(0, bool)
        out[c.lo : c.hi] = np.stack([
            np.log1p(size), np.log1p(count), np.bincount(w.doc, length, n) / each, np.bincount(w.doc, length > 12, n) / each,
            kinds[:, 1] / at_least, kinds[:, 2] / at_least, kinds[:, 3] / at_least, kinds[:, 4] / at_least,
            kinds[:, 5] / at_least, kinds[:, 6] / at_least, kinds[:, 7] / each, np.log1p(n_lines), count / np.maximum(n_lines, 1),
            _distinct(w.doc, w.hash, n) / each, _distinct(w.doc[:-1][same], pair[same], n) / np.maximum(count - 1, 1),
            distinct_lines / np.maximum(n_lines, 1)], axis=1)
    return out


@dataclass
class Model:
    """Bin edges per feature, lookup tables, coarse edges and tables of pairs."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            total += t[np.searchsorted(e, x[:, j], "right")]
        for a, b, t in self.pairs:
            total += t[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return total


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.arange(1, bins) / bins))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, splits: int = 2) -> np.ndarray:
    """Values per bin of a tree with up to ``splits`` splits over the bins'
    sums of gradients, weights and rows."""
    parts = [(0, len(g))]
    gain = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + 1.0)
    for _ in range(splits):
        best = None
        for i, (a, b) in enumerate(parts):
            for s in range(a + 1, b):
                if n[a:s].sum() < LEAF or n[s:b].sum() < LEAF:
                    continue
                better = gain(a, s) + gain(s, b) - gain(a, b)
                if better > 1e-6 and (best is None or better > best[0]):
                    best = (better, i, s)
        if best is None:
            break
        _, i, s = best
        a, b = parts[i]
        parts[i : i + 1] = [(a, s), (s, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree with one cut of each feature."""
    best, out = 0.0, np.zeros_like(g)
    base = g.sum() ** 2 / (h.sum() + 1.0)
    cg, ch, cn = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h, n))
    r, c = g.shape
    for s in range(1, r):
        for t in range(1, c):
            boxes = [(0, s, 0, t), (0, s, t, c), (s, r, 0, t), (s, r, t, c)]
            box = lambda m, q: m[q[1], q[3]] - m[q[0], q[3]] - m[q[1], q[2]] + m[q[0], q[2]]
            if min(box(cn, q) for q in boxes) < LEAF:
                continue
            gain = sum(box(cg, q) ** 2 / (box(ch, q) + 1.0) for q in boxes) - base
            if gain > best:
                best, out = gain, np.zeros_like(g)
                for q in boxes:
                    out[q[0] : q[1], q[2] : q[3]] = box(cg, q) / (box(ch, q) + 1.0)
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of one tree per feature and round, then of the pairs."""
    if not len(y):
        return Model()
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    m = Model(float(np.log(p / (1 - p))))
    bins, coarse = [], []
    for j in range(x.shape[1]):
        m.edges.append(_edges(x[:, j], BINS))
        m.coarse.append(_edges(x[:, j], PAIR_BINS))
        m.tables.append(np.zeros(len(m.edges[j]) + 1))
        bins.append(np.searchsorted(m.edges[j], x[:, j], "right"))
        coarse.append(np.searchsorted(m.coarse[j], x[:, j], "right"))
    rows = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, m.tables)]
    f = np.full(len(y), m.intercept)
    for _ in range(ROUNDS):
        for j, t in enumerate(m.tables):
            q = 1 / (1 + np.exp(-f))
            step = RATE * _tree(np.bincount(bins[j], y - q, len(t)), np.bincount(bins[j], q * (1 - q), len(t)), rows[j])
            t += step
            f += step[bins[j]]
    found = []

    def grid(a: int, b: int):
        q = 1 / (1 + np.exp(-f))
        shape = (len(m.coarse[a]) + 1, len(m.coarse[b]) + 1)
        at = coarse[a] * shape[1] + coarse[b]
        return at, *(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (y - q, q * (1 - q), np.ones(len(y))))

    for a in range(x.shape[1]):
        for b in range(a + 1, x.shape[1]):
            found.append((_pair_tree(*grid(a, b)[1:])[0], a, b))
    for _, a, b in sorted(found, reverse=True)[:PAIRS]:
        m.pairs.append((a, b, np.zeros((len(m.coarse[a]) + 1, len(m.coarse[b]) + 1))))
    for _ in range(PAIR_ROUNDS):
        for a, b, t in m.pairs:
            at, g, h, n = grid(a, b)
            step = RATE * _pair_tree(g, h, n)[1]
            t += step
            f += step.ravel()[at]
    return m


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", learn=None, train_rows: int = TRAIN_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The features of the bounded sample are computed where the texts are;
    ``train_rows`` short rows of numbers come to the driver and are fitted there."""
    sample = labelled_sample(docs, labels, label, F.lit(True) if learn is None else learn, train_rows, id_col, text_col)

    @F.arrow_udf("array<double>")
    def described(texts: pa.Array) -> pa.Array:
        return pa.array(list(describe(texts)), pa.list_(pa.float64()))

    rows = (sample.select("id", "y", described("text").alias("x")).groupBy("id").agg(F.max("y").alias("y"), F.max("x").alias("x"))
            .orderBy(F.xxhash64("id"), "id").limit(train_rows).select("y", "x").collect())
    if not rows:
        return Model()
    return fit(np.array([r[1] for r in rows]), np.array([r[0] for r in rows], float))


def scores(text, model: Model):
    """Column of scores (0 to 1) of a text column."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(1 / (1 + np.exp(-np.clip(model.margin(describe(texts)), -500, 500))))

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame, *, label: str = "quality", folds: int = 4, fold: int = 2,
                    threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` plus ``held_out``, ``score`` and ``predicted``; columns of
    these names are replaced."""
    model = train(docs, labels, label=label, learn=~held_out(id_col, folds, fold), id_col=id_col, text_col=text_col, **options)
    rest = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    return docs.select(*rest, held_out(id_col, folds, fold).alias("held_out"),
                       scores(F.col(text_col).cast("string"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))

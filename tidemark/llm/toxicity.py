"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams
and skip-grams.

Features of a text are the distinct hashes (``bits`` wide) of its words, pairs
of neighbours and pairs with one word between. Training follows each example's
gradient with a learning rate per coordinate; the L1 term keeps most weights at
exactly zero, so the model is a short list of (feature, weight) that goes to
every task. Scoring hashes whole texts batch by batch, keeps the features with
a weight and sums the distinct ones of each text.

The model is fitted on a bounded sample: ``train_rows`` labelled ids, those
with the smallest hashes. Everything else reads all rows.

Defined results: null and empty texts have no features and get the score of
the intercept; an id labelled more than once counts as toxic if any label says
so; labels without a document, null labels and null ids are not learned from;
repeated rows of an id are learned from once and all scored; without any
labelled row every score is 0.5; extra columns are kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, Chunk, chunks, grams, held_out, labelled_sample, mix64, words

BITS = 20
TRAIN_ROWS = 8_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.1
THRESHOLD = 0.7


def features(c: Chunk, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a chunk's texts (with repeats) and their texts."""
    w = words(c, ALNUM)
    two, ok2 = grams(w, 2)
    skip = np.zeros(len(w.hash), np.uint64)
    ok3 = np.zeros(len(w.hash), bool)
    if len(w.hash) > 2:
        skip[:-2] = mix64(w.hash[:-2] * np.uint64(0xD6E8FEB86659FD93) + w.hash[2:])
        ok3[:-2] = w.doc[:-2] == w.doc[2:]
    h = np.concatenate([w.hash, two[ok2], skip[ok3]])
    return (h >> np.uint64(64 - bits)).astype(np.int64), np.concatenate([w.doc, w.doc[ok2], w.doc[ok3]])


def fit_ftrl(examples: list[tuple[np.ndarray, int]], *, bits: int = BITS, epochs: int = EPOCHS, alpha: float = ALPHA,
             beta: float = BETA, l1: float = L1, l2: float = L2) -> tuple[np.ndarray, float]:
    """Weights and intercept from ``(distinct features, label)`` in order."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bz = bn = 0.0
    for _ in range(epochs):
        for f, y in examples:
            zf, nf = z[f], n[f]
            w = np.where(np.abs(zf) > l1, -(zf - np.sign(zf) * l1) / ((beta + np.sqrt(nf)) / alpha + l2), 0.0)
            b = -bz / ((beta + np.sqrt(bn)) / alpha)
            g = 1 / (1 + np.exp(-min(max(w.sum() + b, -30.0), 30.0))) - y
            sigma = (np.sqrt(nf + g * g) - np.sqrt(nf)) / alpha
            z[f] = zf + g - sigma * w
            n[f] = nf + g * g
            bz += g - (np.sqrt(bn + g * g) - np.sqrt(bn)) / alpha * b
            bn += g * g
    w = np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)
    return w, -bz / ((beta + np.sqrt(bn)) / alpha)


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", learn=None, train_rows: int = TRAIN_ROWS,
          bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray, float]:
    """Features with a weight, their weights and the intercept. The bounded
    sample's features are extracted where the texts are and fitted in one task."""
    sample = labelled_sample(docs, labels, label, F.lit(True) if learn is None else learn, train_rows, id_col, text_col)

    def extract(batches):
        for b in batches:
            ids, ys = b.column(0).to_pylist(), b.column(1).to_pylist()
            for c in chunks(b.column(2)):
                f, doc = features(c, bits)
                pair = np.unique(doc.astype(np.int64) << bits | f)
                cuts = np.searchsorted(pair, np.arange(1, c.hi - c.lo) << bits)
                parts = np.split((pair & ((1 << bits) - 1)).astype(np.int32), cuts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([str(i) for i in ids[c.lo : c.hi]], pa.string()), pa.array(ys[c.lo : c.hi], pa.int32()),
                     pa.array(parts, pa.list_(pa.int32()))], names=["id", "y", "f"])

    rows = (sample.mapInArrow(extract, "id string, y int, f array<int>").groupBy("id")
            .agg(F.first("y").alias("y"), F.max("f").alias("f")).orderBy(F.xxhash64("id"), "id").limit(train_rows))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["o", "id"])
        w, b = fit_ftrl(list(zip(pdf["f"], pdf["y"])), bits=bits)
        at = np.flatnonzero(w)
        return pd.DataFrame({"f": np.append(at, -1), "w": np.append(w[at], b)})

    model = rows.withColumn("o", F.xxhash64(F.concat("id", F.lit("#")))).withColumn("one", F.lit(0)).groupBy("one").applyInPandas(fit, "f long, w double")
    got = sorted((r[0], r[1]) for r in model.collect())  # at most 2^bits weights
    b = got[0][1] if got else 0.0
    return np.array([f for f, _ in got[1:]], np.int64), np.array([w for _, w in got[1:]]), b


def scores(text, model: tuple[np.ndarray, np.ndarray, float], bits: int = BITS):
    """Column of scores (0 to 1) of a text column."""
    at, weights, b = model
    dense: list[np.ndarray] = []

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not dense:
            w = np.zeros(1 << bits)
            w[at] = weights
            dense.append(w)
        out = np.full(len(texts), b)
        for c in chunks(texts):
            f, doc = features(c, bits)
            hit = dense[0][f] != 0
            pair = np.unique(doc[hit].astype(np.int64) << bits | f[hit])
            out[c.lo : c.hi] += np.bincount(pair >> bits, dense[0][pair & ((1 << bits) - 1)], c.hi - c.lo)
        return pa.array(1 / (1 + np.exp(-np.clip(out, -500, 500))))

    return score(text)


def keep_mild(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id",
              text_col: str = "text", **options) -> DataFrame:
    """``docs`` whose score is below ``threshold``; the model learns from every label."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    return docs.filter(scores(F.col(text_col).cast("string"), model) < threshold)


def score_documents(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", folds: int = 3, fold: int = 1,
                    threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` plus ``held_out``, ``score`` and ``predicted``; columns of
    these names are replaced."""
    learn = ~held_out(id_col, folds, fold)
    model = train(docs, labels, label=label, learn=learn, id_col=id_col, text_col=text_col, **options)
    rest = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    return docs.select(*rest, held_out(id_col, folds, fold).alias("held_out"),
                       scores(F.col(text_col).cast("string"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))

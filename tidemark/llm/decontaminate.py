"""Benchmark decontamination by winnowing.

A *window* is ``n`` consecutive words of a test item (10; an item of fewer
words, but not none, is one window of all its words). A document word is *hit*
if it lies in an occurrence of a window. Fingerprints find the occurrences:
hashes of all k-grams, of which each run of ``w`` keeps its smallest (the last
one on ties), with k + w - 1 = n. Whatever ``n`` words two texts share, they
keep the same k-gram of it, so joining the kept fingerprints misses nothing.
A fingerprint that both sides keep is extended to the ``n``-word windows around
it, and these are joined with the items' windows word by word.

Fingerprints of the items go to the tasks if they are counted to be at most
``limit``; beyond it they are joined with the documents' by a shuffle. Only
windows around a hit, never texts or pairs of documents, are exchanged. Items
with the same window form one set, so a passage in many items is one row.

Defined results: null and empty texts have no words and no hits; repeated rows
are rows of their own; an empty benchmark hits nothing; extra columns are
ignored by :func:`hits` and kept by :func:`keep_clean`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, Words, chunks, cut, grams, small, words

WINDOW = 10
LIMIT = 4_000_000


def split_window(n: int) -> tuple[int, int]:
    """k and w of windows of ``n`` words."""
    k = (n + 1) // 2
    return k, n - k + 1


def kept(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints kept for windows of ``n`` words."""
    k, run = split_window(n)
    h, _ = grams(w, k)
    size = len(h)
    if size < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(w.doc[: size - n + 1] == w.doc[n - 1 :])
    best, at = h[starts], starts.copy()
    for j in range(1, run):
        nxt = h[starts + j]
        better = nxt <= best
        best = np.where(better, nxt, best)
        at = np.where(better, starts + j, at)
    at = np.unique(at)
    # windows of another length are other fingerprints
    return at, (h[at] ^ np.uint64(n * 0x9E3779B97F4A7C15 % 2**64)).view(np.int64)


def around(w: Words, at: np.ndarray, n: int) -> np.ndarray:
    """Starts of the windows of ``n`` words, inside one text, that hold a
    fingerprint at one of the positions."""
    _, run = split_window(n)
    s = np.unique((at[:, None] - np.arange(run)).ravel())
    s = s[(s >= 0) & (s + n <= len(w.doc))]
    return s[w.doc[s] == w.doc[s + n - 1]]


def window_text(w: Words, start: int, n: int) -> str:
    return b" ".join(w.low[a:b].tobytes() for a, b in
                     zip(w.start[start : start + n], w.end[start : start + n])).decode("utf-8", "replace")


def item_windows(items: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, n, window)``: every window of every item."""

    def cut_up(batches):
        for b in batches:
            ids, out = b.column(0).to_pylist(), ([], [], [])
            for c in chunks(b.column(1)):
                w = words(c, ALNUM)
                for d in range(len(c.offs) - 1):
                    first, last = int(w.first[d]), int(w.first[d + 1])
                    size = min(n, last - first)
                    for s in range(first, last - size + 1 if size else first):
                        for o, v in zip(out, (ids[c.lo + d], size, window_text(w, s, size))):
                            o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()),
                                              pa.array(out[2], pa.string())], names=["item_id", "n", "window"])

    return (items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(cut_up, "item_id string, n int, window string").distinct())


def fingerprints(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """``(key, n, at, hash)`` of the kept fingerprints of ``texts(key, text)``;
    positions count words from the start of the text."""

    def select(batches):
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for c in chunks(b.column(1)):
                w = words(c, ALNUM)
                for n in sizes:
                    at, h = kept(w, n)
                    doc = w.doc[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[c.lo + doc], pa.int64()), pa.array(np.full(len(at), n, np.int32)),
                         pa.array((at - w.first[doc]).astype(np.int32)), pa.array(h)], names=["key", "n", "at", "hash"])

    return texts.mapInArrow(select, "key long, n int, at int, hash long")


def merged_spans(windows: pa.Array) -> pa.Array:
    """Overlapping or touching ranges as one."""
    out = []
    for row in windows.to_pylist():
        spans: list[dict] = []
        for x in sorted(row or (), key=lambda x: (x["a"], x["b"])):
            if spans and x["a"] <= spans[-1]["b"]:
                spans[-1]["b"] = max(spans[-1]["b"], x["b"])
            else:
                spans.append(dict(x))
        out.append(spans)
    return pa.array(out, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))


FOUND = "key long, id string, n_words long, found array<struct<start:int,n:int,window:string>>"


def _found(sizes: list[int], known: np.ndarray | None):
    """Rows ``(key, id, text[, at])`` -> ``FOUND``: the windows around hits, from
    the set of known hashes or from given positions (n, at)."""

    def find(batches):
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [])
            keys, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            given = b.column(3).to_pylist() if known is None else None
            for c in chunks(b.column(2)):
                w = words(c, ALNUM)
                per: list[list] = [[] for _ in range(c.hi - c.lo)]
                for n in sizes:
                    if known is None:
                        at = np.array([w.first[d] + g["at"] for d in range(c.hi - c.lo)
                                       for g in given[c.lo + d] or () if g["n"] == n], np.int64)
                    else:
                        at, h = kept(w, n)
                        i = np.searchsorted(known, h)
                        at = at[known[np.minimum(i, len(known) - 1)] == h] if len(known) else at[:0]
                    for s in around(w, at, n).tolist():
                        d = int(w.doc[s])
                        per[d].append({"start": s - int(w.first[d]), "n": n, "window": window_text(w, s, n)})
                for d, rows in enumerate(per):
                    for o, v in zip(out, (keys[c.lo + d], ids[c.lo + d], int(w.first[d + 1] - w.first[d]), rows)):
                        o.append(v)
            types = (pa.int64(), pa.string(), pa.int64(),
                     pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("window", pa.string())])))
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)],
                                             names=["key", "id", "n_words", "found"])

    return find


def hits(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, limit: int = LIMIT, id_col: str = "doc_id",
         text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_hit``, ``items`` (sorted
    ids, as strings, of the items with occurring windows) and ``spans`` (word
    ranges hit, end exclusive, merged)."""
    wins = cut(item_windows(items, window, item_col, item_text), "item-windows")
    sizes = [r[0] for r in wins.select("n").distinct().collect()]
    prints = cut(fingerprints(items.select(F.lit(0).cast("long").alias("key"), F.col(item_text).cast("string").alias("text")),
                              sizes).select("hash").distinct(), "item-prints")
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("string").alias("id"),
                       F.col(text_col).cast("string").alias("text"))
    if prints.count() <= limit:
        known = np.sort(np.array([r[0] for r in prints.collect()], np.int64))
        found = rows.mapInArrow(_found(sizes, known), FOUND)
    else:
        rows = cut(rows, "decontaminate")
        near = (fingerprints(rows.select("key", "text"), sizes).join(prints, "hash", "left_semi")
                .groupBy("key").agg(F.collect_list(F.struct("n", "at")).alias("at")))
        found = rows.join(near, "key", "left").select("key", "id", "text", "at").mapInArrow(_found(sizes, None), FOUND)
    found = cut(found, "found")
    # items with the same window are one set
    by_window = wins.groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("items")).withColumn(
        "set", F.sha2(F.concat_ws(",", "items"), 256))
    sets = by_window.select("set", "items").dropDuplicates(["set"])
    n_windows = wins.count()
    cand = found.select("key", F.explode("found").alias("f")).select("key", "f.start", "f.n", "f.window")
    real = cut(cand.join(small(by_window.select("window", "set"), n_windows, 200_000), "window").select("key", "start", "n", "set"), "real")
    spans = real.groupBy("key").agg(F.collect_set(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b"))).alias("w"))
    spans = spans.select("key", F.arrow_udf(merged_spans, "array<struct<a:int,b:int>>")("w").alias("spans"))
    whose = (real.select("key", "set").distinct().join(small(sets, n_windows, 50_000), "set")
             .groupBy("key").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    empty = F.expr("cast(array() as array<string>)")
    none = F.expr("cast(array() as array<struct<a:int,b:int>>)")
    return (found.select("key", "id", "n_words").join(spans.join(whose, "key"), "key", "left")
            .select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_words",
                    F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + (x["b"] - x["a"])), F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", empty).alias("items"), F.coalesce("spans", none).alias("spans")))


def keep_clean(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold a window of an item (all rows of
    an id share its verdict)."""
    bad = cut(hits(docs, items, id_col=id_col, **options).filter("n_hit > 0").select(F.col(id_col).alias("__bad")).distinct(), "bad")
    return docs.join(small(bad, bad.count(), 1_000_000), F.col(id_col).eqNullSafe(F.col("__bad")), "left_anti")

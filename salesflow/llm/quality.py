"""Document quality by histogram gradient-boosted trees over document statistics.

``statistics`` turns whole texts into a few dozen numbers, a whole Arrow batch at a
time. The trees are fitted on a bounded, documented sample of labelled rows
(``sample_rows`` with the smallest key hashes): the features are computed on the
executors and only the numbers travel. Each feature is cut into at most ``bins``
quantile bins, every tree is a complete binary tree grown level by level from
gradient histograms, and the forest is flattened into arrays, so that scoring is
``depth`` gathers for a whole batch.

Defined results: null and empty texts have all-zero statistics and get a score
like any other text; repeated rows get equal scores; labels that are null are not
learned from, the smallest of repeated labels counts; without labels of both
classes the score is the share of label 1 (1.0 without any label, nothing is
rejected unseen); an empty table gives an empty table; extra columns are kept by
``score`` and ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.llm.common import text_slices
from salesflow.llm.textbytes import NOT_SPACE, mix, text_bytes, words

# classes of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 blank, 5 line end, 6 sentence marks, 7 symbols, 8 non-ASCII, 9 brackets and quotes
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[32, 9]], _CLASS[[10, 13]] = 1, 2, 3, 4, 5
_CLASS[[ord(c) for c in ".,;:!?"]] = 6
_CLASS[[ord(c) for c in "#$%&*+/<=>@\\^_`|~"]] = 7
_CLASS[128:] = 8
_CLASS[[ord(c) for c in "()[]{}'\"-"]] = 9
CLASSES = 10

NAMES = ["log_bytes", "log_words", "log_lines", *(f"share_{c}" for c in (
    "other", "lower", "upper", "digit", "blank", "line_end", "mark", "symbol", "wide", "bracket")),
    "word_mean", "word_std", "words_long", "words_short", "words_upper", "words_symbol", "distinct", "same_as_before",
    "top_word", "line_mean", "lines_distinct", "marks_per_word", "loud_marks", "bars"]


def _largest_group(doc: np.ndarray, key: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the count of the commonest key, for each row."""
    distinct, top = np.zeros(rows), np.zeros(rows)
    if len(key):
        both = np.sort(mix(key + mix(doc.astype(np.uint64) + np.uint64(1)) * np.uint64(3)) >> np.uint64(1))
        # the sort loses the row, so a key's row is kept beside it
        order = np.argsort(mix(key + mix(doc.astype(np.uint64) + np.uint64(1)) * np.uint64(3)) >> np.uint64(1), kind="stable")
        first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
        size = np.diff(np.r_[first, len(both)])
        owner = doc[order[first]]
        distinct = np.bincount(owner, minlength=rows).astype(float)
        np.maximum.at(top, owner, size)
    return distinct, top


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` for each text."""
    data, offsets = text_bytes(column)
    rows, size = len(offsets) - 1, np.diff(offsets)
    row_of = np.repeat(np.arange(rows), size)
    kind = _CLASS[data]
    by_class = np.bincount(row_of * CLASSES + kind, minlength=rows * CLASSES).reshape(rows, CLASSES).astype(float)
    w = words(data, offsets, NOT_SPACE, fold=False)
    n, length = w.count.astype(float), w.length.astype(float)
    per = lambda x: np.bincount(w.doc, weights=x, minlength=rows) if len(w.doc) else np.zeros(rows)
    some, total = np.maximum(n, 1), np.maximum(size, 1)
    mean = per(length) / some
    last = kind[w.start + w.length - 1] if len(w.start) else np.zeros(0, np.uint8)
    head = kind[w.start] if len(w.start) else last
    tail_upper = (head == 2) & np.isin(kind[np.minimum(w.start + 1, max(len(kind) - 1, 0))], (2,)) if len(w.start) else last
    distinct, top = _largest_group(w.doc, w.hash, rows)
    same = np.zeros(len(w.doc), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    not_end = np.ones(256, bool)
    not_end[[10, 13]] = False
    lines = words(data, offsets, not_end, fold=False)
    line_distinct, _ = _largest_group(lines.doc, lines.hash, rows)
    count = np.maximum(lines.count, 1)
    loud = np.bincount(row_of, weights=(data == 33), minlength=rows)
    bars = np.bincount(row_of, weights=(data == 124), minlength=rows)
    return np.column_stack([
        np.log1p(size), np.log1p(n), np.log1p(lines.count), by_class / total[:, None],
        mean, np.sqrt(np.maximum(per(length ** 2) / some - mean ** 2, 0)), per(length > 12) / some, per(length < 3) / some,
        per(tail_upper) / some, per((last == 7) | (head == 7)) / some, distinct / some, per(same) / some, top / some,
        size / count, line_distinct / count, by_class[:, 6] / some, loud / some, bars / some]).astype(np.float64)


@dataclass
class Forest:
    """Complete trees in heap order: ``feature`` and ``cut`` of inner nodes, ``leaf`` values."""

    base: float
    feature: np.ndarray  # trees x (2**depth - 1)
    cut: np.ndarray
    leaf: np.ndarray     # trees x 2**depth
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        trees = len(self.feature)
        if not trees or not len(x):
            return np.full(len(x), self.base)
        node = np.zeros((len(x), trees), np.int64)
        tree, row = np.arange(trees)[None, :], np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.cut[tree, node])
        return self.base + self.leaf[tree, node - (2 ** self.depth - 1)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, bins: int = 64, rate: float = 0.15,
        ridge: float = 2.0, least: float = 4.0) -> Forest:
    """Second-order boosting of the logistic loss on feature histograms."""
    nodes, leaves = 2 ** depth - 1, 2 ** depth
    empty = np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, leaves))
    if not len(y):
        return Forest(35.0, *empty, depth)
    share = float(y.mean())
    if share in (0.0, 1.0):
        return Forest(35.0 if share else -35.0, *empty, depth)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    base = float(np.log(share / (1 - share)))
    raw, feature, cut, leaf = np.full(len(y), base), [], [], []
    width = bins + 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node, f_of, c_of = np.zeros(len(y), np.int64), np.zeros(nodes, np.int64), np.full(nodes, np.inf)
        for level in range(depth):
            at, k = 2 ** level - 1, 2 ** level
            best = np.full(k, 1e-9)
            go = np.zeros(len(y), bool)
            pick_f, pick_b = np.full(k, -1), np.zeros(k, np.int64)
            for j in range(x.shape[1]):
                if not len(cuts[j]):
                    continue
                cell = (node - at) * width + binned[:, j]
                gs = np.bincount(cell, g, k * width).reshape(k, width).cumsum(1)
                hs = np.bincount(cell, h, k * width).reshape(k, width).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt ** 2 / (ht + ridge)
                gain[(hs < least / 4) | (ht - hs < least / 4)] = -1
                gain = gain[:, :len(cuts[j])]
                b = gain.argmax(1)
                top = gain[np.arange(k), b]
                better = top > best
                best[better], pick_f[better], pick_b[better] = top[better], j, b[better]
            for i in np.flatnonzero(pick_f >= 0):
                f_of[at + i], c_of[at + i] = pick_f[i], cuts[pick_f[i]][pick_b[i]]
                here = node == at + i
                go[here] = binned[here, pick_f[i]] > pick_b[i]
            node = 2 * node + 1 + go
        end = node - nodes
        value = -rate * np.bincount(end, g, leaves) / (np.bincount(end, h, leaves) + ridge)
        raw += value[end]
        feature.append(f_of), cut.append(c_of), leaf.append(value)
    return Forest(base, np.array(feature), np.array(cut), np.array(leaf), depth)


def held_out(key: str = "doc_id", mod: int = 4, rest: int = 2) -> Column:
    """crc32 of the key as text leaves ``rest``; null keys are not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(mod)) == rest, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = 20_000, **params) -> Forest:
    """Fit on at most ``sample_rows`` labelled rows that are not held out."""
    rows = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
            .groupBy("doc_id").agg(F.min(label).cast("int").alias("__y"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    # at most sample_rows rows of 12 bytes; one text for each of them, though rows repeat its id
    known = (docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
             .groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("__y").alias("__y")).select("text", "__y"))
    width = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                x = statistics(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("__y"), pa.array(list(x), pa.list_(pa.float64()))], ["y", "x"])

    got = known.mapInArrow(run, "y int, x array<double>").toPandas()
    if not len(got):
        return fit(np.zeros((0, width)), np.zeros(0), **params)
    x, y = np.array(got["x"].tolist()).reshape(-1, width), got["y"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # the same model whatever order the rows came in
    return fit(x[order], y[order], **params)


def score(docs: DataFrame, forest: Forest, threshold: float = 0.7, keep_only: bool = False) -> DataFrame:
    """Every row with ``score`` and ``predicted`` added; with ``keep_only``, the rows predicted 1, unchanged."""
    model = docs.sparkSession.sparkContext.broadcast(forest)
    cols = [f for f in docs.schema.fields if keep_only or f.name not in ("score", "predicted")]
    schema = T.StructType(cols if keep_only else [*cols, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                s = model.value.score(statistics(part.column("text")))
                if keep_only:
                    yield part.filter(pa.array(s >= threshold))
                else:
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                                     [*part.schema.names, "score", "predicted"])

    return docs.select(*[F.col(f"`{f.name}`") for f in cols]).mapInArrow(run, schema)

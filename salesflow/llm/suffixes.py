"""Benchmark decontamination by suffix arrays over the training documents.

Documents are taken in shards of about ``shard_words`` words, where they lie; each
shard gets a suffix array (prefix doubling in numpy), and every suffix of every
benchmark item is binary-searched in it, all at once, one word deeper at a time.
The search gives each suffix its longest verbatim match and, at window depth, the
range of all places where the window occurs. No shuffle, no document collected.

Words that no item has cannot lie in a match: they end a run, and runs shorter
than the shortest window are left out of the array, which changes no match.

The benchmark is the stated query set. Its index (about 24 bytes a word) is
broadcast in blocks of at most ``block_words`` words, built from an iterator.

Defined results: null and empty texts have no words, no hits and no items; an item
without words is never found; a null item id counts as the text ``null``; items
with equal ids count once; ties for the longest match go to the first place, then
to the first item; an empty benchmark hits nothing; extra columns are kept by
``decontaminate``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import text_slices
from salesflow.llm.textbytes import ALNUM, text_bytes, words


@dataclass
class Items:
    """A block of items: ``ids``, the vocabulary's sorted hashes, and all words as vocabulary ranks + 1."""

    ids: list[str]
    vocabulary: np.ndarray
    word: np.ndarray
    first: np.ndarray
    length: np.ndarray
    window: int

    @property
    def windows(self) -> np.ndarray:
        return np.minimum(self.length, self.window)


def items_of(ids: list[str], texts: list[str | None], window: int) -> Items:
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    w = words(data, offsets, ALNUM)
    vocabulary, rank = np.unique(w.hash, return_inverse=True)
    return Items(ids, vocabulary, (rank + 1).astype(np.int32), np.cumsum(w.count) - w.count, w.count, window)


def item_blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[Items]:
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text")
    for item, text in rows.toLocalIterator():
        ids.append(item), texts.append(text)
        size += len(text or "") // 2 + 1  # a word and its separator take two characters at least
        if size >= block_words:
            yield items_of(ids, texts, window)
            ids, texts, size = [], [], 0
    if ids:
        yield items_of(ids, texts, window)


def suffix_array(word: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes by their first ``depth`` words; word 0 ends a suffix."""
    rank, k = word.astype(np.int64), 1
    n = len(word)
    ended = word == 0
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:max(n - k, 0)] = rank[k:]
        key = np.where(ended, 0, rank * (rank.max(initial=0) + 1) + ahead)
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.empty(n, np.int64)
        # suffixes that start at an end stay rank 0
        new[order] = np.cumsum(np.r_[False, key[1:] != key[:-1]]) if n else key
        if n and not ended.any():
            new += 1
        rank, k = new, 2 * k
        if k >= depth or not n or rank.max() >= n - int(ended.sum()):
            return order[int(ended.sum()):]


def search(text: np.ndarray, suffixes: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every item word as the start of a suffix: its longest match, and the range of places at window depth."""
    total = len(items.word)
    item = np.repeat(np.arange(len(items.length)), items.length)
    left = items.first[item] + items.length[item] - np.arange(total)
    window = items.windows[item]
    lo, hi = np.zeros(total, np.int64), np.full(total, len(suffixes), np.int64)
    longest = np.zeros(total, np.int64)
    at_lo, at_hi = np.zeros(total, np.int64), np.zeros(total, np.int64)
    live, depth = np.flatnonzero((left > 0) & (len(suffixes) > 0)), 0
    padded = np.r_[text, 0]

    def bound(q, word, a, b, after):
        a, b = a.copy(), b.copy()
        while True:
            on = a < b
            if not on.any():
                return a
            mid = (a + b) >> 1
            here = padded[np.minimum(suffixes[np.where(on, mid, 0)] + depth, len(text))]
            right = on & ((here < word) | (after & (here == word)))
            a, b = np.where(right, mid + 1, a), np.where(on & ~right, mid, b)

    while len(live):
        word = items.word[live + depth]
        a = bound(live, word, lo[live], hi[live], False)
        b = bound(live, word, a, hi[live], True)
        found = a < b
        live, a, b = live[found], a[found], b[found]
        depth += 1
        lo[live], hi[live], longest[live] = a, b, depth
        done = window[live] == depth
        at_lo[live[done]], at_hi[live[done]] = a[done], b[done]
        live = live[left[live] > depth]
    # a window must fit into its item
    short = left < window
    at_hi[short] = at_lo[short]
    return longest, at_lo, at_hi


@dataclass
class Found:
    """Results for the documents of a shard."""

    n_words: np.ndarray
    n_hit: np.ndarray
    items: list[list[str]]
    longest: np.ndarray        # words of the longest match
    longest_start: np.ndarray  # its first word in the document, -1 without any
    longest_item: list


def scan(hashes: np.ndarray, counts: np.ndarray, blocks: list[Items]) -> Found:
    """Search every block's suffixes in the shard's words (``counts`` words for each document)."""
    docs, n = len(counts), int(counts.sum())
    doc = np.repeat(np.arange(docs), counts)
    first = np.cumsum(counts) - counts
    hit = np.zeros(n + 1, np.int64)
    got: list[set[str]] = [set() for _ in range(docs)]
    longest, start, by = np.zeros(docs, np.int64), np.full(docs, -1, np.int64), [None] * docs
    for items in blocks:
        usable = items.length > 0
        if not usable.any() or not n:
            continue
        shortest = int(items.windows[usable].min())
        rank = np.searchsorted(items.vocabulary, hashes)
        rank[rank == len(items.vocabulary)] = 0
        known = items.vocabulary[rank] == hashes
        # runs of known words within a document
        opens = known & np.r_[True, ~known[:-1] | (doc[1:] != doc[:-1])]
        closes = known & np.r_[~known[1:] | (doc[1:] != doc[:-1]), True]
        a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        long = b - a >= shortest
        a, size = a[long], (b - a)[long] + 1  # each run is followed by an end
        if not len(a):
            continue
        begin = np.cumsum(size) - size
        origin = np.arange(int(size.sum())) - np.repeat(begin, size) + np.repeat(a, size)
        text = np.zeros(len(origin), np.int32)
        inside = np.ones(len(origin), bool)
        inside[begin + size - 1] = False
        text[inside] = rank[origin[inside]] + 1
        order = suffix_array(text, int(items.length.max()))
        _, lo, hi = search(text, order, items)
        item = np.repeat(np.arange(len(items.length)), items.length)
        q = np.flatnonzero(hi > lo)
        if len(q):
            times = hi[q] - lo[q]
            at = order[np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo[q], times)]
            by_suffix = np.repeat(q, times)
            of, size = item[by_suffix], items.windows[item[by_suffix]].astype(np.int64)
            ends = items.first[of] + items.length[of] - by_suffix
            grow = np.arange(len(at))
            while len(grow):  # how far each occurrence goes on word for word
                grow = grow[size[grow] < ends[grow]]
                grow = grow[items.word[by_suffix[grow] + size[grow]] == text[at[grow] + size[grow]]]
                size[grow] += 1
            at = origin[at]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + items.windows[of], -1)
            for pair in np.unique(doc[at] * len(items.length) + of):
                got[pair // len(items.length)].add(items.ids[pair % len(items.length)])
            best = np.lexsort((of, at, -size, doc[at]))
            best = best[np.r_[True, doc[at[best[1:]]] != doc[at[best[:-1]]]]]
            for i in best:
                if size[i] > longest[d := doc[at[i]]]:
                    longest[d], start[d], by[d] = size[i], at[i] - first[d], items.ids[of[i]]
    covered = np.cumsum(hit[:-1]) > 0
    return Found(counts, np.bincount(doc, weights=covered, minlength=docs).astype(np.int64) if n else np.zeros(docs, np.int64),
                 [sorted(g) for g in got], longest, start, by)


def _run(docs: DataFrame, benchmark: DataFrame, schema, emit, window: int, shard_words: int, block_words: int) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    blocks = [sc.broadcast(b) for b in item_blocks(benchmark, window, block_words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hashes, counts, size = [], [], [], 0

        def flush():
            found = scan(np.concatenate(hashes), np.concatenate(counts), [b.value for b in blocks])
            at = 0
            for part in held:
                yield emit(part, found, at)
                at += part.num_rows

        for batch in batches:
            for part in text_slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                w = words(data, offsets, ALNUM)
                held.append(part), hashes.append(w.hash), counts.append(w.count)
                size += len(w.hash)
                if size >= shard_words:
                    yield from flush()
                    held, hashes, counts, size = [], [], [], 0
        if held:
            yield from flush()

    return docs.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_words: int = 2_000_000,
                  block_words: int = 4_000_000) -> DataFrame:
    """doc_id with words, hit words, items found and the longest verbatim match of each document."""
    def emit(part: pa.RecordBatch, found: Found, at: int) -> pa.RecordBatch:
        s = slice(at, at + part.num_rows)
        items = found.items[s]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(found.n_words[s]), pa.array(found.n_hit[s]), pa.array([len(i) for i in items], pa.int64()),
             pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]), pa.array(found.n_hit[s] > 0),
             pa.array(items, pa.list_(pa.string())), pa.array(found.longest[s]), pa.array(found.longest_start[s]),
             pa.array(found.longest_item[s], pa.string())],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "longest_words", "longest_start", "longest_item"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return _run(docs.select("doc_id", "text"), benchmark,
                f"doc_id {key}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
                "items array<string>, longest_words long, longest_start long, longest_item string",
                emit, window, shard_words, block_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_words: int = 2_000_000,
                  block_words: int = 4_000_000) -> DataFrame:
    """The documents without any benchmark window, all columns unchanged."""
    def emit(part: pa.RecordBatch, found: Found, at: int) -> pa.RecordBatch:
        return part.filter(pa.array(found.n_hit[at:at + part.num_rows] == 0))

    return _run(docs, benchmark, docs.schema, emit, window, shard_words, block_words)

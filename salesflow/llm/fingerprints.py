"""Document fingerprints: invertible Bloom lookup tables of paragraph digests.

A text is cut into paragraphs (lines; a line is cut again after its sentences, and
a very long sentence at content-defined words), each hashed to a 64-bit digest; the
k-th occurrence of an equal paragraph counts as its own digest, so fingerprints are
of multisets. A digest's low 12 bits are its paragraph's length, so likeness can weigh
what differs by characters. Each digest is added to one cell in each of three sub-tables (count,
xor of digests, xor of check hashes). Subtracting two tables leaves the digests in
which the versions differ; peeling cells that hold exactly one recovers them. Where
peeling stops short, the pair is tried again with tables ``GROW`` times larger,
built from the texts, until it succeeds (at over eight cells a digest the digests
themselves are compared).

Neighbours by key: bounds of key ranges come from the keys alone, rows travel once
to their range (texts compressed), and the first rows of a range also to the range before it.
No window over all rows, nothing but the bounds on the driver.

Defined results: a null text is empty; an empty text has no paragraphs, and two
such texts are alike (1.0); rows are ordered by key, nulls first, equal keys by a hash of the text; after
the last row comes the first, also if it is the same row; an empty table gives an
empty table; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.textbytes import mix

CELLS = 30   # cells of a published fingerprint, a multiple of three
GROW = 4
LONG = 160   # characters of a sentence that is cut further

U = np.uint64
LENGTH = U(0xFFF)
_SALT = mix(np.arange(11, 15, dtype=np.uint64))


def paragraphs(text: str) -> list[str]:
    out = []
    for piece in text.replace(". ", ".\n").replace("! ", "!\n").replace("? ", "?\n").split("\n"):
        if len(piece) <= LONG:
            if piece:
                out.append(piece)
            continue
        run: list[str] = []
        for word in piece.split(" "):
            if len(word) > LONG:  # no blanks: pieces of a fixed length
                out += [" ".join(run)] * bool(run) + [word[i:i + LONG // 2] for i in range(0, len(word), LONG // 2)]
                run = []
                continue
            run.append(word)
            if zlib.crc32(word.encode("utf-8", "replace")) % 8 == 0 or len(run) >= 48:
                out.append(" ".join(run))
                run = []
        if run:
            out.append(" ".join(run))
    return out


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all paragraphs of all texts, and their number by text."""
    value, length, sizes = [], [], []
    for text in texts:
        parts = paragraphs(text)
        value += [xxhash.xxh3_64_intdigest(p) for p in parts]
        length += [len(p) for p in parts]
        sizes.append(len(parts))
    sizes = np.array(sizes, np.int64)
    value = np.array(value, np.uint64) & ~LENGTH | np.minimum(np.array(length, np.uint64), LENGTH)
    row = np.repeat(np.arange(len(sizes)), sizes)
    # the k-th occurrence within a text is a digest of its own
    order = np.lexsort((value, row))
    v, r = value[order], row[order]
    new = np.r_[True, (v[1:] != v[:-1]) | (r[1:] != r[:-1])] if len(v) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(v)), 0)) if len(v) else np.zeros(0, np.int64)
    again = (np.arange(len(v)) - first).astype(np.uint64)
    return mix(v + mix(again + _SALT[3])) & ~LENGTH | v & LENGTH, sizes


def weights(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Characters of all paragraphs of each text."""
    return np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=keys & LENGTH, minlength=len(sizes))


def _check(keys: np.ndarray) -> np.ndarray:
    return mix(keys ^ _SALT[0]) >> U(32)


def _cells(keys: np.ndarray, m: int) -> list[np.ndarray]:
    third = m // 3
    h = mix(keys ^ _SALT[1])
    g = mix(keys ^ _SALT[2])
    return [(h % U(third)).astype(np.int64), (g % U(third)).astype(np.int64) + third,
            ((h >> U(40)) ^ (g >> U(38))).astype(np.int64) % third + 2 * third]


class Tables:
    """Lookup tables of ``n`` rows side by side."""

    def __init__(self, n: int, m: int):
        self.n, self.m = n, m
        self.count, self.keys, self.check = np.zeros(n * m, np.int64), np.zeros(n * m, np.uint64), np.zeros(n * m, np.uint64)

    def add(self, row: np.ndarray, keys: np.ndarray, sign) -> Tables:
        check = _check(keys)
        for cell in _cells(keys, self.m):
            at = row * self.m + cell
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.keys, at, keys)
            np.bitwise_xor.at(self.check, at, check)
        return self

    def minus(self, other: Tables) -> Tables:
        out = Tables(self.n, self.m)
        out.count, out.keys, out.check = self.count - other.count, self.keys ^ other.keys, self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, digest, sign) of every recovered digest, and which rows were recovered whole. Empties the tables."""
        rows, keys, signs = [], [], []
        while True:
            at = np.flatnonzero(np.abs(self.count) == 1)
            at = at[self.check[at] == _check(self.keys[at])]
            if not len(at):
                break
            row, key, sign = at // self.m, self.keys[at], self.count[at]
            _, once = np.unique(mix(key + mix(row.astype(np.uint64))), return_index=True)
            row, key, sign = row[once], key[once], sign[once]
            rows.append(row), keys.append(key), signs.append(sign)
            self.add(row, key, -sign)
        whole = ~((self.count != 0) | (self.keys != 0) | (self.check != 0)).reshape(self.n, self.m).any(1)
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), whole
        return np.concatenate(rows), np.concatenate(keys), np.concatenate(signs), whole


def tables_of(keys: np.ndarray, sizes: np.ndarray, m: int) -> Tables:
    return Tables(len(sizes), m).add(np.repeat(np.arange(len(sizes)), sizes), keys, 1)


def text_of(tables: Tables, sizes: np.ndarray, texts: list[str]) -> list[str]:
    """Fingerprints as text: paragraphs, a hash of the whole text, the cells."""
    out, m = [], tables.m
    for i, text in enumerate(texts):
        s = slice(i * m, (i + 1) * m)
        cells = tables.count[s].astype("<i4").tobytes() + tables.keys[s].astype("<u8").tobytes() + tables.check[s].astype("<u4").tobytes()
        out.append(f"{sizes[i]}.{xxhash.xxh3_64_hexdigest(text)}.{base64.b64encode(cells).decode()}")
    return out


def parse(fingerprint: str) -> tuple[Tables, int]:
    """A published fingerprint's table and number of paragraphs."""
    size, _, cells = fingerprint.split(".")
    raw = base64.b64decode(cells)
    m = len(raw) // 16
    t = Tables(1, m)
    t.count = np.frombuffer(raw[:4 * m], "<i4").astype(np.int64)
    t.keys = np.frombuffer(raw[4 * m:12 * m], "<u8").astype(np.uint64)
    t.check = np.frombuffer(raw[12 * m:], "<u4").astype(np.uint64)
    return t, int(size)


def difference(a: str, b: str) -> tuple[list[int], list[int]] | None:
    """Digests only in ``a`` and only in ``b``, from the fingerprints alone; None if they do not peel."""
    _, keys, signs, whole = parse(a)[0].minus(parse(b)[0]).peel()
    return (keys[signs > 0].tolist(), keys[signs < 0].tolist()) if whole[0] else None


def likeness(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, m: int = CELLS) -> np.ndarray:
    """Characters in shared paragraphs of those in all paragraphs, for each pair of rows (digests flat, numbers by row)."""
    n = len(na)
    out = np.ones(n)
    start_a, start_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    wa, wb = weights(a, na), weights(b, nb)
    todo = np.flatnonzero(na + nb)
    pick = lambda start, size: np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
    while len(todo):
        ka, kb = a[pick(start_a[todo], na[todo])], b[pick(start_b[todo], nb[todo])]
        t = tables_of(ka, na[todo], m).minus(tables_of(kb, nb[todo], m))
        row, key, sign, whole = t.peel()
        only_a = np.bincount(row, weights=(sign > 0) * (key & LENGTH), minlength=len(todo))
        only_b = np.bincount(row, weights=(sign < 0) * (key & LENGTH), minlength=len(todo))
        shared = wa[todo] - only_a
        whole &= shared == wb[todo] - only_b
        out[todo[whole]] = (shared / np.maximum(shared + only_a + only_b, 1))[whole]
        todo = todo[~whole]
        roomy = m > 8 * (na[todo] + nb[todo])
        for i in todo[roomy]:
            x = np.intersect1d(a[start_a[i]:start_a[i] + na[i]], b[start_b[i]:start_b[i] + nb[i]])
            shared = float((x & LENGTH).sum())
            out[i] = shared / max(wa[i] + wb[i] - shared, 1)
        todo = todo[~roomy]
        m *= GROW
    return out


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as many first characters of the following text."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def fingerprints(docs: DataFrame, cells: int = CELLS, docs_per_range: int = 2048) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness and that of the next document."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    total, with_key = docs.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // docs_per_range // 4))
    ranges = 4 * partitions
    # the first key of each range; one value for each range
    bounds = sorted(r[0] for r in docs.where("doc_id is not null").select("doc_id").repartitionByRange(ranges, "doc_id")
                    .groupBy(F.spark_partition_id()).agg(F.min("doc_id")).select("min(doc_id)").collect())
    unkeyed = total > with_key
    last = max(len(bounds) - 1, 0)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = {k: i - 1 for i, k in enumerate(bounds) if i}
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            home = np.array([0 if k is None else max(bisect_right(bounds, k) - 1, 0) for k in ids], np.int32)
            texts = batch.column("text").to_pylist()
            tie = pa.array([xxhash.xxh3_64_intdigest(t) >> 1 for t in texts], pa.int64())
            packed = pa.array([squeeze(t.encode()) for t in texts], pa.binary())
            columns = [batch.column("doc_id"), tie, packed]
            yield pa.RecordBatch.from_arrays([pa.array(home), pa.array(np.zeros(len(ids), np.int32)), *columns], dealt_names)
            # copies for the range before; the very first rows follow the last range
            first = [k is None if unkeyed else k == bounds[0] for k in ids]
            for at, to in (([i for i, k in enumerate(ids) if k in heads], 1), ([i for i, f in enumerate(first) if f], 2)):
                if at:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([heads[ids[i]] if to == 1 else last for i in at], pa.int32()), pa.array([to] * len(at), pa.int32()),
                         *[c.take(pa.array(at)) for c in columns]], dealt_names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows of one range in order; a copy comes last and only follows
        size = 0

        def flush(rows, following):
            ids, texts = [r[2] for r in rows], [r[3] for r in rows]
            after = texts[1:] + [following]
            new = [edited(t, f) for t, f in zip(texts, after, strict=True)]
            a, na = digests([*texts, following])
            b, nb = digests(new)
            own = int(na[:-1].sum())
            n = len(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, key_type), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new]),
                 pa.array(text_of(tables_of(a[:own], na[:n], cells), na[:n], texts)),
                 pa.array(text_of(tables_of(b, nb, cells), nb, new)),
                 pa.array(likeness(a[:own], na[:n], b, nb, cells)),
                 pa.array(likeness(a[:own], na[:n], a[int(na[0]):], na[1:], cells)),
                 pa.array(na[:n]), pa.array(nb)], names)

        stretch = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = (*row[:3], stretch(row[4]).decode())
                if held and row[0] != held[0][0]:
                    held, size = [], 0
                if held and (row[1] or size >= 2 << 20):
                    yield flush(held, row[3])
                    held, size = [], 0
                if not row[1]:
                    held.append(row)
                    size += len(row[3])

    from pyspark.sql.pandas.types import to_arrow_type
    dealt_names = ["range", "copy", "doc_id", "tie", "packed"]
    key_type = to_arrow_type(docs.schema["doc_id"].dataType)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "paragraphs", "edited_paragraphs"]
    dealt = keyed.mapInArrow(deal, f"range int, copy int, doc_id {kind}, tie long, packed binary")
    ordered = dealt.repartition(partitions, "range").sortWithinPartitions(
        "range", F.col("copy"), F.col("doc_id").asc_nulls_first(), "tie")
    return ordered.mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                   "near_edited double, near_next double, paragraphs long, edited_paragraphs long")

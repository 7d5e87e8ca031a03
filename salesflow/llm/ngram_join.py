"""Exact Jaccard self-join of word n-gram sets by universe partitioning.

Two sets with Jaccard >= t differ in at most H = (|r| + |s|) (1 - t) / (1 + t)
elements. A hash cuts the universe of n-grams into segments; by the pigeonhole
principle a similar pair agrees on the subset in some segment (or nearly does):
if segment i tolerates T(i) differences and the sum of T(i) + 1 over the indexed
segments exceeds H, some segment differs by at most T(i). A segment is indexed

* with T = 0, by the hash of the set's whole subset in it, or
* with T = 1, by that hash and those of all its one-deletion neighbours, or not at all.

Sets are taken by size band (powers of two; a pair falls into one band or across
two neighbouring ones, each with its own partition of the universe). Allocation is
by cost at two levels. For each band, a model of expected rows and of signatures
with too few elements decides how many wide T = 1 segments there are. For each
set, of all its other segments the H + 1 - 2 x (wide ones) of least cost are
indexed. The cost depends on the subset alone (how common its rarest n-gram is, by
a count sketch over all documents; then its size; then its hash), so both sets of a
pair rank an equal subset alike: were none of the chosen subsets of the set that
stops first in this order equal, more than H elements would differ. Common
passages are dear and hence hardly ever indexed. No pair is lost by any of this.

Equal sets are one class from the start (64-bit content hash) and are never
compared. Signatures travel packed, 16 bytes each, by hash range. Classes with an
equal signature form a group; each group is first verified as a star around its
hub, the member that meets most others over all groups. After the connected
components of those links only pairs between different components are left to
look at: of all that met the same hub, those outside its largest component against all others, in bounded blocks, by
parity sketches: the sketches of two sets differ in at most as many bits as the sets in
elements, so a pair whose sketches differ in more than H bits is ruled out for
certain. Only pairs that pass are emitted, and verified as whole sets. So a large
group of near copies costs its size, not its square.

Defined results: null texts and texts without words have size 0, are linked with
nothing and are their own component; with fewer than ``n`` words the whole
sequence is the one element; rows with equal doc_id and equal sets are one document,
rows that repeat a doc_id (or null) with other sets are decided each by its own; a null
doc_id is a component label only if its component has no other; an empty table
gives an empty table; extra columns are ignored (``representatives`` keeps them).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.llm.common import discard, text_slices, written
from salesflow.llm.components import components
from salesflow.llm.textbytes import NOT_SPACE, mix, text_bytes, words

U = np.uint64
_STEP = mix(np.arange(1, 65, dtype=np.uint64)) | U(1)


def shingles(column: pa.Array, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit n-gram hashes of all rows, ordered by (row, hash), and the set size of each row."""
    data, offsets = text_bytes(column)
    w = words(data, offsets, NOT_SPACE)
    rows = len(w.count)
    first = np.cumsum(w.count) - w.count
    place = np.arange(len(w.hash)) - first[w.doc]
    left = w.count[w.doc] - place
    head = np.flatnonzero(left >= n)
    value = np.zeros(len(head), np.uint64)
    for j in range(n):
        value += w.hash[head + j] * _STEP[j]
    doc = w.doc[head]
    few = np.flatnonzero((w.count > 0) & (w.count < n))
    if len(few):
        tail = np.zeros(len(few), np.uint64)
        for j in range(n - 1):
            on = w.count[few] > j
            tail[on] += w.hash[first[few[on]] + j] * _STEP[j]
        value = np.r_[value, tail + w.count[few].astype(np.uint64) * _STEP[63]]
        doc = np.r_[doc, few]
    value = mix(value)
    order = np.lexsort((value, doc)) if rows >= 1 << 18 else _by_row(doc, value)
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[new], np.bincount(doc[new], minlength=rows)


def _by_row(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """argsort by (doc, value) with one sort of packed keys; falls back where the packed bits tie."""
    key = (doc.astype(np.uint64) << U(46)) | (value >> U(18))
    order = np.argsort(key)
    k, v = key[order], value[order]
    if ((k[1:] == k[:-1]) & (v[1:] < v[:-1])).any():
        return np.lexsort((value, doc))
    return order


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each row's values, modulo 2**64 (0 for empty rows)."""
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        out[some] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[some])
    return out


def class_ids(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit content hash of each set."""
    return mix(_sums(mix(values ^ _STEP[60]), sizes) + sizes.astype(np.uint64)).view(np.int64)


# ---------------------------------------------------------------- size bands and allocation

class Threshold:
    """Jaccard threshold num/den in whole numbers."""

    def __init__(self, num: int = 75, den: int = 100):
        self.num, self.den = num, den

    def largest(self, size):
        """The largest partner of a set."""
        return size * self.den // self.num

    def smallest(self, size):
        return -(-size * self.num // self.den)

    def differ(self, both):
        """The most elements in which two similar sets of ``both`` elements together differ."""
        return both * (self.den - self.num) // (self.den + self.num)


def _groups(sizes: np.ndarray, t: Threshold) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, rows in it, H of each): group 2k for pairs within band k, 2k + 1 for bands k and k + 1."""
    band = np.full(len(sizes), -1)
    some = sizes > 0
    band[some] = np.frexp(sizes[some].astype(float))[1] - 1
    up, down = t.largest(sizes), t.smallest(sizes)
    for k in np.unique(band[some]):
        lo, hi = 1 << int(k), (2 << int(k)) - 1
        here = np.flatnonzero(band == k)
        n = sizes[here]
        yield 2 * int(k), here, t.differ(n + np.minimum(up[here], hi))
        over = here[up[here] > hi]
        if len(over):
            yield 2 * int(k) + 1, over, t.differ(sizes[over] + up[over])
        under = here[down[here] < lo]
        if len(under):
            yield 2 * int(k) - 1, under, t.differ(sizes[under] + lo - 1)


@lru_cache(None)
def layout(group: int, num: int, den: int) -> tuple[int, float, int]:
    """(wide T = 1 segments, share of the universe of each, T = 0 segments) of least expected cost."""
    t, k = Threshold(num, den), group // 2
    lo, hi = 1 << k, (2 << k) - 1
    if group % 2:
        least, most = t.smallest(hi + 1), t.largest(hi)
        worst = t.differ(hi + most)
    else:
        least, most, worst = lo, hi, t.differ(2 * hi)
    mid = (least * most) ** 0.5
    need = t.differ(int(mid + min(t.largest(mid), most))) + 1
    best = None
    for wide in range(0, min(3, (worst + 1) // 2) + 1):
        share = min(6.0 / mid, 1.0 / wide if wide else 0.0)
        rest = 1 - wide * share
        narrow = max(worst + 1 - 2 * wide, round(mid / 1.75)) if rest > 1e-9 else 0
        want = need - 2 * wide
        if want > 0 and not narrow or worst + 1 - 2 * wide > narrow:
            continue
        g = mid * rest / narrow if narrow else 0.0
        good, single = narrow * (1 - np.exp(-g) * (1 + g)), narrow * g * np.exp(-g)
        singles = min(max(want - good, 0), single)
        empties = max(want - good - single, 0)
        cost = max(want, 0) + wide * (1 + mid * share) + 4 * singles + 16 * empties + 16 * wide * np.exp(-mid * share)
        if best is None or cost < best[0]:
            best = cost, wide, share, narrow
    return best[1:]


def signatures(values: np.ndarray, sizes: np.ndarray, common: np.ndarray, t: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """All index signatures of the sets: (signature, row). ``common``: a cost for each n-gram hash, by its top bits."""
    sig, row = [], []
    first = np.cumsum(sizes) - sizes
    element = mix(values + _STEP[61])
    dear = common[(values >> U(64 - (len(common) - 1).bit_length())).astype(np.int64)] if len(common) > 1 else np.zeros(len(values), np.uint8)
    for group, rows, differ in _groups(sizes, t):
        wide, share, narrow = layout(group, t.num, t.den)
        n = sizes[rows]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[rows], n)
        owner = np.repeat(np.arange(len(rows)), n)
        x = (mix(values[at] ^ _STEP[group % 50]) >> U(11)).astype(np.float64) / float(1 << 53)
        if wide:
            seg = np.where(x < wide * share, (x / share).astype(np.int64),
                           wide + ((x - wide * share) / max(1 - wide * share, 1e-12) * narrow).astype(np.int64))
            seg = np.minimum(seg, wide + max(narrow - 1, 0) if narrow else wide - 1)
        else:
            seg = np.minimum((x * narrow).astype(np.int64), narrow - 1)
        total = wide + narrow
        cell = owner * total + seg
        order = np.argsort(cell, kind="stable")
        cell, e = cell[order], element[at[order]]
        begin = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        size = np.diff(np.r_[begin, len(cell)])
        total_e = np.add.reduceat(e, begin)
        cost = np.minimum.reduceat(dear[at[order]], begin)
        c_owner, c_seg = cell[begin] // total, cell[begin] % total
        salt = mix(c_seg.astype(np.uint64) + U(group << 40) + U(1))
        s = mix(total_e ^ salt)
        if wide:
            w = np.flatnonzero(c_seg < wide)
            sig.append(s[w]), row.append(rows[c_owner[w]])
            member = np.repeat(np.arange(len(begin)), size)
            in_wide = c_seg[member] < wide
            sig.append(mix((total_e[member[in_wide]] - e[in_wide]) ^ salt[member[in_wide]]))
            row.append(rows[c_owner[member[in_wide]]])
            # a wide segment without elements is its empty subset
            filled = np.bincount(c_owner[w] * wide + c_seg[w], minlength=len(rows) * wide).reshape(-1, wide)
            i, j = np.nonzero(filled == 0)
            sig.append(mix(mix(j.astype(np.uint64) + U(group << 40) + U(1)))), row.append(rows[i])
        want = np.maximum(differ + 1 - 2 * wide, 0)
        if not narrow:
            continue
        pick = np.flatnonzero(c_seg >= wide)
        # ties end with the segment's number, which an equal subset has in common too
        key = ((c_owner[pick].astype(np.uint64) << U(36)) | (cost[pick].astype(np.uint64) << U(28))
               | ((255 - np.minimum(size[pick], 255)).astype(np.uint64) << U(20)) | (s[pick] >> U(44)))
        pick = pick[np.argsort(key, kind="stable")]
        have = np.bincount(c_owner[pick], minlength=len(rows))
        rank = np.arange(len(pick)) - (np.cumsum(have) - have)[c_owner[pick]]
        pick = pick[rank < want[c_owner[pick]]]
        sig.append(s[pick]), row.append(rows[c_owner[pick]])
        for i in np.flatnonzero(have < want):  # too few filled segments: empty ones come last, in order
            full = set(c_seg[(c_owner == i)].tolist())
            empty = [j for j in range(wide, total) if j not in full][:int(want[i] - have[i])]
            sig.append(mix(mix(np.array(empty, np.uint64) + U(group << 40) + U(1)))), row.append(np.full(len(empty), rows[i]))
    if not sig:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(sig), np.concatenate(row)


# ---------------------------------------------------------------- the join

BLOCK = 1 << 14  # sketch cells of a row
LIST = 4096  # classes of a signature in one row


def profile(docs: DataFrame, n: int, cells: int) -> DataFrame:
    """One row per document (doc_id, size, class) and, from each task, rows of its n-gram counts (block, counts)."""
    bits = (cells - 1).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.uint8)
        seen = False
        for batch in batches:
            for part in text_slices(batch, "text"):
                values, sizes = shingles(part.column("text"), n)
                at, more = np.unique(values >> U(64 - bits), return_counts=True)
                at = at.astype(np.int64)
                counts[at] = np.minimum(counts[at].astype(np.int64) + more, 255)  # a task's count stops at 255
                seen = True
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(class_ids(values, sizes), mask=sizes == 0),
                     pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())], ["doc_id", "size", "class", "block", "counts"])
        if seen:
            blocks = [i for i in range(max(1, cells // BLOCK)) if counts[i * BLOCK:(i + 1) * BLOCK].any()]
            for i in range(0, len(blocks), 64):
                some = blocks[i:i + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(some), docs_key), pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.int64()), pa.array(some, pa.int32()),
                     pa.array([zlib.compress(counts[b * BLOCK:(b + 1) * BLOCK].tobytes(), 1) for b in some])], ["doc_id", "size", "class", "block", "counts"])

    from pyspark.sql.pandas.types import to_arrow_type
    docs_key = to_arrow_type(docs.schema["doc_id"].dataType)
    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, size long, class long, block int, counts binary")


def commonness(rows: DataFrame, cells: int) -> np.ndarray:
    """How common each cell is over all documents, one byte a cell: half octaves above twice the mean count."""
    width = min(BLOCK, cells)
    floor = max(1.0, 2.0 * (rows.agg(F.sum("size")).first()[0] or 0) / cells)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, c in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total.setdefault(b, np.zeros(width, np.int64))[:] += np.frombuffer(zlib.decompress(c), np.uint8)
        if total:
            scaled = {b: np.minimum(2 * np.log2(np.maximum(c / floor, 1)), 255).astype(np.uint8).tobytes() for b, c in total.items()}
            yield pa.RecordBatch.from_arrays([pa.array(list(scaled), pa.int32()), pa.array(list(scaled.values()))], ["block", "counts"])

    out = np.zeros(cells, np.uint8)
    blocks = rows.where("block is not null").select("block", "counts")
    # one byte a cell: at most 64 MB, whatever the documents
    for b, c in blocks.repartition("block").mapInArrow(add, "block int, counts binary").collect():
        out[b * width:(b + 1) * width] = np.frombuffer(c, np.uint8)
    return out


def candidate_groups(docs: DataFrame, common: np.ndarray, n: int, t: Threshold, buckets: int, partitions: int) -> DataFrame:
    """(g, n, members): classes that share a signature, each set of them once (``g``, ``n`` of them), in lists of at most ``LIST``."""
    sketch = docs.sparkSession.sparkContext.broadcast(common)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, emitted = [], 0, set()

        def flush():
            sig = np.concatenate([h[0] for h in held])
            cls = np.concatenate([h[1] for h in held])
            bucket = (sig >> U(40)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            sig, cls, bucket = sig[order], cls[order], bucket[order]
            begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            end = np.r_[begin[1:], len(bucket)]
            for i in range(0, len(begin), 1024):
                b, e = begin[i:i + 1024], end[i:i + 1024]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[b].astype(np.int32)), pa.array([sig[x:y].tobytes() for x, y in zip(b, e, strict=True)], pa.binary()),
                     pa.array([cls[x:y].tobytes() for x, y in zip(b, e, strict=True)], pa.binary())], ["bucket", "sigs", "classes"])

        for batch in batches:
            for part in text_slices(batch, "text"):
                values, sizes = shingles(part.column("text"), n)
                ids = class_ids(values, sizes)
                keep = np.zeros(len(ids), bool)
                for i in np.flatnonzero(sizes):  # a class is indexed once by a task
                    if ids[i] not in emitted:
                        emitted.add(ids[i])
                        keep[i] = True
                values, ids, sizes = values[np.repeat(keep, sizes)], ids[keep], sizes[keep]
                sig, row = signatures(values, sizes, sketch.value, t)
                held.append((sig, ids[row]))
                size += len(sig)
                if size >= 1_000_000:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, classes = [], []
        for batch in batches:
            sigs += [np.frombuffer(x, np.uint64) for x in batch.column("sigs").to_pylist()]
            classes += [np.frombuffer(x, np.int64) for x in batch.column("classes").to_pylist()]
        if not sigs:
            return
        sig, cls = np.concatenate(sigs), np.concatenate(classes)
        del sigs, classes
        order = np.argsort(sig)
        same = sig[order]
        same = same[1:] == same[:-1]
        touched = np.zeros(len(sig), bool)
        touched[1:] = same
        touched[:-1] |= same
        order = order[touched]
        sig, cls = sig[order], cls[order]
        order = np.lexsort((cls, sig))
        sig, cls = sig[order], cls[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1])
        sig, cls = sig[new], cls[new]
        if not len(sig):
            return
        begin = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        size = np.diff(np.r_[begin, len(sig)])
        print_ = mix(np.add.reduceat(mix(cls.view(np.uint64)), begin) + size.astype(np.uint64))
        _, once = np.unique(print_, return_index=True)  # the same classes meet in many signatures
        once = once[size[once] > 1]
        # a common signature's classes are many rows, none of them large
        pieces = -(-size[once] // LIST)
        piece = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        once = np.repeat(once, pieces)
        for i in range(0, len(once), 1024):
            some, k = once[i:i + 1024], piece[i:i + 1024]
            low = begin[some] + k * LIST
            high = np.minimum(low + LIST, begin[some] + size[some])
            yield pa.RecordBatch.from_arrays(
                [pa.array(print_[some].view(np.int64)), pa.array(k.astype(np.int32)), pa.array(size[some]),
                 pa.array([cls[a:b] for a, b in zip(low, high, strict=True)], pa.list_(pa.int64()))], ["g", "piece", "n", "members"])

    packed = docs.select("text").mapInArrow(index, "bucket int, sigs binary, classes binary")
    groups = packed.repartition(partitions, "bucket").mapInArrow(meet, "g long, piece int, n long, members array<long>")
    return groups.dropDuplicates(["g", "piece"]).select("g", "n", "members")


def sketches(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Parity sketch of each set: bit (hash mod bits) flips with each element; 8 bits for an element, rounded to a power of two."""
    bits = np.maximum(64, 8 << (np.frexp(np.maximum(sizes, 1).astype(float))[1] - 1))
    end = np.cumsum(bits // 8)
    start = end - bits // 8
    out = np.zeros(int(end[-1]) if len(end) else 0, np.uint8)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = (mix(values ^ _STEP[59]) & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
    np.bitwise_xor.at(out, start[row] + (at >> 3), (1 << (at & 7)).astype(np.uint8))
    return [out[x:y].tobytes() for x, y in zip(start, end, strict=True)]


def _folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch of ``size`` bytes: halves are laid on each other, as positions modulo the smaller number would."""
    x = np.frombuffer(sketch, np.uint64)
    while len(x) * 8 > size:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def _possible(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray, t: Threshold) -> np.ndarray:
    """Whether sets with these sketches and sizes can be similar."""
    return ((np.bitwise_count(x ^ y).sum(-1, dtype=np.int64) <= t.differ(nx + ny))
            & (np.minimum(nx, ny) * t.den >= np.maximum(nx, ny) * t.num))


def _verified(pairs: DataFrame, sets: DataFrame, t: Threshold) -> DataFrame:
    """The pairs (u, v) whose whole sets are similar; most others are ruled out by their sketches."""
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            for i, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)):
                size = min(len(a), len(b))
                keep[i] = _possible(_folded(a, size), na[i], _folded(b, size), nb[i], t)
            yield batch.filter(pa.array(keep)).select(["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a = np.frombuffer(batch.column("a")[i].as_buffer(), np.uint64)
                b = np.frombuffer(batch.column("b")[i].as_buffer(), np.uint64)
                both = np.sort(np.concatenate((a, b)))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[i] = t.den * shared >= t.num * (len(both) - shared)
            yield batch.filter(pa.array(keep)).select(["u", "v"])

    side = lambda key, of, value, *more: of.select(F.col("class").alias(key), *more, F.col(value).alias("a" if key == "u" else "b"))
    close = (pairs.join(side("u", sets, "sketch", F.col("size").alias("na")), "u").join(side("v", sets, "sketch", F.col("size").alias("nb")), "v")
             .select("u", "v", "na", "nb", "a", "b").mapInArrow(near, "u long, v long"))
    close = written(close, "close")
    # few hubs stand in many pairs: only the sets that are needed on either side travel
    need = lambda key: sets.join(close.select(F.col(key).alias("class")).distinct(), "class", "left_semi")
    out = written(close.join(side("u", need("u"), "elements"), "u").join(side("v", need("v"), "elements"), "v").select("u", "v", "a", "b")
                  .mapInArrow(run, "u long, v long"), "links")
    discard(close)
    return out


def _open_pairs(tagged: DataFrame, sets: DataFrame, t: Threshold, partitions: int, block: int) -> DataFrame | None:
    """Pairs of classes that met one hub and lie in different components, unless their sketches rule them out; None without any.

    ``tagged``: (hub, class, root). Of a hub's components the largest is never compared with itself: the classes of
    the others are compared with its classes and with each other, so a group of n with one stray member
    costs n. Both kinds are cut into parts of about ``block`` and each task compares two parts (or one with itself).
    """
    by_root = tagged.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("n"))
    live = written(by_root.groupBy("hub").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("n"))
                   .where("n > most"), "live")
    if not live.head(1):
        discard(live)
        return None
    parts = lambda n: F.ceil(n / F.lit(block)).cast("int")
    rows = tagged.join(live, "hub").withColumn("large", F.col("root") == F.col("main"))
    rows = rows.withColumn("p", parts(F.col("most"))).withColumn("q", parts(F.col("n") - F.col("most")))
    rows = rows.withColumn("part", F.pmod(F.hash("class"), F.when(F.col("large"), F.col("p")).otherwise(F.col("q"))))
    # (i, j, large ones on the other side) of every task that a class takes part in
    place = lambda i, j, mixed: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(mixed).alias("mixed"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    small = F.concat(F.transform(every(F.col("p")), lambda k: place(F.col("part"), k, True)),
                     F.transform(every(F.col("q")), lambda k: place(F.least(F.col("part"), k), F.greatest(F.col("part"), k), False)))
    big = F.transform(every(F.col("q")), lambda k: place(k, F.col("part"), True))
    rows = rows.join(sets.select("class", "size", "sketch"), "class").withColumn("task", F.explode(F.when(F.col("large"), big).otherwise(small)))
    rows = rows.select("hub", "task.i", "task.j", "task.mixed", "large", "part", "class", "root", "size", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, found = None, [], []

        def compare():
            _, i, j, mixed = key
            size = min(len(r[5]) for r in held)
            x = np.array([_folded(r[5], size) for r in held])
            side, part, cls, root, n = (np.array([r[c] for r in held], np.int64) for c in range(5))
            if mixed:  # the fewer ones, one after the other, against all of the other side
                few = np.flatnonzero(side == 0)
                many = np.flatnonzero(side == 1)
                if len(few) > len(many):
                    few, many = many, few
                turns = [(k, many) for k in few]
            elif i == j:
                turns = [(k, np.arange(k + 1, len(held))) for k in range(len(held) - 1)]
            else:
                other = np.flatnonzero(part != i)
                turns = [(k, other) for k in np.flatnonzero(part == i)]
            for k, others in turns:
                hit = others[_possible(x[others], n[others], x[k], n[k], t) & (root[others] != root[k])]
                if len(hit):
                    found.append(np.column_stack([np.minimum(cls[hit], cls[k]), np.maximum(cls[hit], cls[k])]))

        def emit():
            pairs = np.unique(np.concatenate(found), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:4] != key:
                    if len(held) > 1:
                        compare()
                    key, held = row[:4], []
                    if sum(map(len, found)) > 200_000:
                        yield emit()
                        found.clear()
                held.append(row[4:])
        if len(held) > 1:
            compare()
        if found:
            yield emit()

    return rows.repartition(partitions, "hub", "i", "j", "mixed").sortWithinPartitions("hub", "i", "j", "mixed").mapInArrow(run, "u long, v long").distinct()


def _likely(docs: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The documents whose doc_id may be in ``keys`` (``left_anti``: those whose doc_id certainly isn't).

    A one-hash Bloom filter, 16 bits a key up to 2**24 in all; texts that it settles need
    not travel. It is a table of 64-bit words, at most 2**18 rows, which is what is broadcast.
    """
    bits = 1 << min(max((16 * keys.count()).bit_length(), 10), 24)
    at = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {bits}) % 64 as int))")
    word = F.shiftright(at, 6)
    words_ = keys.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    marked = docs.withColumn("__at", word).withColumn("__one", bit)
    return marked.join(F.broadcast(words_), (F.col("__at") == F.col("__word")) & (F.col("__bits").bitwiseAND(F.col("__one")) != 0),
                       how).drop("__at", "__one")


def _one_of_each(sets: DataFrame) -> DataFrame:
    """One row of every class; only the numbers of rows that repeat a class are looked up."""
    numbered = sets.withColumn("__row", F.monotonically_increasing_id())
    again = written(numbered.groupBy("class").agg(F.min("__row").alias("__keep"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
                    .select("class", "__keep"), "again")
    out = sets.drop("doc_id")
    if again.head(1):
        out = numbered.join(again, "class", "left").where("__keep is null or __keep = __row").drop("doc_id", "__row", "__keep")
        out = written(out, "sets")
        discard(sets)
    else:
        out._scratch_path = sets._scratch_path
    discard(again)
    return out


def similar_sets(docs: DataFrame, n: int = 5, **params) -> DataFrame:
    """(doc_id, size, component) of every document: the smallest doc_id reachable by links (``params``: of ``_labelled``)."""
    return _labelled(docs, n, **params).select("doc_id", "size", "component")


def _labelled(docs: DataFrame, n: int = 5, num: int = 75, den: int = 100, docs_per_bucket: int = 4096,
              cells: int | None = None, block: int = 2000) -> DataFrame:
    """(doc_id, size, class, component, kept) of every document; ``kept``: it stands for its component.

    Of a component that is the class with the smallest doc_id, and of its documents those with that doc_id.
    ``cells`` of the count sketch (a power of two; one byte each is broadcast)
    default to 16 for a document, between 2**16 and 2**26. ``block``: members of a
    group that one task compares.
    """
    spark, t = docs.sparkSession, Threshold(num, den)
    count = docs.count()
    cells = cells or 1 << min(max((16 * count).bit_length(), 16), 26)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // docs_per_bucket))
    buckets = partitions * max(1, min(16, 4096 // partitions))

    rows = written(profile(docs, n, cells), "profile")
    known = rows.where("block is null").select("doc_id", "size", "class")
    classes = written(known.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first"), F.min("size").alias("size")), "classes")
    groups = candidate_groups(docs, commonness(rows, cells), n, t, buckets, partitions)
    members = written(groups.select("g", "n", F.explode("members").alias("class")), "members")

    # whole sets of the classes that meet anywhere, taken from each class's first document
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                values, sizes = shingles(part.column("text"), n)
                end = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(class_ids(values, sizes)), pa.array(sizes.astype(np.int64)), pa.array(sketches(values, sizes), pa.binary()),
                     pa.array([values[e - k:e].tobytes() for e, k in zip(end, sizes, strict=True)], pa.binary())],
                    ["doc_id", "class", "size", "sketch", "elements"])

    met = members.groupBy("class").agg(F.sum("n").alias("meets"))
    met = written(met, "met")
    firsts = written(classes.join(met.select("class"), "class").select(F.col("first").alias("doc_id"), "class"), "firsts")
    # no text is shuffled: the filter lets some other documents through, whose sets nobody asks for, or which repeat a class
    likely = _likely(docs.select("doc_id", "text"), firsts)
    sets = written(likely.mapInArrow(whole, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, class long, size long, sketch binary, elements binary"), "sets")
    sets = _one_of_each(sets)
    discard(firsts)

    # each step's tables go as soon as the next ones are written
    hubs = members.join(met, "class").groupBy("g").agg(F.max_by("class", F.struct("meets", "class")).alias("hub"))
    star = written(members.join(hubs, "g").where("class <> hub").select("hub", "class").distinct(), "star")
    discard(members, met)
    links = _verified(star.select(F.col("hub").alias("u"), F.col("class").alias("v")), sets, t)
    roots = written(components(links), "roots")

    # what the stars left open: pairs that met the same hub and are not connected yet
    tagged = written(star.join(roots, F.col("class") == F.col("node"), "left").select("hub", "class", F.coalesce("root", "class").alias("root")), "tagged")
    discard(star)
    open_ = _open_pairs(tagged, sets, t, partitions, block)
    linked = roots
    if open_ is not None:
        open_ = written(open_, "open")
        late = _verified(open_, sets, t) if open_.head(1) else open_
        if late.head(1):
            linked = written(components(links.union(late)), "roots")
    discard(tagged, sets)

    label = (classes.join(linked, F.col("class") == F.col("node"), "left")
             .select("class", "first", F.coalesce("root", "class").alias("root")))
    label = written(label, "labels")
    smallest = written(label.groupBy("root").agg(F.min("first").alias("component"), F.min_by(
        "class", F.struct(F.col("first").isNull(), F.col("first"), F.col("class"))).alias("chosen")), "smallest")
    by_class = written(label.join(smallest, "root").select("class", "component", (F.col("class") == F.col("chosen")).alias("chosen")), "components")
    out = (known.where("class is not null").join(by_class, "class", "left")
           .select("doc_id", "size", "class", "component", (F.col("chosen") & F.col("doc_id").eqNullSafe(F.col("component"))).alias("kept")))
    return out.union(known.where("class is null").select("doc_id", "size", "class", F.col("doc_id").alias("component"), F.lit(True).alias("kept")))


def _with_class(docs: DataFrame, n: int) -> DataFrame:
    """All columns and ``__class``, the class of the row's own text (null without words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                values, sizes = shingles(part.column("text"), n)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(class_ids(values, sizes), mask=sizes == 0)], [*part.schema.names, "__class"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__class", T.LongType())]))


def representatives(docs: DataFrame, n: int = 5, **params) -> DataFrame:
    """The first document (smallest doc_id) of each component, all columns kept; one row of equal doc_id and equal set."""
    by_row = _labelled(docs, n, **params).groupBy("doc_id", "class").agg(F.count(F.lit(1)).alias("n"), F.bool_or("kept").alias("__keep"))
    # most documents stay as they are; only removed and repeated ones are looked up
    special = written(by_row.where("n > 1 or not __keep").select("doc_id", "class", "__keep"), "special")
    known = special.withColumnsRenamed({"doc_id": "__id", "class": "__of"})
    looked_up = (_with_class(_likely(docs, special), n)
                 .join(known, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("__class").eqNullSafe(F.col("__of")), "left")
                 .where("__keep is null or __keep").drop("__id", "__of"))
    looked_up = written(looked_up, "looked_up")
    repeated = looked_up.where("__keep").dropDuplicates(["doc_id", "__class"])
    return (_likely(docs, special, "left_anti").unionByName(looked_up.where("__keep is null").drop("__keep", "__class"))
            .unionByName(repeated.drop("__keep", "__class")))

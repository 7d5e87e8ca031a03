"""Remove byte strings that occur earlier in the corpus, with a logarithmic family of suffix arrays.

A byte is removed when a ``length``-byte string over it also starts earlier (an earlier document,
or an earlier place of the same one). Documents come in batches; each batch gets a suffix array,
which is merge-scanned against the arrays of all earlier batches (the levels of the family), and
levels that stand for equally many batches are merged into one, so ``n`` batches keep at most
``log2 n + 1`` levels and every suffix is merged ``log2 n`` times.

The arrays are sparse. ``GRAM``-byte grams are hashed, and each ``length``-byte window is filed
under the leftmost smallest gram in it: equal windows are filed under equal grams at equal places.
Consecutive windows under one gram make a *run*, one entry of about 45 bytes of text; its suffix is named by
two 64-bit fingerprints, of its gram and of its whole stretch (as prefix doubling names prefixes
by ranks). Arrays are sorted by these names: order among names means nothing, but equal gram, then equal
stretch lie side by side, which is all that a merge scan needs.

* Runs of equal name hold equal windows; all but the earliest repeat it and leave the family.
* Runs of one gram with different stretches may share some windows (the ends of a long match).
  Their stretches, read from the texts again, are compared: all their windows are sorted, and neighbours of one name
  byte for byte.

Partitions of a level are ranges of (gram, stretch): a gram that a third of all documents hold is spread over many tasks. A gram at the
edge of a partition counts as shared. Stretches of a gram with over ``TOGETHER`` of them are compared in parts, and the
earliest windows of the parts brought together, one row for each part. Copies are dropped inside each task before they are shuffled.
Nothing is collected but counts by partition.

Defined results: a null or empty text has no bytes and loses none; documents are ordered by doc_id
(null first), then by a hash of the text, so repeated ids and rows each have their place; texts
shorter than ``length`` are kept whole; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import discard, give_back, text_slices, written
from salesflow.llm.textbytes import mix, text_bytes

LENGTH = 100
#: bytes of a gram; every window holds ``length - GRAM + 1`` of them
GRAM = 16
#: bytes looked at together; the place of a gram in them fits the low bits of its key
CHUNK = 1 << 18
_PLACE = np.uint64(CHUNK * 4 - 1)
_BYTE = np.random.default_rng(20_261_203).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit polynomial hashes of all ``length``-byte windows, by doubling."""
    part, size, power = _BYTE[data], 1, _BASE
    out, done, bits = None, 0, length
    while True:
        if bits & 1:
            if out is None:
                out, done = part, size
            else:
                n = max(len(data) - done - size + 1, 0)
                out, done = out[:n] * power + part[done:done + n], done + size
        bits >>= 1
        if not bits:
            return out if len(data) >= length else out[:0]
        n = max(len(part) - size, 0)
        part = part[:n] * power + part[size:size + n]
        size, power = 2 * size, power * power


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    out, size = x, 1
    while 2 * size <= width:
        out, size = np.minimum(out[:-size], out[size:]), 2 * size
    return np.minimum(out[:len(out) - (width - size)], out[width - size:]) if size < width else out


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """(row, first window, windows, gram, stretch) of every run of the texts in one buffer."""
    found = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2]
    with np.errstate(over="ignore"):
        for low in range(0, max(len(data) - length + 1, 0), CHUNK):
            part = data[low:low + CHUNK + length - 1]
            n = len(part) - length + 1
            gram = mix(window_hashes(part, GRAM))
            key = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
            home = (sliding_min(key, length - GRAM + 1) & _PLACE).astype(np.int64)
            row = np.searchsorted(offsets, low + np.arange(n), "right") - 1
            start = np.flatnonzero(np.r_[True, (home[1:] != home[:-1]) | (row[1:] != row[:-1])])
            place = start + low
            # windows that go beyond their text are none
            count = np.minimum(np.r_[start[1:], n] + low, offsets[row[start] + 1] - length + 1) - place
            real = count > 0
            start, place, count = start[real], place[real], count[real]
            whole = window_hashes(part, length)
            stretch = mix(mix(whole[start]) + whole[start + count - 1] * np.uint64(3) + count.astype(np.uint64))
            found.append([row[start], place - offsets[row[start]], count, gram[home[start]], stretch])
    return [np.concatenate(c) for c in zip(*found, strict=True)]


def ordered_texts(docs: DataFrame) -> DataFrame:
    """(ord, doc_id, text) in document order, written; ``ord`` holds the partition above bit 33."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(base + np.arange(b.num_rows, dtype=np.int64)), b.column(0), b.column(1)],
                                             ["ord", "doc_id", "text"])
            base += b.num_rows

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("_row")]
    rows = docs.select("doc_id", text.alias("text"), F.monotonically_increasing_id().alias("_row"))
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    return written(rows.mapInArrow(number, f"ord long, doc_id {kind}, text string"), "repeats-texts")


_ENTRY = "gram long, stretch long, ord long, at int, n int, shared boolean"
_NAMES = ["gram", "stretch", "ord", "at", "n", "shared"]


def _entries(columns) -> pa.RecordBatch:
    gram, stretch, order, at, n, shared = columns
    return pa.RecordBatch.from_arrays(
        [pa.array(gram.view(np.int64)), pa.array(stretch.view(np.int64)), pa.array(order), pa.array(at.astype(np.int32)),
         pa.array(n.astype(np.int32)), pa.array(shared)], _NAMES)


def suffixes(texts: DataFrame, length: int = LENGTH, hold: int = 1 << 18) -> DataFrame:
    """The entries of a batch, earliest copies only within every ``hold`` entries of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            order, at, n, gram, stretch = (np.concatenate(c) for c in zip(*held, strict=True))
            by = np.lexsort((at, order, stretch, gram))
            g, s = gram[by], stretch[by]
            first = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (s[1:] != s[:-1])]) if len(by) else by
            by = by[first]
            for i in range(0, len(by), 1 << 15):
                k = by[i:i + (1 << 15)]
                yield _entries([gram[k], stretch[k], order[k], at[k], n[k], np.zeros(len(k), bool)])

        for batch in batches:
            for part in text_slices(batch, "text"):
                order = part.column("ord").to_numpy()
                row, at, n, gram, stretch = runs(*text_bytes(part.column("text")), length)
                held.append([order[row], at, n, gram, stretch])
                size += len(row)
                if size >= hold:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    return texts.select("ord", "text").mapInArrow(run, _ENTRY)


def merge_scan(entries: DataFrame) -> DataFrame:
    """One entry for each name, the earliest; ``shared`` marks those whose gram has another stretch (or may have, at an edge)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the latest distinct entry: its gram may go on in the next batch
        edge = True
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, stretch, order, at, n = (batch.column(i).to_numpy() for i in range(5))
            cols = [gram, stretch, order, at, n, np.zeros(len(gram), bool)]
            if last is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(last, cols, strict=True)]
            gram, stretch = cols[0], cols[1]
            keep = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (stretch[1:] != stretch[:-1])])
            cols = [c[keep] for c in cols]
            gram, shared = cols[0], cols[5].copy()
            same = gram[1:] == gram[:-1]
            shared[1:] |= same
            shared[:-1] |= same
            shared |= (gram == gram[0]) & edge  # the first gram of the partition may go on before it
            edge = edge and bool((gram == gram[0]).all())
            cols[5] = shared
            last = [c[-1:] for c in cols]
            if len(gram) > 1:
                yield _entries([c[:-1] for c in cols])
        if last is not None:
            last[5] = np.ones(1, bool)  # it may go on in the next partition
            yield _entries(last)

    return (entries.repartitionByRange("gram", "stretch").sortWithinPartitions("gram", "stretch", "ord", "at")
            .mapInArrow(run, _ENTRY))


class SuffixFamily:
    """Levels of suffix arrays: ``(batches, entries, first ord)`` from the largest to the smallest."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.levels: list[tuple[int, DataFrame, int]] = []

    def add(self, texts: DataFrame, first_ord: int) -> None:
        """Scan a batch (later than all before) against every level; merge it with levels of its size."""
        size, at, merged = 1, first_ord, []
        while self.levels and self.levels[-1][0] == size:
            count, table, at = self.levels.pop()
            size += count
            merged.append(table)
        own = rows = written(suffixes(texts, self.length), "repeats-batch")  # one scan of the texts, though ranges are sampled
        for table in [*merged, *(t for _, t, _ in self.levels)]:
            rows = rows.unionByName(table)
        # entries of larger levels only show what is known already; theirs are the earlier ords
        kept = merge_scan(rows).where(F.col("ord") >= at)
        self.levels.append((size, written(kept, "repeats-level"), at))
        discard(own, *merged)

    def entries(self) -> DataFrame:
        """All entries as one level."""
        if len(self.levels) > 1:
            rows = self.levels[0][1]
            for _, t, _ in self.levels[1:]:
                rows = rows.unionByName(t)
            merged = written(merge_scan(rows), "repeats-level")
            discard(*(t for _, t, _ in self.levels))
            self.levels = [(sum(n for n, _, _ in self.levels), merged, self.levels[0][2])]
        return self.levels[0][1]


#: stretches of one gram that are compared in one task; those of a commoner gram are dealt to several
TOGETHER = 8192


def _stretches(texts: DataFrame, entries: DataFrame, length: int) -> DataFrame:
    """(gram, part, ord, at, bytes): every shared entry's stretch, read from its text; ``part`` is -1 but for a split gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                raw = data.tobytes()
                spots = part.column("spots")
                inner = spots.flatten()
                gram, piece, at, n = (inner.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                row = np.repeat(np.arange(len(spots)), spots.value_lengths().to_numpy())
                low = offsets[:-1][row] + at
                high = (low + n + length - 1).tolist()
                low, order = low.tolist(), part.column("ord").to_numpy()[row]
                for i in range(0, len(low), 1 << 13):
                    j = slice(i, i + (1 << 13))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gram[j]), pa.array(piece[j]), pa.array(order[j]), pa.array(at[j]),
                         pa.array([raw[a:b] for a, b in zip(low[j], high[j], strict=True)], pa.binary())], names)

    names = ["gram", "part", "ord", "at", "bytes"]
    shared = entries.where("shared").select("gram", "stretch", "ord", "at", "n")
    common = shared.groupBy("gram").agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > TOGETHER)
    part = F.when(F.col("count").isNull(), -1).otherwise(F.pmod(F.xxhash64("stretch"), F.ceil(F.col("count") / TOGETHER))).cast("int")
    spots = shared.join(common, "gram", "left").groupBy("ord").agg(F.collect_list(F.struct("gram", part.alias("part"), "at", "n")).alias("spots"))
    return texts.select("ord", "text").join(spots, "ord").mapInArrow(run, "gram long, part int, ord long, at int, bytes binary")


def equal_windows(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows' order by content (equal ones as given) and whether each equals, byte for byte, the one before it."""
    with np.errstate(over="ignore"):
        name = window_hashes(data, length)[starts]
    by = np.argsort(name, kind="stable")
    again = np.flatnonzero(name[by[1:]] == name[by[:-1]]) + 1
    reach = np.arange(length)
    for i in range(0, len(again), 1 << 14):
        k = again[i:i + (1 << 14)]
        if (data[starts[by[k]][:, None] + reach] != data[starts[by[k - 1]][:, None] + reach]).any():
            # two contents of one name: order by the bytes themselves
            rows = np.ascontiguousarray(data[starts[:, None] + reach]).view(f"V{length}").ravel()
            name = np.unique(rows, return_inverse=True)[1]
            by = np.argsort(name, kind="stable")
            again = np.flatnonzero(name[by[1:]] == name[by[:-1]]) + 1
            break
    same = np.zeros(len(by), bool)
    same[again] = True
    return by, same


def _repeated_windows(stretches: DataFrame, length: int) -> DataFrame:
    """(ord, at, n) of windows of shared entries that occur earlier, and (name, ord, at) of windows still open.

    A gram of at most ``TOGETHER`` stretches is settled in one task. Of a commoner one each part settles its own windows and
    hands on its earliest of each: those rows, one for each part and window, are compared in a second step.
    """
    names = ["ord", "at", "n", "low", "high"]

    def windows(order, at, n, low, high):
        none = pa.nulls(len(order), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(order), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)),
             none if low is None else pa.array(low.view(np.int64)), none if high is None else pa.array(high.view(np.int64))], names)

    def settle(gram, part, order, at, blobs):
        first_of = np.lexsort((at, order))
        part, order, at, blobs = part[first_of], order[first_of], at[first_of], [blobs[i] for i in first_of.tolist()]
        data = np.frombuffer(b"".join(blobs), np.uint8)
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
        first, count = np.cumsum(sizes) - sizes, sizes - length + 1
        which = np.repeat(np.arange(len(blobs)), count)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        starts = first[which] + inside
        # windows of equal bytes are filed under equal grams, so bytes alone decide
        by, again = equal_windows(data, starts, length)
        later = np.zeros(len(by), bool)
        later[by] = again
        k = np.flatnonzero(later)
        if len(k):  # neighbouring windows of one entry as one row
            new = np.flatnonzero(np.r_[True, (which[k[1:]] != which[k[:-1]]) | (inside[k[1:]] != inside[k[:-1]] + 1)])
            s = k[new]
            yield windows(order[which[s]], at[which[s]] + inside[s], np.diff(np.r_[new, len(k)]), None, None)
        k = np.flatnonzero(~later & (part[which] >= 0))
        if len(k):
            with np.errstate(over="ignore"):
                low, high = window_hashes(data, length)[starts[k]], mix(window_hashes(data[::-1], length)[::-1][starts[k]])
            yield windows(order[which[k]], at[which[k]] + inside[k], np.ones(len(k), np.int64), low, high)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append([*(batch.column(i).to_numpy() for i in range(4)), batch.column(4).to_pylist()])
            size += batch.num_rows
            if size < 1 << 12:
                continue
            whole = [np.concatenate([r[i] for r in held]) for i in range(4)] + [[b for r in held for b in r[4]]]
            gram, part = whole[0], whole[1]
            # the last group may go on; a group is a gram, or a part of one
            cut = int(np.flatnonzero((gram != gram[-1]) | (part != part[-1]))[-1]) + 1 if (gram[0], part[0]) != (gram[-1], part[-1]) else 0
            if cut:
                yield from settle(*(c[:cut] for c in whole))
            held, size = [[c[cut:] for c in whole]], size - cut
        if size:
            yield from settle(*(np.concatenate([r[i] for r in held]) for i in range(4)), [b for r in held for b in r[4]])
        give_back()

    rows = stretches.repartition("gram", "part").sortWithinPartitions("gram", "part")
    return rows.mapInArrow(run, "ord long, at int, n int, low long, high long")


def repeated(texts: DataFrame, entries: DataFrame, length: int = LENGTH) -> DataFrame:
    """(ord, at, n): windows of shared entries whose bytes occur earlier."""
    stretches = _stretches(texts, entries, length)
    found = written(_repeated_windows(stretches, length), "repeats-windows")
    window = found.where("low is not null")
    firsts = window.groupBy("low", "high").agg(F.min(F.struct("ord", "at")).alias("first"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    later = window.join(firsts, ["low", "high"]).where(F.struct("ord", "at") != F.col("first")).select("ord", "at", "n")
    return found.where("low is null").select("ord", "at", "n").unionByName(later)


def remove_repeats(docs: DataFrame, length: int = LENGTH, batches: int = 4) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (first byte and end of every removed run), kept (binary), for each row of ``docs``."""
    texts = ordered_texts(docs)
    family = SuffixFamily(length)
    # rows of each partition: as many values as partitions
    sizes = sorted((r[0], r[1]) for r in texts.groupBy(F.shiftright("ord", 33)).count().collect())
    total = sum(n for _, n in sizes)
    cuts = [_place_of(sizes, total * b // batches) for b in range(batches)] if total else []
    cuts = sorted({c for c in cuts if c is not None})
    key = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {key}, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
    if not cuts:
        return texts.sparkSession.createDataFrame([], shape)
    for low, high in zip(cuts, [*cuts[1:], None], strict=True):
        batch = texts.where(F.col("ord") >= low)
        family.add(batch if high is None else batch.where(F.col("ord") < high), low)
    entries = family.entries()
    fresh = entries.select("ord", "at", "n", F.lit(True).alias("fresh"))
    again = repeated(texts, entries, length).withColumn("fresh", F.lit(False))
    marks = fresh.unionByName(again).groupBy("ord").agg(F.collect_list(F.struct("at", "n", "fresh")).alias("marks"))
    return texts.join(marks, "ord", "left").select("doc_id", "text", "marks").mapInArrow(lambda b: _cut(b, length), shape)


def _place_of(sizes: list[tuple[int, int]], row: int) -> int | None:
    for part, n in sizes:
        if row < n:
            return (part << 33) + row
        row -= n
    return None


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Keep the bytes outside all repeated windows: those neither fresh nor, among the fresh, found earlier."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        for part in text_slices(batch, "text"):
            data, offsets = text_bytes(part.column("text"))
            marks = part.column("marks")
            inner = marks.flatten()
            at, n = inner.field(0).to_numpy(zero_copy_only=False).astype(np.int64), inner.field(1).to_numpy(zero_copy_only=False).astype(np.int64)
            fresh = inner.field(2).to_numpy(zero_copy_only=False).astype(bool)
            counts = np.nan_to_num(marks.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            row = np.repeat(np.arange(len(marks)), counts)
            low = offsets[:-1][row] + at
            step = np.zeros(len(data) + 2, np.int32)  # windows that stay: fresh ones without those found earlier
            for which, sign in ((fresh, 1), (~fresh, -1)):
                np.add.at(step, low[which], sign)
                np.add.at(step, (low + n)[which], -sign)
            stays = np.cumsum(step[:len(data)]) > 0
            # windows that exist: all starts but the last length - 1 of every text
            exists = np.zeros(len(data) + 2, np.int32)
            size = np.diff(offsets)
            some = size >= length
            np.add.at(exists, offsets[:-1][some], 1)
            np.add.at(exists, offsets[1:][some] - length + 1, -1)
            gone = (np.cumsum(exists[:len(data)]) > 0) & ~stays
            starts = np.flatnonzero(gone)  # a repeated window covers its bytes
            cover = np.zeros(len(data) + length + 1, np.int32)
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + length, -1)
            removed = np.cumsum(cover[:len(data)]) > 0
            first = removed & ~np.r_[False, removed[:-1]]
            inner_first = offsets[:-1][size > 0]
            first[inner_first] = removed[inner_first]
            last = removed & ~np.r_[removed[1:], False]
            ends = offsets[1:][size > 0] - 1
            last[ends] = removed[ends]
            s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
            of = np.searchsorted(offsets, s, "right") - 1
            lengths = np.bincount(of, minlength=len(size)) if len(of) else np.zeros(len(size), np.int64)
            inner = pa.StructArray.from_arrays([pa.array(s - offsets[of]), pa.array(e - offsets[of])], fields=list(span))
            spans = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), inner)
            lost = np.add.reduceat(np.r_[removed, False].astype(np.int64), offsets[:-1]) * (size > 0) if len(size) else size
            kept = [data[a:b][~removed[a:b]].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(size), pa.array(lost), spans, pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"])


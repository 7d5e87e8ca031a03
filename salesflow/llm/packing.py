"""Tokenise documents and pack them into fixed-length sequences at balanced attention cost.

A document's ids (with its end id) are cut into pieces of ``seq_len``; each full
piece is a sequence of its own. The rests (shorter than ``seq_len``, one per
document at most) are packed block by block: a block gets ``ceil(tokens /
seq_len)`` sequences, its rests are taken in descending estimated cost
``linear * n + quadratic * n * n`` and each goes to the sequence of the lowest
cost so far that has room. A rest that no sequence can hold whole is cut over the
roomiest ones, so a block's padding stays under one sequence.

Blocks are dealt round-robin over all documents, ``docs_per_block`` rows each: a
task holds that many rests (under ``seq_len`` 2-byte ids each) and no more,
whatever the keys look like. Nothing is collected to the driver.

Tokenising keeps the ids of whole white-space separated words. The tokenizer
drops white space before it merges, so a text's ids are its words' ids in order: the different words of a slice
of texts are looked up together and only new ones are encoded.
Words of plain letters and ASCII marks go straight to the vocabulary's merge
model, all others through the whole tokenizer.

Defined results: a null or empty text is its end id alone (one piece of length
1); repeated rows are packed each by itself; an empty table gives an empty table;
extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from salesflow.llm.common import text_slices
from salesflow.llm.textbytes import text_bytes, words

PIECES = ("doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, cost double")


class WordTokenizer:
    """ids of texts by words.

    The ids of words already met are kept in arrays, sorted by the words' hashes, so the words of a whole slice of
    texts are looked up at once. A word of up to 16 bytes is compared byte for byte (its first and last eight, and
    its length); longer ones are kept by their text.
    """

    #: words in each of the two generations of the arrays
    KEEP = 1_000_000
    #: long words kept by their text
    KEEP_LONG = 20_000
    # letters and ASCII that normalising only lower-cases (no composition, no special casing)
    SIMPLE = re.compile("[!-~ªµºÀ-ÖØ-öø-ÿ]+")
    # the vocabulary's word pattern over those characters
    WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9]|[^a-zªµºß-öø-ÿ0-9]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.tokenize = self.tokenizer.model.tokenize
        specials = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(specials) or "(?!)")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.byte_chars = {**{b: b for b in shown}, **{b: 256 + i for i, b in enumerate(hidden)}}
        # the newest words, merged into the young ones now and then; those of the generation before
        self.fresh, self.young, self.old = _Words.none(), _Words.none(), _Words.none()
        self.long: dict[bytes, np.ndarray] = {}

    def encode(self, word: str) -> list[int]:
        if not self.SIMPLE.fullmatch(word) or self.special.search(word):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        low = word.lower()  # stays within SIMPLE
        out = []
        for w in (low,) if low.isalpha() else self.WORD.findall(low):
            chars = w if w.isascii() else w.encode().decode("latin-1").translate(self.byte_chars)
            out += [t.id for t in self.tokenize(chars)]
        return out

    def _long(self, word: bytes) -> np.ndarray:
        if (got := self.long.get(word)) is None:
            got = np.array(self.encode(word.decode()), np.uint16)
            if len(self.long) >= self.KEEP_LONG:
                self.long.clear()
            if len(word) <= 256:
                self.long[word] = got
        return got

    def tokens(self, text: str) -> bytes:
        """A text's ids as little-endian 16-bit numbers."""
        return self.ids(*text_bytes(pa.array([text])))[0].astype("<u2").tobytes()

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one buffer, and how many each text has."""
        w = words(data, offsets, NOT_BREAK, fold=False)
        if not len(w.start):
            return np.zeros(0, np.uint16), np.zeros(len(offsets) - 1, np.int64)
        head, tail = _ends(data, w.start, w.length)
        kinds, first, kind = np.unique(w.hash, return_index=True, return_inverse=True)
        if ((head != head[first][kind]) | (tail != tail[first][kind]) | (w.length != w.length[first][kind])).any():
            kind_of = {}  # two words of one hash: number the words themselves
            kind = np.array([kind_of.setdefault(data[a:a + k].tobytes(), len(kind_of)) for a, k in zip(w.start, w.length, strict=True)])
            first = np.unique(kind, return_index=True)[1]
            kinds = w.hash[first]
        size = w.length[first]
        short = np.flatnonzero(size <= 16)
        found = self._known(kinds[short], head[first[short]], tail[first[short]], size[short], data, w.start[first[short]])
        # one array of ids for all kinds: those of short words, then those of long ones
        count = np.zeros(len(kinds), np.int64)
        at = np.zeros(len(kinds), np.int64)
        count[short], at[short], ids = found
        pieces, end = [ids], len(ids)
        for i in np.flatnonzero(size > 16).tolist():
            got = self._long(data[w.start[first[i]]:w.start[first[i]] + size[i]].tobytes())
            pieces.append(got)
            at[i], count[i] = end, len(got)
            end += len(got)
        ids = np.concatenate(pieces)
        n = count[kind]
        out = ids[np.arange(int(n.sum())) + np.repeat(at[kind] - (np.cumsum(n) - n), n)]
        return out, np.bincount(w.doc, weights=n, minlength=len(offsets) - 1).astype(np.int64)

    def _known(self, kinds, head, tail, size, data, start) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of ids, place of the first, ids) of different short words; new ones are encoded and kept."""
        key = (kinds, head, tail, size)
        pick = lambda of: tuple(c[of] for c in key)
        known = self.young.find(*key)
        away = np.flatnonzero(known < 0)
        late = self.fresh.find(*pick(away))
        missing = away[late < 0]
        if len(missing):
            there = self.old.find(*pick(missing))
            back, new = missing[there >= 0], missing[there < 0]
            raw = data.tobytes() if len(new) else b""
            coded = [self.encode(raw[a:a + k].decode()) for a, k in zip(start[new].tolist(), size[new].tolist(), strict=True)]
            lengths = np.fromiter(map(len, coded), np.int64, len(coded))
            coded = np.fromiter(chain.from_iterable(coded), np.uint16, int(lengths.sum()))
            old_ids, old_count = self.old.ids_of(there[there >= 0])
            self.fresh = self.fresh.merged(_Words(*pick(np.r_[back, new]), np.r_[old_count, lengths], np.r_[old_ids, coded]))
            late = self.fresh.find(*pick(away))
        count, at = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
        here = np.flatnonzero(known >= 0)
        count[here], at[here] = self.young.count[known[here]], self.young.at[known[here]]
        count[away], at[away] = self.fresh.count[late], self.fresh.at[late] + len(self.young.ids)
        ids = np.r_[self.young.ids, self.fresh.ids]
        if len(self.fresh.hash) > max(len(self.young.hash) // 8, min(1 << 15, self.KEEP // 8)):  # few large merges
            if len(self.young.hash) + len(self.fresh.hash) > self.KEEP:
                self.old, self.young = self.young, _Words.none()
            self.young, self.fresh = self.young.merged(self.fresh), _Words.none()
        return count, at, ids


class _Words:
    """Words of up to 16 bytes sorted by hash, with their ids one after the other in ``ids``."""

    def __init__(self, hash_, head, tail, size, count, ids, at=None):
        by = np.argsort(hash_, kind="stable")
        at = np.cumsum(count) - count if at is None else at
        self.hash, self.head, self.tail, self.size = hash_[by], head[by], tail[by], size[by].astype(np.uint8)
        self.count, self.at, self.ids = count[by].astype(np.int32), at[by].astype(np.int32), ids

    @staticmethod
    def none() -> _Words:
        u, i = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return _Words(u, u, u, i, i, np.zeros(0, np.uint16))

    def find(self, hash_, head, tail, size) -> np.ndarray:
        """The place of each word, -1 for an unknown one."""
        if not len(self.hash):
            return np.full(len(hash_), -1)
        i = np.searchsorted(self.hash, hash_)
        last = len(self.hash) - 1
        out = np.full(len(hash_), -1)
        open_ = np.arange(len(hash_))
        while len(open_):  # words of one hash follow each other
            j = np.minimum(i[open_], last)
            same = (i[open_] <= last) & (self.hash[j] == hash_[open_])
            hit = same & (self.head[j] == head[open_]) & (self.tail[j] == tail[open_]) & (self.size[j] == size[open_])
            out[open_[hit]] = j[hit]
            open_ = open_[same & ~hit]
            i[open_] += 1
        return out

    def ids_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.count[places].astype(np.int64)
        return self.ids[np.arange(int(n.sum())) + np.repeat(self.at[places] - (np.cumsum(n) - n), n)], n

    def merged(self, more: _Words) -> _Words:
        return _Words(np.r_[self.hash, more.hash], np.r_[self.head, more.head], np.r_[self.tail, more.tail], np.r_[self.size, more.size],
                      np.r_[self.count, more.count], np.r_[self.ids, more.ids], np.r_[self.at, more.at + len(self.ids)])


#: bytes of words: all but the blank, tab and line ends, which the tokenizer drops
NOT_BREAK = np.ones(256, bool)
NOT_BREAK[[0x20, 0x09, 0x0A, 0x0D]] = False


def _ends(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last eight bytes of each word as numbers (shorter words padded with zeros)."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    short = np.minimum(length, 8)
    mask = (np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - short).astype(np.uint64) * np.uint64(8)))
    head = np.ascontiguousarray(eight[start]).view("<u8").ravel() & mask
    tail = np.ascontiguousarray(eight[start + length - short]).view("<u8").ravel() & mask
    return head, tail


_LOADED: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per Python worker; its words live on between tasks."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def _crc(ids16: np.ndarray) -> int:
    return zlib.crc32(ids16.astype("<u4").tobytes())


def tokenize(docs: DataFrame, vocabulary: str, seq_len: int = 2048, end_id: int = 1) -> DataFrame:
    """doc_id, n (tokens with the end id), full (crc32 of each full piece), tail (16-bit ids of the rest)."""
    end = np.array([end_id], np.uint16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokenizer(vocabulary)
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, count = tok.ids(*text_bytes(part.column("text")))
                n, full, tail = [], [], []
                for to, k in zip(np.cumsum(count).tolist(), count.tolist(), strict=True):
                    own = np.r_[ids[to - k:to], end]
                    k = len(own) // seq_len
                    n.append(len(own))
                    full.append([_crc(own[i * seq_len:(i + 1) * seq_len]) for i in range(k)])
                    tail.append(own[k * seq_len:].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(full, pa.list_(pa.int64())),
                     pa.array(tail, pa.binary())], ["doc_id", "n", "full", "tail"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, n long, full array<long>, tail binary")


def assign(lengths: np.ndarray, seq_len: int, linear: float, quadratic: float) -> list[list[tuple[int, int, int]]]:
    """Pack rests; per rest its (sequence, start, length) pieces. Ties go to the earlier rest and sequence."""
    total = int(lengths.sum())
    count = -(-total // seq_len)
    room = np.full(count, seq_len, np.int64)
    cost = np.zeros(count)
    price = linear * lengths + quadratic * lengths.astype(float) ** 2
    out: list[list[tuple[int, int, int]]] = [[] for _ in lengths]

    def put(i, seq, start, length):
        out[i].append((seq, start, length))
        room[seq] -= length
        cost[seq] += linear * length + quadratic * float(length) ** 2

    for i in np.lexsort((np.arange(len(lengths)), -price)):
        length, start = int(lengths[i]), 0
        if not length:
            continue
        fits = np.where(room >= length, cost, np.inf)
        s = int(np.argmin(fits))
        if np.isfinite(fits[s]):
            put(i, s, 0, length)
            continue
        while length:  # no sequence can hold it whole: cut it over the roomiest
            s = int(np.argmax(room))
            step = min(length, int(room[s]))
            put(i, s, start, step)
            start, length = start + step, length - step
    return out


def pack(docs: DataFrame, vocabulary: str, seq_len: int = 2048, end_id: int = 1, docs_per_block: int = 8192,
         linear: float = 1.0, quadratic: float = 1.0 / 2048) -> DataFrame:
    """One row per piece: document, start, length, crc32 of its ids, sequence and offset in it, estimated cost."""
    blocks = max(1, -(-docs.count() // docs_per_block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        # the same order in every run, however the blocks' rows came in
        rows = pa.Table.from_batches(held)
        rows = rows.append_column("crc", pa.array([zlib.crc32(t) for t in rows.column("tail").to_pylist()], pa.int64()))
        rows = rows.sort_by([("doc_id", "ascending"), ("crc", "ascending"), ("n", "ascending")])
        ids, n = rows.column("doc_id").combine_chunks(), rows.column("n").to_numpy()
        full, tails = rows.column("full").to_pylist(), [np.frombuffer(t, "<u2") for t in rows.column("tail").to_pylist()]
        where = assign(np.array([len(t) for t in tails], np.int64), seq_len, linear, quadratic)
        of, start, length, crc, seq = [], [], [], [], []
        for i, (crcs, pieces) in enumerate(zip(full, where, strict=True)):
            base = len(crcs) * seq_len
            for s, a, k in sorted(pieces, key=lambda p: p[1]):
                of.append(i), start.append(base + a), length.append(k), seq.append(s)
                crc.append(_crc(tails[i][a:a + k]))
        used = max(seq, default=-1) + 1
        for i, crcs in enumerate(full):
            for j, c in enumerate(crcs):
                of.append(i), start.append(j * seq_len), length.append(seq_len), crc.append(c), seq.append(used)
                used += 1
        of, start, length, seq = (np.array(x, np.int64) for x in (of, start, length, seq))
        order = np.lexsort((start, of, seq))
        of, start, length, seq = of[order], start[order], length[order], seq[order]
        ends = np.cumsum(length)
        opens = np.r_[True, seq[1:] != seq[:-1]]
        offset = ends - length - np.maximum.accumulate(np.where(opens, ends - length, 0))
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(of)), pa.array(start), pa.array(length), pa.array(np.array(crc, np.int64)[order]),
             pa.array(n[of]), pa.array(first + seq), pa.array(offset),
             pa.array(linear * length + quadratic * length.astype(float) ** 2)],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cost"])

    tokens = tokenize(docs, vocabulary, seq_len, end_id)
    key = docs.schema["doc_id"].dataType.simpleString()
    return tokens.repartition(blocks).mapInArrow(run, PIECES.format(key=key))

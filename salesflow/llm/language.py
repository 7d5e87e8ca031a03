"""Language identification by error-correcting output codes.

Each language has a codeword of +1 / -1 bits; for each bit a linear classifier over
hashed character n-grams (1 to 3 bytes of the lower-cased UTF-8 text, everything but
letters being one blank) tells the languages of the one side from the other. A text
is decoded to the codeword of least loss, each bit's logistic loss weighted by how
well its classifier did in training; the score is the softmax of the negative
losses, and a text whose two best codewords lie close is flagged as ambiguous.

Learns from a bounded sample of labelled rows: about ``per_lang`` of each language
(chosen by the hash of their key). Training inputs are counts computed on the
executors. Predictions see the text only.

Defined results: a text that is null or has no letter is ``und`` with score 0;
rows without a language are not learned from; with one known language every text
is that language (score 1), with none every text is ``und``; repeated rows get
equal results; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import text_slices
from salesflow.llm.textbytes import text_bytes

CELLS = 1 << 12

_LETTER = np.full(256, 32, np.int64)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram cells of all rows (n = 1, 2, 3 at each byte that is not a lone blank) and each row's number."""
    data, offsets = text_bytes(pc.utf8_lower(column))
    byte = _LETTER[data]
    size = len(byte)
    before = np.full(size, 32)
    before[1:] = byte[:-1]
    last = np.full(size, 32)
    last[2:] = byte[:-2]
    edge = offsets[:-1][offsets[:-1] < size]
    before[edge] = 32
    last[edge] = 32
    near = edge + 1
    last[near[near < size]] = 32
    keep = (byte != 32) | (before != 32)  # runs of blanks count once
    at = np.flatnonzero(keep)
    b, p, q = byte[at], before[at], last[at]
    row = np.searchsorted(offsets, at, "right") - 1
    two, three = p * 256 + b, (q * 256 + p) * 256 + b
    cells = np.column_stack([b, 256 + (two * 40503 >> 5) % 1024, 1280 + (three * 2654435761 >> 15) % (CELLS - 1280)])
    return cells.astype(np.int32), np.bincount(row, minlength=len(offsets) - 1)


def counts(cells: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """The n-gram frequencies of each row, scaled to its number of n-grams."""
    end = np.cumsum(rows)
    for e, n in zip(end, rows, strict=True):
        yield np.bincount(cells[e - n:e].ravel(), minlength=CELLS) / max(3 * n, 1)


@dataclass
class Codes:
    languages: list[str]
    words: np.ndarray    # languages x bits, +1 or -1
    weight: np.ndarray   # cells x bits
    bias: np.ndarray
    trust: np.ndarray    # weight of each bit in the decoding
    margin: float = 0.1


def codewords(n: int, bits: int = 31, seed: int = 5) -> np.ndarray:
    """All splits of up to five languages; for more, the random code of the largest least distance."""
    if n <= 5:
        half = 1 << (n - 1)
        return np.array([[1 if i == 0 else (-1 if (c >> (i - 1)) & 1 else 1) for c in range(1, half)] for i in range(n)]).reshape(n, half - 1)
    rng, best, far = np.random.default_rng(seed), None, -1
    bits = max(bits, 4 * int(np.ceil(np.log2(n))))
    for _ in range(200):
        code = rng.choice([-1, 1], (n, bits))
        code[0, np.abs(code.sum(0)) == n] *= -1  # a bit must split the languages
        least = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        if least > far:
            best, far = code, least
    return best


def fit(x: np.ndarray, languages: list[str], y: np.ndarray, steps: int = 300, rate: float = 0.05, decay: float = 1e-4) -> Codes:
    """One logistic regression for each bit (full-batch Adam on scaled frequencies)."""
    code = codewords(len(languages))
    if not code.shape[1]:
        return Codes(languages, code, np.zeros((CELLS, 0)), np.zeros(0), np.zeros(0))
    scale = 1 / (x.std(0) + 1e-3)
    z = ((x - x.mean(0)) * scale).astype(np.float32) / 8
    target = code[y].astype(np.float32)
    balance = 1 / np.maximum(np.bincount(y, minlength=len(languages)), 1)[y]
    balance = (balance / balance.sum()).astype(np.float32)[:, None]
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    for t in range(1, steps + 1):
        pull = -target * balance / (1 + np.exp(np.clip(target * (z @ w + b), -30, 30)))
        g, gb = z.T @ pull + decay * w, pull.sum(0)
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c, d = 1 - 0.9 ** t, 1 - 0.99 ** t
        w -= rate * (m / c) / (np.sqrt(v / d) + 1e-8)
        b -= rate * (mb / c) / (np.sqrt(vb / d) + 1e-8)
    right = ((z @ w + b) * target > 0)
    right = np.clip((right * balance).sum(0), 0.5, 1 - 1e-3)
    weight = w * scale[:, None] / 8
    return Codes(languages, code, weight, b - x.mean(0) @ weight, np.log(right / (1 - right)) + 1e-3)


def decode(margins: np.ndarray, model: Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, score and ambiguity of each row of bit margins."""
    n = len(margins)
    if len(model.languages) == 1:
        return np.zeros(n, np.int64), np.ones(n), np.zeros(n, bool)
    losses = np.logaddexp(0, -margins[:, None, :] * model.words[None]) @ (model.trust / model.trust.sum())
    p = np.exp(-(losses - losses.min(1, keepdims=True)) * model.words.shape[1])
    p /= p.sum(1, keepdims=True)
    best = losses.argmin(1)
    top = np.sort(p, 1)
    return best, p[np.arange(n), best], top[:, -1] - top[:, -2] < model.margin


def train(docs: DataFrame, learn: Column, per_lang: int = 500, most_langs: int = 200) -> Codes:
    """Fit on about ``per_lang`` different texts of each language among the rows where ``learn`` holds.

    The languages are the ``most_langs`` with most rows; texts are chosen by their hash, so copies, repeated and
    null ids count once. More than 20 languages share 10 000 texts: that many rows come to the driver at most.
    """
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = dict(rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_langs).collect())
    per_lang = min(per_lang, max(10_000 // max(len(known), 1), 10))
    languages = sorted(known)
    if not languages:
        return Codes([], np.zeros((0, 0)), np.zeros((CELLS, 0)), np.zeros(0), np.zeros(0))
    if len(languages) == 1:
        return fit(np.zeros((0, CELLS)), languages, np.zeros(0, np.int64))
    u = F.shiftrightunsigned(F.xxhash64(F.col("text"), F.lit("language")), 11) / F.lit(float(1 << 53))
    share = F.create_map(*[F.lit(v) for k, n in known.items() for v in (k, min(1.0, per_lang / n))])
    some = (rows.where(u < share[F.col("lang")]).groupBy("lang", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))
            .select("lang", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                got = [c.astype(np.float32).tobytes() for c in counts(*grams(part.column("text")))]
                yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(got)], ["lang", "x"])

    got = some.mapInArrow(run, "lang string, x binary").toPandas()
    x = np.array([np.frombuffer(b, np.float32) for b in got["x"]]).reshape(-1, CELLS)
    y = np.array([languages.index(v) for v in got["lang"]], np.int64)
    order = np.lexsort((x[:, 97], x.sum(1), x[:, 101], y))
    return fit(x[order], languages, y[order])


def predict(docs: DataFrame, model: Codes) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = part.column("text")
                n = part.num_rows
                letters = np.array([t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()], bool)
                pred, score, vague = np.array(["und"] * n, object), np.zeros(n), np.zeros(n, bool)
                if m.languages and letters.any():
                    cells, rows = grams(texts)
                    end = np.cumsum(rows)
                    margins = np.zeros((n, m.words.shape[1]))
                    for i in np.flatnonzero(letters) if m.words.shape[1] else []:
                        c = cells[end[i] - rows[i]:end[i]].ravel()
                        total = np.bincount(c, minlength=CELLS) @ m.weight if len(c) > CELLS // 8 else m.weight[c].sum(0)
                        margins[i] = total / max(len(c), 1) + m.bias
                    best, p, close = decode(margins, m)
                    pred[letters] = np.array(m.languages, object)[best[letters]]
                    score[letters], vague[letters] = p[letters], close[letters]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(pred, pa.string()), pa.array(score), pa.array(vague)],
                                                 ["doc_id", "lang_pred", "score", "ambiguous"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, lang_pred string, score double, ambiguous boolean")

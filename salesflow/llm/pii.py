"""Personal data by patterns and a skip-chain conditional random field.

The base patterns (e-mail, IP, card and phone numbers) give spans that always stay.
The random field adds spans of the same kinds. Its nodes are a document's tokens
that can carry such data: those with a digit or an at sign, and those that repeat a
part of such a token; all other tokens are fixed to "none". Each node has a unary
potential from its shape and surroundings, neighbouring nodes share a transition
potential, and a skip edge joins tokens that are equal or similar (same digits, same
letters, or one holding the other) however far apart, so that a person's number is
treated alike wherever it occurs. A token with many likenesses is joined to the next
alike token, in order, and to the first of them that a base span holds, so the edges of a group of n are under 2 n. Tokens of base spans are
observed; the labels of the others are the marginals of loopy sum-product message passing, in sweeps
forward and backward through the document, so evidence reaches any distance in one sweep.

Learnt from a bounded sample of about ``sample_docs`` documents, chosen by hash: unary, chain and skip
weights together, by pseudo-likelihood (each token given the labels of its neighbours), pairs never
seen staying at 0. Labels are the base spans and the tokens alike to one; to learn what a repeat looks like
where a corpus has few, each sampled document with a base span also occurs with that span's bare
digits or letters written again near its end, and with other digits of the same length, which are none.
The confidence from which a label counts is the least at which the held-out documents keep ``precision``.

Defined results: null and empty texts have no spans; repeated rows get equal spans;
an added span never overlaps a base span; spans count code points, end exclusive;
an empty table gives an empty table; extra columns are kept by ``mask``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import text_sample, text_slices

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["none", *KINDS]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# a match that starts within a run of digits could start at its first one
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CARRIER = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")
_DIGIT = re.compile("[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_PLAIN = re.compile(r"[\W_]+")

Span = tuple[int, str, int]  # start, kind, end


def _number(text: str) -> bool:
    """ASCII digits only: other scripts' and superscript digits are letters here."""
    return text.isascii() and text.isdigit()


def _octet(text: str) -> bool:
    text = text.lstrip("0")
    return len(text) <= 3 and int(text or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at signs: the longest local part before one, a domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        head = text[max(end, 0):at] if at - end <= 256 else text[at - 256:at]
        local = len(head) - len(head.rstrip(_LOCAL))
        if local == len(head) and len(head) < at - end:  # a very long local part
            head = text[end:at]
            local = len(head) - len(head.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if local else None
        if found:
            end = found.end()
            yield at - local, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns by start, then kind as listed."""
    if not _CARRIER.search(text):
        return []
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(map(_octet, m.group().split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGITS.sub("", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(a, KINDS[k], b) for a, k, b in sorted(out)]


# ---------------------------------------------------------------- nodes, features and edges

@dataclass
class Graph:
    """Candidate tokens of a document: (start, end) without outer punctuation, features, chain and skip edges."""

    spans: list[tuple[int, int]]
    x: np.ndarray
    chain: np.ndarray  # pairs of nodes
    skip: np.ndarray


_SHAPES = ["bias", "at", "dot_after_at", "plus", "bracket", "letters", "upper", "colon", "equals", "slash", "quote", "all_digits",
           "decimal", "percent", "dashed", "no_digits",
           *(f"digits_{i}" for i in ("0", "1", "2", "3", "4", "5_6", "7_9", "10_13", "14_19", "20")), *(f"dots_{i}" for i in range(5)),
           *(f"parts_{i}" for i in range(4)), "octets", "repeats",
           *(f"before_{i}" for i in ("none", "plus", "bracket", "digits", "word")), *(f"after_{i}" for i in ("none", "bracket", "dashed", "digits", "word"))]
_INDEX = {n: i for i, n in enumerate(_SHAPES)}
FEATURES = len(_SHAPES)


def _side(token: str | None, names: tuple[str, str, str, str, str]) -> str:
    if not token:
        return names[0]
    if token[0] == "+" or token[0] == "(" and names[1] == "bracket":
        return names[1]
    if token[0] == "(" or "-" in token and _DIGIT.search(token):
        return names[2]
    return names[3] if _number(token.strip(".,;:!?")) else names[4]


def _features(token: str, before: str | None, after: str | None, repeats: bool) -> list[int]:
    digits = _DIGITS.sub("", token)
    n = len(digits)
    core = token.strip(".,;:!?\"'")
    dots = core.count(".")
    parts = core.split(".")
    on = ["bias"]
    on += ["at"] * ("@" in core) + ["dot_after_at"] * ("@" in core and "." in core.rpartition("@")[2])
    on += ["plus"] * core.startswith("+") + ["bracket"] * ("(" in core or ")" in core)
    on += ["letters"] * any(c.isalpha() for c in core) + ["upper"] * any(c.isupper() for c in core)
    on += ["colon"] * (":" in core) + ["equals"] * ("=" in core) + ["slash"] * ("/" in core) + ["quote"] * ('"' in token or "'" in token)
    on += ["all_digits"] * _number(core) + ["decimal"] * (dots == 1 and _number(core.replace(".", ""))) + ["percent"] * ("%" in token)
    on += ["dashed"] * ("-" in core) + ["no_digits"] * (n == 0)
    on.append("digits_" + (str(n) if n < 5 else "5_6" if n < 7 else "7_9" if n < 10 else "10_13" if n < 14 else "14_19" if n < 20 else "20"))
    on.append(f"dots_{min(dots, 4)}")
    on.append(f"parts_{min(len(core.split('-')) - 1, 3)}")
    on += ["octets"] * (len(parts) == 4 and all(_number(p) and len(p) <= 3 and _octet(p) for p in parts)) + ["repeats"] * repeats
    on.append("before_" + _side(before, ("none", "plus", "bracket", "digits", "word")))
    on.append("after_" + _side(after, ("none", "bracket", "dashed", "digits", "word")))
    return [_INDEX[f] for f in on]


def _keys(token: str) -> list[str]:
    """What makes two tokens alike: their digits (five at least; also the last seven), their letters and digits (four at least)."""
    digits, plain = _DIGITS.sub("", token), _PLAIN.sub("", token).lower()
    out = ["p" + plain] if len(plain) >= 4 else []
    if len(digits) >= 5:
        out.append("d" + digits)
    if len(digits) >= 7:
        out.append("s" + digits[-7:])
    if "@" in token and len(local := _PLAIN.sub("", token.partition("@")[0]).lower()) >= 4:
        out.append("p" + local)
    return out


def graph(text: str, base: list[Span] = ()) -> Graph | None:
    """The random field's nodes and edges of a document; None without any token that can carry personal data."""
    if not _CARRIER.search(text):
        return None
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    carriers = {i for i, (a, b) in enumerate(tokens) if _CARRIER.search(text, a, b)}
    locals_ = {k for i in carriers if "@" in (w := text[slice(*tokens[i])]) for k in _keys(w)}
    if locals_:  # the letters of an address by themselves
        longest = max(map(len, locals_))
        carriers |= {i for i, (a, b) in enumerate(tokens) if b - a <= 2 * longest and "p" + _PLAIN.sub("", text[a:b]).lower() in locals_}
    nodes = sorted(carriers)
    place = {t: i for i, t in enumerate(nodes)}
    word = lambda i: text[slice(*tokens[i])] if 0 <= i < len(tokens) else None
    alike: dict[str, list[int]] = {}
    for i, t in enumerate(nodes):
        for k in _keys(word(t)):
            alike.setdefault(k, []).append(i)
    starts = [s for s, _, _ in base]
    ends = list(accumulate((e for _, _, e in base), max))

    def in_base(t: int) -> bool:
        i = bisect_left(starts, tokens[t][1])
        return i > 0 and ends[i - 1] > tokens[t][0]

    pairs = {(a, b) for g in alike.values() for a, b in zip(g, g[1:], strict=False)}
    for g in alike.values():
        anchor = next((i for i in g if in_base(nodes[i])), None) if base and len(g) > 2 else None
        if anchor is not None:
            pairs.update((min(anchor, i), max(anchor, i)) for i in g if i != anchor)
    skip = sorted(pairs)
    joined = {i for pair in skip for i in pair}
    x = np.zeros((len(nodes), FEATURES))
    spans = []
    for i, t in enumerate(nodes):
        a, b = tokens[t]
        raw = text[a:b]
        x[i, _features(raw, word(t - 1), word(t + 1), i in joined)] = 1
        a += len(raw) - len(raw.lstrip(".,;:!?\"'<>[]{}"))
        b -= len(raw) - len(raw.rstrip(".,;:!?\"'<>[]{}"))
        spans.append((a, max(a, b)))
    chain = [(place[t], place[t + 1]) for t in nodes if t + 1 in place]
    return Graph(spans, x, np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 2))


# ---------------------------------------------------------------- the field

@dataclass
class Field:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels, log potentials: earlier token, later token
    skip: np.ndarray
    sure: float = 0.9  # a label of at least this probability counts


def gold(g: Graph, spans: list[Span]) -> np.ndarray:
    """The label of each node: the kind of the base span that it overlaps."""
    y = np.zeros(len(g.spans), np.int64)
    i = 0
    for s, kind, e in spans:
        while i and g.spans[i - 1][1] > s:
            i -= 1
        while i < len(g.spans) and g.spans[i][0] < e:
            if not y[i] and s < g.spans[i][1]:
                y[i] = LABELS.index(kind)
            i += 1
    return y


def repeated(g: Graph, y: np.ndarray) -> np.ndarray:
    """Labels with those of alike tokens: a repeat of a labelled token is what that is."""
    y = y.copy()
    for pairs in (g.skip, g.skip[::-1, ::-1]):
        for a, b in pairs.tolist():
            if y[a] and not y[b]:
                y[b] = y[a]
    return y


def neighbours(g: Graph, y: np.ndarray) -> np.ndarray:
    """For each node the labels before and after it in the chain, and the counts of those it has skip edges with."""
    k = len(LABELS)
    out = np.zeros((len(y), 3 * k), np.int64)
    np.add.at(out, (g.chain[:, 1], y[g.chain[:, 0]]), 1)
    np.add.at(out, (g.chain[:, 0], k + y[g.chain[:, 1]]), 1)
    np.add.at(out, (g.skip[:, 1], 2 * k + y[g.skip[:, 0]]), 1)
    np.add.at(out, (g.skip[:, 0], 2 * k + y[g.skip[:, 1]]), 1)
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def fit(x: np.ndarray, near: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 600, rate: float = 0.5, decay: float = 2e-4) -> Field:
    """Pseudo-likelihood of ``n`` nodes of each row: features, neighbours' labels (``neighbours``) and label."""
    k = len(LABELS)
    weights = np.zeros((FEATURES + 3 * k, k))
    if len(y):
        z = np.concatenate([x, near], 1).astype(float)
        target = np.eye(k)[y]
        balance = n / np.sqrt(np.maximum(np.bincount(y, weights=n, minlength=k), 1))[y]
        balance = (balance / balance.sum())[:, None]
        momentum = np.zeros_like(weights)
        for _ in range(steps):
            slope = z.T @ ((_softmax(z @ weights) - target) * balance) + decay * weights
            # one potential for both ends of an edge
            before, after, skip = (slope[FEATURES + i * k:FEATURES + (i + 1) * k] for i in range(3))
            before += after.T
            after[:] = before.T
            skip += skip.T.copy()
            momentum = 0.9 * momentum - rate * slope
            weights += momentum
    return Field(weights[:FEATURES], weights[FEATURES:FEATURES + k], weights[FEATURES + 2 * k:])


def marginals(field: Field, g: Graph, rounds: int = 100, damping: float = 0.5, observed: np.ndarray | None = None) -> np.ndarray:
    """Label marginals by loopy sum-product; ``observed``: labels that are known (0: not).

    A round sweeps forward, then backward: edges lead from earlier to later nodes, those of equal
    depth in that order go together. Without cycles two rounds settle it; messages that still
    move after twenty rounds are damped.
    """
    unary = g.x @ field.unary
    unary -= unary.max(1, keepdims=True)
    if observed is not None:
        known = np.flatnonzero(observed)
        unary[known] = -1e3
        unary[known, observed[known]] = 0
    edges = np.concatenate([g.chain, g.skip])
    if not len(edges):
        return _softmax(unary)
    pair = np.concatenate([np.repeat(field.chain[None], len(g.chain), 0), np.repeat(field.skip[None], len(g.skip), 0)])
    m = len(edges)
    depth = [0] * len(unary)
    for a, b in edges[np.argsort(edges[:, 0], kind="stable")].tolist():
        depth[b] = max(depth[b], depth[a] + 1)
    depth = np.array(depth)

    def levels(key: np.ndarray) -> list[np.ndarray]:
        by = np.argsort(key, kind="stable")
        return np.split(by, np.flatnonzero(np.diff(key[by])) + 1)

    ahead = [(e, edges[e, 0], edges[e, 1], pair[e], e, e + m) for e in levels(depth[edges[:, 0]])]
    back = [(e, edges[e, 1], edges[e, 0], pair[e].transpose(0, 2, 1), e + m, e) for e in levels(-depth[edges[:, 1]])]
    message = np.zeros((2 * m, len(LABELS)))
    belief = unary.copy()
    for turn in range(rounds):
        moved, keep = 0.0, damping if turn >= 20 else 0.0
        for _, src, dst, potential, own, reverse in (*ahead, *back):
            send = (belief[src] - message[reverse])[:, :, None] + potential
            top = send.max(1, keepdims=True)
            new = np.log(np.exp(send - top).sum(1)) + top[:, 0]
            new = keep * message[own] + (1 - keep) * (new - new.max(1, keepdims=True))
            step = new - message[own]
            moved = max(moved, float(np.abs(step).max()))
            message[own] = new
            np.add.at(belief, dst, step)
        if moved < 1e-4:
            break
    return _softmax(belief)


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and added spans, by start, then kind as listed."""
    base = base_spans(text)
    g = graph(text, base)
    if g is None:
        return base, base
    known = gold(g, base)
    p = marginals(field, g, observed=known)
    label = np.where((p.max(1) >= field.sure) & (known == 0), p.argmax(1), 0)
    added: list[list] = []
    for i in np.flatnonzero(label):
        a, b = g.spans[i]
        if a == b:
            continue
        # adjacent tokens of one kind are one span
        if added and added[-1][1] == LABELS[label[i]] and text[added[-1][2]:a].isspace():
            added[-1][2] = b
        else:
            added.append([a, LABELS[label[i]], b])
    return base, sorted([*base, *map(tuple, added)], key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def examples(text: str) -> list[str]:
    """A training document, and if it has a base span, the same with that span's bare form and with a number that is no repeat of it."""
    spans = base_spans(text)
    out = [text]
    h = xxhash.xxh3_64_intdigest(text)
    for start, kind, end in spans[:4]:
        span = text[start:end]
        if kind == "email":
            again, other = span.partition("@")[0], f"{span.partition('@')[0][::-1]}x"
        else:
            digits = _DIGITS.sub("", span)
            again = digits[-10:] if kind == "phone" else digits
            if kind == "phone" and h & 1:
                again = f"{again[:3]}-{again[3:6]}-{again[6:]}"
            other = str(h)[:len(again)]
        lead = " ".join(text[max(end, len(text) - 200):].split()[1:8])
        out.append(f"{text}\n{lead} {again} {lead} {other}")
        h >>= 1
    return out


def _threshold(field: Field, x: np.ndarray, near: np.ndarray, y: np.ndarray, n: np.ndarray, precision: float) -> float:
    """The least confidence at which ``precision`` of the labels given to held-out nodes are right."""
    if not len(y):
        return 0.9
    p = _softmax(np.concatenate([x, near], 1) @ np.concatenate([field.unary, field.chain, field.chain.T, field.skip]))
    guess, top = p.argmax(1), p.max(1)
    for sure in (0.5, 0.6, 0.7, 0.8, 0.9, 0.95):
        given = (guess > 0) & (top >= sure)
        if (n * (given & (guess == y))).sum() >= precision * (n * given).sum():
            return sure
    return 0.99


def train(docs: DataFrame, sample_docs: int = 20_000, precision: float = 0.99) -> Field:
    """Fit on about ``sample_docs`` documents, chosen by hash; a fifth of them sets the confidence.

    What comes back is counts: of each distinct set of features with the neighbours' labels and the label.
    """
    some = text_sample(docs, sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if not text or not _CARRIER.search(text):
                    continue
                held = xxhash.xxh3_64_intdigest(text, seed=1) % 5 == 0
                for one in examples(text):
                    base = base_spans(one)
                    g = graph(one, base)
                    y = repeated(g, gold(g, base))
                    near = neighbours(g, y)
                    seen.update((held, " ".join(map(str, np.flatnonzero(x))), " ".join(map(str, c)), int(k)) for x, c, k in zip(g.x, near, y, strict=True))
        if seen:
            rows = [(*k, n) for k, n in seen.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["held", "on", "near", "label", "n"])

    counts = some.mapInArrow(run, "held boolean, on string, near string, label long, n long").groupBy("held", "on", "near", "label").agg(F.sum("n").alias("n"))
    got = sorted(counts.collect())

    def arrays(rows):
        x, near = np.zeros((len(rows), FEATURES)), np.zeros((len(rows), 3 * len(LABELS)))
        for i, r in enumerate(rows):
            x[i, [int(j) for j in r["on"].split()]] = 1
            near[i] = [int(j) for j in r["near"].split()]
        return x, near, np.array([r["label"] for r in rows], np.int64), np.array([r["n"] for r in rows], float)

    field = fit(*arrays([r for r in got if not r["held"]]))
    field.sure = _threshold(field, *arrays([r for r in got if r["held"]]), precision)
    return field


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def detect(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, base spans by kind and as a hash, all spans, and how many the field added."""
    model = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = [all_spans(t, model.value) if t else ([], []) for t in part.column("text").to_pylist()]
                by_kind = [pa.array([sum(s[1] == k for s in b) for b, _ in found], pa.int64()) for k in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *by_kind, pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found]),
                     pa.array([joined(s) for _, s in found]), pa.array([len(s) - len(b) for b, s in found], pa.int64())],
                    ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {key}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string, n_added long")


def masked(text: str, spans: list[Span]) -> str:
    """Each span (or run of overlapping spans) replaced by its first kind in brackets."""
    out, end, i = [], 0, 0
    while i < len(spans):
        a, kind, b = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < b:
            i += 1
            b = max(b, spans[i][2])
        out += [text[end:a], f"[{kind.upper()}]"]
        end, i = b, i + 1
    return "".join(out) + text[end:]


def clean(text: str, field: Field) -> str:
    """All spans masked; what then matches a base pattern (two numbers had run together) is masked too."""
    text = masked(text, all_spans(text, field)[1])
    while spans := base_spans(text):
        text = masked(text, spans)
    return text


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """All rows and columns, personal data in ``text`` replaced by its kind; an ``n_chars`` column follows the text."""
    model = docs.sparkSession.sparkContext.broadcast(field)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                old = part.column("text").to_pylist()
                new = [clean(t, model.value) if t else t for t in old]
                columns = dict(zip(names, part.columns, strict=True))
                columns["text"] = pa.array(new, part.schema.field("text").type)
                if "n_chars" in columns:
                    counted = [n if t == o or t is None else len(t) for t, o, n in zip(new, old, columns["n_chars"].to_pylist(), strict=True)]
                    columns["n_chars"] = pa.array(counted, part.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return docs.mapInArrow(run, docs.schema)

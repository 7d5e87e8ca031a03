import random

import numpy as np
import pytest

from salesflow.llm import repeats

from .conftest import DOC, prose


def brute(rows, length):
    """Per row (in document order): its bytes, the removed flags."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), []
    for i, text in rows:
        b = (text or "").encode()
        gone = [False] * len(b)
        for j in range(len(b) - length + 1):
            w = b[j:j + length]
            if w in seen:
                gone[j:j + length] = [True] * length
            seen.add(w)
        spans, start = [], None
        for j, g in enumerate([*gone, False]):
            if g and start is None:
                start = j
            if not g and start is not None:
                spans.append((start, j))
                start = None
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


def result(df):
    return [(r["doc_id"], r["n_bytes"], r["n_removed"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"])) for r in df.collect()]


def awkward():
    r = random.Random(5)
    base, other = prose(1, 400), prose(2, 300)
    line = "This passage of more than one hundred bytes stands in very many of the documents, word for word, as it does here. "
    rows = [(1, base), (2, base), (3, base[:700] + "X" + base[701:]), (4, None), (5, ""), (6, "short"), (7, "z" * 99), (8, "z" * 100),
            (9, "z" * 5000), (10, "ab" * 700 + "c" + "ab" * 300), (11, other[200:900] + base[100:1200]), (12, "é" * 120 + other[:333] + "日本" * 80),
            (13, "日本" * 90 + other[300:800]), (14, other * 3), (15, base[50:150]), (16, base[51:151] + "!"), (17, base[1:100])]
    for i in range(20, 150):
        lead = prose(i, r.randrange(0, 60))
        rows.append((i, lead + line[r.randrange(0, 12):len(line) - r.randrange(0, 9)] * r.choice([0, 1, 1, 2]) + prose(i + 1000, r.randrange(0, 40))))
    rows += [(200, line), (201, line * 30), (202, "".join(r.choice("ab") for _ in range(4000))), (203, rows[5][1])]
    return rows


@pytest.mark.parametrize("batches,chunk", [(1, 1 << 18), (3, 1 << 18), (5, 257), (4, 1 << 18)])
def test_equals_brute_force(spark, monkeypatch, batches, chunk):
    rows = awkward()
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC).repartition(3)
    got = repeats.remove_repeats(docs, batches=batches) if chunk > 1000 else None
    if got is None:  # runs cut at many places of the texts give the same result
        data = np.frombuffer(b"".join((t or "").encode() for _, t in rows), np.uint8)
        offsets = np.cumsum([0, *(len((t or "").encode()) for _, t in rows)])
        whole = repeats.runs(data, offsets)
        monkeypatch.setattr(repeats, "CHUNK", chunk)
        cut = repeats.runs(data, offsets)
        windows = lambda r: sorted((int(a), int(b) + k, int(g)) for a, b, n, g in zip(*r[:4], strict=True) for k in range(int(n)))
        assert windows(whole) == windows(cut) and len(cut[0]) > len(whole[0])
        return
    key = lambda r: (r[0] is not None, r[0] or 0)
    for a, b in zip(sorted(result(got), key=key), brute(rows, 100), strict=True):
        assert a == b, a[0]


def test_levels_merge_geometrically(spark):
    rows = [(i, prose(i % 7, 60)) for i in range(40)]
    texts = repeats.ordered_texts(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC).coalesce(1)).orderBy("ord")
    order = [r[0] for r in texts.select("ord").collect()]
    family, sizes = repeats.SuffixFamily(), []
    for k in range(5):
        from pyspark.sql import functions as F
        low, high = order[8 * k], order[8 * k + 7]
        family.add(texts.where(F.col("ord").between(low, high)), low)
        sizes.append([n for n, _, _ in family.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]
    held = family.entries().select("gram", "stretch")
    assert held.count() == held.distinct().count()
    whole = repeats.SuffixFamily()
    whole.add(texts, order[0])
    assert sorted(whole.entries().select("gram", "stretch", "ord", "at").collect()) == sorted(family.entries().select("gram", "stretch", "ord", "at").collect())


def test_two_windows_of_one_name_are_told_apart(monkeypatch):
    monkeypatch.setattr(repeats, "window_hashes", lambda data, length: (data[:max(len(data) - length + 1, 0)] & 1).astype(np.uint64))
    data = np.frombuffer(b"abcabcaacbbcabcabc", np.uint8)
    starts = np.arange(len(data) - 2)
    by, again = repeats.equal_windows(data, starts, 3)
    text, seen = data.tobytes(), {}
    for i, same in zip(by.tolist(), again.tolist(), strict=True):
        assert same == (text[i:i + 3] in seen)
        seen.setdefault(text[i:i + 3], i)
    assert all(text[i:i + 3].find(text[seen[text[i:i + 3]]:seen[text[i:i + 3]] + 3]) == 0 and seen[text[i:i + 3]] <= i for i in starts.tolist())


def test_many_stretches_of_one_gram(spark, monkeypatch):
    """A passage in every document: its grams have as many stretches as there are documents, over many partitions."""
    line = "A sentence of well over a hundred bytes that every one of these documents holds at some place, in the middle of other words. "
    rows = [(i, prose(i, 20) + line + prose(i + 9000, 20)) for i in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(repeats, "TOGETHER", 40)
    try:
        docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC)
        got = sorted(result(repeats.remove_repeats(docs, batches=2)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute(rows, 100)


def test_null_and_repeated_ids(spark):
    base, other = prose(1, 100), prose(2, 100)
    rows = [(None, base), (None, other), (None, base), (3, base), (3, other), (3, base)]
    got = result(repeats.remove_repeats(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC)))
    assert len(got) == 6
    assert sorted(g[2] for g in got if g[0] is None) == sorted([0, 0, len(base)])
    assert all(g[2] == g[1] for g in got if g[0] == 3)


def test_empty_table_and_clashing_columns(spark, docs, no_docs, cluttered):
    from pyspark.sql import functions as F
    assert repeats.remove_repeats(no_docs).count() == 0
    clash = cluttered.withColumn("ord", F.lit("x")).withColumn("gram", F.lit("x")).withColumn("marks", F.lit("x")).withColumn("at", F.lit("x"))
    key = lambda r: r[0]
    assert sorted(result(repeats.remove_repeats(clash)), key=key) == sorted(result(repeats.remove_repeats(docs)), key=key)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(result(repeats.remove_repeats(docs)), key=key) == brute(rows, 100)

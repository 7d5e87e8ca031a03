import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salesflow.llm import ngram_join
from salesflow.llm.components import components

from .conftest import prose


def shingle_set(text, n=5):
    w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, num=75, den=100):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                p, q = find(sets[a][0]), find(sets[b][0])
                root[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets}


def result(df):
    return {r["doc_id"]: (r["size"], r["component"]) for r in df.collect()}


def variants(seed=0):
    """Families of texts around the threshold, at all sizes, with passages that many share."""
    rng = np.random.default_rng(seed)
    rows, shared = [], prose(99, 60)
    for family in range(60):
        n = int(rng.integers(5, 260)) if family % 3 else int(rng.integers(4, 14))
        base = prose(1000 + family, n).split(" ")
        if family % 2:
            base = shared.split(" ")[:int(rng.integers(20, 60))] + base
        rows.append(" ".join(base))
        for _ in range(int(rng.integers(0, 7))):
            w = list(base)
            for _ in range(int(rng.integers(0, max(2, len(w) // 25)))):
                at = int(rng.integers(len(w)))
                w[at] = f"new{rng.integers(10**6)}"
            if rng.random() < 0.4:
                w = w[:int(len(w) * rng.uniform(0.72, 1.0))]
            rows.append(" ".join(w))
    return [(int(i), t) for i, t in zip(rng.permutation(len(rows)), rows, strict=True)]


def test_matches_brute_force(spark):
    rows = variants()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert len({c for _, c in want.values()}) < len(rows) - 40
    assert result(ngram_join.similar_sets(df)) == want
    assert result(ngram_join.similar_sets(df, block=2, docs_per_bucket=30)) == want


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(1)
    for n in (1, 3, 8, 9, 40, 300):
        a, b = rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.integers(0, 1 << 63, n + 2, dtype=np.uint64)
        b[:n // 2] = a[:n // 2]
        x, y = ngram_join.sketches(np.r_[a, b], np.array([n, n + 2]))
        size = min(len(x), len(y))
        apart = int(np.bitwise_count(ngram_join._folded(x, size) ^ ngram_join._folded(y, size)).sum())
        assert apart <= len(np.setxor1d(a, b)) and (n < 40 or apart > len(np.setxor1d(a, b)) * 0.7)


def test_awkward_texts(spark, docs, cluttered, texts, no_docs):
    want = brute([(i, t) for i, t, _ in texts])
    assert result(ngram_join.similar_sets(docs)) == want
    assert result(ngram_join.similar_sets(cluttered)) == want
    assert want[2][1] == want[3][1] == 1 and want[7][1] == 6 and want[9][1] == 8 and want[17][1] == 16
    assert ngram_join.similar_sets(no_docs).count() == 0
    kept = ngram_join.representatives(cluttered)
    assert kept.columns == cluttered.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_repeated_rows_and_null_ids(spark):
    text = prose(5, 50)
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text), (None, "other words"), (3, None), (3, None)], "doc_id long, text string")
    rows = sorted(map(tuple, ngram_join.similar_sets(df).collect()), key=str)
    assert rows.count((1, 46, 1)) == 2 and rows.count((2, 46, 1)) == 1 and rows.count((None, 46, 1)) == 1 and rows.count((3, 0, 3)) == 2
    assert sorted(str(r["doc_id"]) for r in ngram_join.representatives(df).collect()) == ["1", "3", "None"]


def test_rows_of_one_id_are_decided_by_their_own_text(spark):
    a, b, c, d, e = (prose(50 + i, 200) for i in range(5))

    def near(text):
        return " ".join([*text.split(" ")[:-1], "changed"])

    rows = [(None, a), (1, near(a)), (None, b), (None, b.upper()), (None, near(c)), (None, c), (2, d), (2, e), (2, e), (3, near(e)),
            (None, None), (None, " "), (4, None), (5, a)]
    kept = [tuple(r) for r in ngram_join.representatives(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    sure = [(1, near(a)), (2, d), (2, e), (4, None)]
    assert len(kept) == len(sure) + 3 and all(kept.count(x) == 1 for x in sure)
    null = [t for i, t in kept if i is None]
    assert len({b, b.upper()} & {*null}) == 1 and len({c, near(c)} & {*null}) == 1 and len({None, " "} & {*null}) == 1
    many = [(None, prose(1000 + i, 80)) for i in range(40)]
    assert ngram_join.representatives(spark.createDataFrame(many, "doc_id long, text string")).count() == 40


def test_no_similar_pair_lacks_a_signature():
    """Pigeonhole guarantee itself, over random pairs near the threshold at every size."""
    rng = np.random.default_rng(2)
    t, common = ngram_join.Threshold(), np.zeros(1 << 10, np.uint8)
    common[rng.integers(0, 1 << 10, 300)] = rng.integers(0, 9, 300)
    for _ in range(1500):
        n = int(2 ** rng.uniform(0, 9))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        both = int(rng.integers(0, t.differ(2 * n) + 1))
        out = int(rng.integers(0, min(both, n - 1) + 1)) if n > 1 else 0
        b = np.r_[a[out:], rng.integers(0, 1 << 63, both - out, dtype=np.uint64)]
        a, b = np.unique(a), np.unique(b)
        shared = len(np.intersect1d(a, b))
        if 100 * shared < 75 * (len(a) + len(b) - shared):
            continue
        sig, row = ngram_join.signatures(np.r_[a, b], np.array([len(a), len(b)]), common, t)
        assert np.intersect1d(sig[row == 0], sig[row == 1]).size, (len(a), len(b), shared)


def test_one_deletion_neighbourhoods_are_allocated_somewhere():
    layouts = {g: ngram_join.layout(g, 75, 100) for g in range(20)}
    assert any(w for w, _, _ in layouts.values()) and any(not w for w, _, _ in layouts.values())


@pytest.mark.parametrize("edges,want", [
    ([], {}), ([(1, 1)], {}), ([(i, i + 1) for i in range(70)], {i: 0 for i in range(71)}),
    ([(5, 9), (9, 7), (2, 3), (3, 2)], {5: 5, 9: 5, 7: 5, 2: 2, 3: 2}), ([(100, i) for i in range(50)], {i: 0 for i in [*range(50), 100]})])
def test_components(spark, edges, want):
    df = spark.createDataFrame(edges, "u long, v long")
    assert {r["node"]: r["root"] for r in components(df).collect()} == want


def test_one_stray_member_is_compared_with_the_large_group_only(spark):
    """A group of near copies with a stray member: its classes are copied once, not compared among themselves."""
    base = prose(1, 200).split()
    rows = []
    for i in range(90):
        w = list(base)
        w[40] = f"own{i}"
        rows.append((i, " ".join(w)))
    rows.append((500, " ".join(base[:8] + [f"other{k}" for k in range(60)])))
    tagged = spark.createDataFrame([(7, i, 1) for i in range(90)] + [(7, 500, 500)], "hub long, class long, root long")
    values = [(i, *(lambda v, n: (int(n[0]), v))(*ngram_join.shingles(pa.array([t])))) for i, t in rows]
    sets = spark.createDataFrame([(i, n, bytearray(ngram_join.sketches(v, np.array([n]))[0])) for i, n, v in values], "class long, size long, sketch binary")
    pairs = ngram_join._open_pairs(tagged, sets, ngram_join.Threshold(), 3, 40)
    assert pairs.count() == 0
    assert ngram_join._open_pairs(tagged.where("class < 90"), sets, ngram_join.Threshold(), 3, 40) is None
    # three components: all pairs between them are looked at, none within the largest
    three = tagged.where("class < 90").unionByName(spark.createDataFrame([(7, 91, 91), (7, 92, 92)], "hub long, class long, root long"))
    more = sets.where("class < 90").unionByName(sets.where("class in (0, 1)").withColumn("class", F.col("class") + 91))
    got = {tuple(r) for r in ngram_join._open_pairs(three, more, ngram_join.Threshold(), 3, 40).collect()}
    assert got == {(i, c) for i in range(90) for c in (91, 92)} | {(91, 92)}


def test_lists_of_a_common_signature_are_cut(spark, docs, monkeypatch):
    whole = sorted(map(tuple, ngram_join.similar_sets(docs).collect()), key=str)
    monkeypatch.setattr(ngram_join, "LIST", 2)
    assert sorted(map(tuple, ngram_join.similar_sets(docs).collect()), key=str) == whole

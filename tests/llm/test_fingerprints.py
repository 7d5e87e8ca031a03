import hashlib
from collections import Counter

import numpy as np
import xxhash

from salesflow.llm import fingerprints as fp

from .conftest import prose


def weighted(a, b):
    a, b = Counter(fp.paragraphs(a)), Counter(fp.paragraphs(b))
    weigh = lambda c: sum(min(len(k), 4095) * v for k, v in c.items())
    return weigh(a & b) / weigh(a | b) if a or b else 1.0


def test_neighbours_edits_and_likeness(docs, cluttered, texts):
    rows = [(i, t or "") for i, t, _ in texts]
    for df, size in ((docs, 2048), (cluttered, 1)):
        out = {r["doc_id"]: r for r in fp.fingerprints(df, docs_per_range=size).collect()}
        assert len(out) == len(rows)
        for k, (i, t) in enumerate(rows):
            following = rows[(k + 1) % len(rows)][1]
            new = fp.edited(t, following)
            r = out[i]
            assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
            assert np.isclose(r["near_edited"], weighted(t, new)) and np.isclose(r["near_next"], weighted(t, following))
    assert out[1]["fingerprint"] == out[2]["fingerprint"] and out[1]["near_next"] == 1.0
    assert out[1]["fingerprint"] != out[3]["fingerprint"] and out[2]["near_next"] > 0.8
    assert out[4]["fingerprint"] == out[5]["fingerprint"] and out[4]["near_next"] == 1.0


def test_peeling_recovers_exactly_the_differing_paragraphs():
    rng = np.random.default_rng(0)
    for extra in (0, 1, 3, 8):
        a = "\n".join(f"line {i}" for i in range(200))
        b = "\n".join(f"line {i}" for i in range(extra, 200)) + "".join(f"\nnew {j}" for j in range(extra))
        keys, sizes = fp.digests([a, b])
        ka, kb = set(keys[:sizes[0]].tolist()), set(keys[sizes[0]:].tolist())
        prints = [fp.text_of(fp.tables_of(np.array(sorted(k), np.uint64), np.array([len(k)]), 30), [len(k)], [t])[0] for k, t in ((ka, a), (kb, b))]
        only = fp.difference(*prints)
        assert only is not None and set(only[0]) == ka - kb and set(only[1]) == kb - ka
    many = fp.digests(["\n".join(f"p{i}" for i in range(500)), "\n".join(f"q{i}" for i in range(500))])
    assert fp.likeness(many[0][:500], many[1][:1], many[0][500:], many[1][1:])[0] == 0.0  # retried larger until it peels
    sizes = rng.integers(0, 40, 50)
    texts = [prose(int(s), int(s)) for s in sizes]
    k, n = fp.digests(texts)
    assert np.allclose(fp.likeness(k, n, k, n, m=3), 1.0)


def test_repeated_paragraphs_count(spark):
    keys, sizes = fp.digests(["same\n" * 5, "same\n" * 3])
    assert sizes.tolist() == [5, 3] and len(set(keys.tolist())) == 5
    assert fp.likeness(keys[:5], sizes[:1], keys[5:], sizes[1:])[0] == 3 / 5


def test_ties_nulls_single_and_empty(spark, no_docs):
    assert fp.fingerprints(no_docs).count() == 0
    one = fp.fingerprints(spark.createDataFrame([(3, "only one. here it is")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    rows = [(None, "n"), (5, "b. x"), (5, "a. x"), (5, "a. x"), (9, None), (9, "z" * 1000)]
    out = fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), docs_per_range=1).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, xxhash.xxh3_64_intdigest(r[1]) >> 1))
    want = sorted((str(i), hashlib.sha256(fp.edited(t, order[(k + 1) % 6][1]).encode()).hexdigest()) for k, (i, t) in enumerate(order))
    assert sorted((str(r["doc_id"]), r["edited_sha256"]) for r in out) == want

import hashlib
import re

import numpy as np
import pytest

from salesflow.llm import suffixes

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, window=10):
    out = {}
    wins = []
    for item, text in items:
        w = words(text)
        k = min(window, len(w))
        wins += [(str(item) if item is not None else "null", w[j:j + k]) for j in range(len(w) - k + 1) if k]
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, win in wins:
            for j in range(len(w) - len(win) + 1):
                if w[j:j + len(win)] == win:
                    hit.update(range(j, j + len(win)))
                    found.add(item)
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[i] = (len(w), len(hit), len(found), sha, bool(hit))
    return out


@pytest.fixture(scope="module")
def case():
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(12)]
    text = lambda n: " ".join(rng.choice(vocab, n))
    items = [(1, text(25)), (2, text(10)), (3, "w1 w2 w3"), (4, "single"), (5, ""), (6, None), (None, text(14)), (2, text(12)), (10, "Ünï côdé w1"), (11, "x-y")]
    docs = [(i, text(int(rng.integers(0, 120)))) for i in range(60)]
    docs += [(100, f"lead {items[0][1].upper()} tail"), (101, f"{items[1][1]} {items[1][1]}"), (102, None), (103, ""), (104, "... Single!"),
             (105, " ".join(items[0][1].split()[5:17])), (106, items[6][1].replace(" ", " -- ")), (107, "ünï CÔDé w1"), (108, text(5000) + " " + items[0][1]),
             (109, "x y"), (110, "w1 w2"), (111, "w3 w1 w2 w3")]
    return docs, items


@pytest.mark.parametrize("block_words,shard_words", [(10**6, 10**6), (20, 200)])
def test_matches_brute_force(spark, case, block_words, shard_words):
    docs, items = case
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = suffixes.contamination(d, b, block_words=block_words, shard_words=shard_words).collect()
    want = brute(docs, items)
    for r in got:
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == want[r["doc_id"]], r["doc_id"]
    assert len(got) == len(docs)
    kept = {r["doc_id"] for r in suffixes.decontaminate(d, b, block_words=block_words).collect()}
    assert kept == {i for i, w in want.items() if not w[4]}


def test_longest_match_is_the_longest_common_run(spark, case):
    docs, items = case
    got = suffixes.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items[:2], "item_id long, text string")).collect()
    texts = dict(docs)
    for r in got:
        best = 0
        w = words(texts[r["doc_id"]])
        for _, t in items[:2]:
            v = words(t)
            for a in range(len(v)):
                for j in range(len(w)):
                    k = 0
                    while a + k < len(v) and j + k < len(w) and v[a + k] == w[j + k]:
                        k += 1
                    best = max(best, k)
        if r["contaminated"]:
            assert r["longest_words"] == best
            run = w[r["longest_start"]:r["longest_start"] + best]
            assert " ".join(run) in " ".join(words(dict(items[:2])[int(r["longest_item"])]))
        else:
            assert r["longest_words"] == 0 and r["longest_start"] == -1 and r["longest_item"] is None


def test_suffix_array_orders_whole_suffixes():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 4, 400).astype(np.int32)
    order = suffixes.suffix_array(text, 400)

    def suffix(i):
        end = i
        while end < len(text) and text[end]:
            end += 1
        return tuple(text[i:end])

    assert sorted(order.tolist()) == np.flatnonzero(text).tolist()
    keys = [suffix(i) for i in order]
    assert keys == sorted(keys)


def test_empty_tables_and_extra_columns(spark, docs, no_docs, cluttered):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert suffixes.contamination(no_docs, some).count() == 0
    assert not any(r["contaminated"] for r in suffixes.contamination(docs, none).collect())
    assert sorted(suffixes.decontaminate(cluttered, none).columns) == sorted(cluttered.columns)
    assert suffixes.decontaminate(cluttered, some).count() == suffixes.decontaminate(docs, some).count()

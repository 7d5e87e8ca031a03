import zlib

import numpy as np
import pytest

from salesflow.llm import packing
from salesflow.llm.queries import vocabulary_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary_path())


def check(rows, texts, tokenizer, seq_len=2048):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for i, t, *_ in texts:
        ids, at = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4"), 0
        for r in sorted(by_doc.pop(i), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= seq_len
    return by_seq


def test_round_trip(docs, cluttered, texts, tokenizer):
    seqs = check(packing.pack(docs, vocabulary_path()).collect(), texts, tokenizer)
    total = sum(r["length"] for s in seqs.values() for r in s)
    assert len(seqs) * 2048 - total < 2048  # one block: less than a sequence of padding
    check(packing.pack(cluttered, vocabulary_path(), seq_len=64, docs_per_block=4).collect(), texts, tokenizer, 64)


def test_odd_words_have_the_tokenizers_ids(tokenizer):
    words = packing.WordTokenizer(vocabulary_path())
    for text in ["Don't STOP!! it's 3.14%", "straße ÀÉÎ ŒUVRE İstanbul ΣΑΣ σας", "a b c\u0085d\x1ce\x0bf\x0cg", "é ́x ﬁne",
                 "<|endoftext|> x<|startoftext|>y", "🙂👍🏽 日本語 ½ ² ٣", "\t\r\n  ", "ªº µ ÿ Ÿ", "'S 'LL'd", "a" * 3000, "x\x00y\x7fz"]:
        for _ in range(2):
            assert np.frombuffer(words.tokens(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_assign_balances_cost_and_cuts_only_when_needed():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 2048, 3000)
    where = packing.assign(lengths, 2048, 1.0, 1 / 2048)
    count = -(-int(lengths.sum()) // 2048)
    load, cost = np.zeros(count, int), np.zeros(count)
    for n, pieces in zip(lengths, where, strict=True):
        assert sum(k for _, _, k in pieces) == n
        for s, _, k in pieces:
            load[s] += k
            cost[s] += k + k * k / 2048
    assert load.max() <= 2048 and count * 2048 - load.sum() < 2048
    # no padding is left to spend, so rests are cut; each into a few pieces at most
    assert sum(len(p) for p in where) < 2 * len(lengths) and cost.std() / cost.mean() < 0.25


def test_empty_and_repeated(spark, no_docs, tokenizer):
    assert packing.pack(no_docs, vocabulary_path()).count() == 0
    rows = [(1, "same text"), (2, "same text"), (3, None), (4, "")]
    check(packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary_path()).collect(), rows, tokenizer)
    twice = spark.createDataFrame([(1, "same text")] * 3, "doc_id long, text string")
    got = packing.pack(twice, vocabulary_path()).collect()
    assert len(got) == 3 and len({(r["sequence_id"], r["offset"]) for r in got}) == 3


def test_words_of_many_slices_keep_their_ids(tokenizer, monkeypatch):
    """Generations that fill up, words of one hash, long words and awkward characters: always the tokenizer's own ids."""
    import random

    import pyarrow as pa

    from salesflow.llm.textbytes import text_bytes

    monkeypatch.setattr(packing.WordTokenizer, "KEEP", 60)
    monkeypatch.setattr(packing.WordTokenizer, "KEEP_LONG", 5)
    tok = packing.WordTokenizer(vocabulary_path())
    r = random.Random(3)
    pool = ["a", "don't", "É", "naïve", "日本語", "x" * 17, "y" * 300, "12345678", "12345678abcdefgh", "12345678abcdefgi", "…", " ", "á", "İ", "<s>", "[MASK]", "\x0b", "ß"]
    pool += ["".join(r.choice("abcdéè'.-0") for _ in range(r.randrange(1, 20))) for _ in range(300)]
    for _ in range(40):
        texts = [r.choice([" ", "\n", "\t ", "  "]).join(r.choice(pool) for _ in range(r.randrange(0, 40))) for _ in range(5)] + [None, ""]
        ids, count = tok.ids(*text_bytes(pa.array(texts)))
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert count.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
    simple = [chr(c) for c in range(256) if tok.SIMPLE.fullmatch(chr(c))]
    assert all(tok.SIMPLE.fullmatch(c.lower()) for c in simple)


def test_words_of_one_hash_are_told_apart(tokenizer, monkeypatch):
    import pyarrow as pa

    from salesflow.llm.textbytes import text_bytes

    plain = packing.words

    def clash(*args, **kwargs):
        w = plain(*args, **kwargs)
        w.hash = w.hash % np.uint64(3)
        return w

    monkeypatch.setattr(packing, "words", clash)
    tok = packing.WordTokenizer(vocabulary_path())
    for text in ["one two three four two one", "five one six", "seven " + "long" * 9 + " eight one " + "gnol" * 9, "two"]:
        ids, _ = tok.ids(*text_bytes(pa.array([text])))
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_blocks_are_packed_alike_in_every_order(spark, docs):
    first = sorted(map(tuple, packing.pack(docs.coalesce(1).orderBy("doc_id"), vocabulary_path()).select("doc_id", "start", "length", "sequence_id", "offset").collect()))
    again = sorted(map(tuple, packing.pack(docs.coalesce(1).orderBy("text"), vocabulary_path()).select("doc_id", "start", "length", "sequence_id", "offset").collect()))
    assert first == again

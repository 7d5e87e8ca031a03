"""The pipeline and the registered queries against brute force on the smallest tables."""

import hashlib
import importlib
import sys
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from salesflow.llm import pii, quality
from salesflow.llm.queries import ORACLE_SQL, QUERIES, vocabulary_path

from .test_ngram_join import brute as brute_components
from .test_suffixes import brute as brute_hits

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id").reset_index(drop=True)


def test_every_query_is_registered():
    names = set(entry.queries())
    assert {*QUERIES, "pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "private_data", "packing"]


def test_entry_works_without_the_subpackage(monkeypatch):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("salesflow.llm")]:
        monkeypatch.delitem(sys.modules, name)

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline" or name.startswith("salesflow.llm"):
                raise ModuleNotFoundError(name, name=name)

    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    fresh = importlib.reload(entry)
    assert "a2_daily_revenue_ma" in fresh.queries() and "pipeline" not in fresh.queries() and not any(n.startswith("op3") for n in fresh.queries())
    assert "a2_daily_revenue_ma" in fresh.oracle_sql()


def test_an_error_inside_the_subpackage_is_not_hidden(monkeypatch):
    class Broken:
        def find_spec(self, name, path=None, target=None):
            if name == "zstandard":
                raise ModuleNotFoundError(name, name=name)

    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("salesflow.llm") or n == "zstandard"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Broken(), *sys.meta_path])
    with pytest.raises(ModuleNotFoundError, match="zstandard"):
        importlib.reload(entry).queries()


def test_pipeline_equals_its_stages_by_brute_force(spark, documents):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    forest = quality.train(table, labels)
    keep = forest.score(quality.statistics(__import__("pyarrow").array(list(documents["text"])))) >= 0.7
    docs = documents[keep]
    component = brute_components(list(zip(docs["doc_id"], docs["text"])))
    docs = docs[[component[i][1] == i for i in docs["doc_id"]]]
    hits = brute_hits(list(zip(docs["doc_id"], docs["text"])), list(zip(bench["item_id"], bench["text"])))
    docs = docs[[not hits[i][4] for i in docs["doc_id"]]]
    field = pii.train(spark.createDataFrame(docs[["doc_id", "text"]]))
    texts = {i: pii.clean(t, field) for i, t in zip(docs["doc_id"], docs["text"])}

    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(vocabulary_path())
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert set(got) == set(texts) and 0 < len(texts) < len(documents)
    for i, t in texts.items():
        ids, at = np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4"), 0
        for r in sorted(got[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_stages_keep_the_columns(spark, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, no_docs, SF).count() == 0, name


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name]).df().fillna(-1)
    got = QUERIES[name](spark, SF).toPandas()[list(want.columns)].fillna(-1)  # the root has no parent
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))


def test_query_columns(spark, documents):
    out = QUERIES["op4_decontamination"](spark, SF).toPandas()
    assert list(out.columns) == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    want = brute_hits(list(zip(documents["doc_id"], documents["text"])), list(zip(bench["item_id"], bench["text"])))
    for r in out.itertuples():
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want[r.doc_id]
    assert out.loc[~out["contaminated"], "items_sha256"].eq(hashlib.sha256(b"").hexdigest()).all()
    out = QUERIES["op8_quality"](spark, SF).toPandas()
    assert list(out.columns) == ["doc_id", "held_out", "score", "predicted"] and str(out["predicted"].dtype) == "int32"
    assert out["held_out"].tolist() == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out["doc_id"]]

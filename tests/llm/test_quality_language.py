import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from salesflow.llm import language, quality

from .conftest import prose


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    n1 = int(label.sum())
    return (rank[label == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(label) - n1))


def test_statistics_of_simple_texts():
    x = quality.statistics(pa.array(["Ab cd cd\nx!", "", None, "é"]))
    get = lambda i, n: x[i, quality.NAMES.index(n)]
    assert np.isclose(get(0, "log_bytes"), np.log1p(11)) and np.isclose(get(0, "log_words"), np.log1p(4))
    assert np.isclose(get(0, "distinct"), 3 / 4) and np.isclose(get(0, "top_word"), 2 / 4) and np.isclose(get(0, "same_as_before"), 1 / 4)
    assert np.isclose(get(0, "share_upper"), 1 / 11) and np.isclose(get(0, "loud_marks"), 1 / 4) and np.isclose(get(0, "lines_distinct"), 1)
    assert not x[1].any() and not x[2].any() and get(3, "share_wide") == 1


def test_flattened_forest_equals_a_walk_over_nodes():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    f = quality.fit(x, y, trees=20)
    for i in range(0, 400, 37):
        total = f.base
        for t in range(len(f.feature)):
            node = 0
            while node < f.feature.shape[1]:
                node = 2 * node + (2 if x[i, f.feature[t, node]] > f.cut[t, node] else 1)
            total += f.leaf[t, node - f.feature.shape[1]]
        assert np.isclose(total, f.raw(x[i:i + 1])[0])
    assert ((f.score(x) > 0.5) == (y == 1)).mean() > 0.95


def test_quality_learns_and_leaves_labels_of_held_out_rows_alone(spark):
    rows = [(i, prose(i, 60) if i % 4 else prose(i, 60).upper().replace(" ", "!! "), 1 if i % 4 else 0) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    forest = quality.train(docs, labels)
    out = quality.score(docs, forest).select("doc_id", "score", "predicted", quality.held_out().alias("held")).toPandas().set_index("doc_id")
    truth = np.array([q for _, _, q in rows])
    assert auc(out.loc[range(400), "score"].to_numpy(), truth) > 0.99
    assert out["held"].sum() > 50
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.score(docs, quality.train(docs, flipped)).toPandas().set_index("doc_id")
    assert np.allclose(out["score"], again.loc[out.index, "score"])
    kept = quality.score(docs, forest, keep_only=True)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(out.index[out["predicted"] == 1])


def test_quality_edge_cases(spark, docs, no_docs, cluttered):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(no_docs, quality.train(no_docs, none)).count() == 0
    assert quality.score(docs, quality.train(docs, none), keep_only=True).count() == docs.count()
    odd = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 0), (5, 1), (12, 0)], "doc_id long, quality int")
    out = quality.score(cluttered, quality.train(cluttered, odd))
    assert sorted(out.columns) == sorted(cluttered.columns)
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]


def tongue(name, seed, n=40):
    syllables = {"aa": "la mi so ta", "bb": "krz pfa stu wok", "cc": "ña éta où lçe", "dd": "ing the wh ou", "ee": "щи жа лю бо", "ff": "øre åse kjø vær"}[name].split()
    r = random.Random(f"{name}{seed}")
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n))


def test_language_held_out_accuracy_for_few_and_many(spark):
    for names in (["aa", "bb"], ["aa", "bb", "cc", "dd", "ee", "ff"]):
        rows = [(i, tongue(names[i % len(names)], i), names[i % len(names)]) for i in range(60 * len(names))]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        held = quality.held_out()
        out = language.predict(docs, language.train(docs, ~held)).join(docs, "doc_id").select("*", held.alias("held")).toPandas()
        test = out[out["held"]]
        assert (test["lang_pred"] == test["lang"]).mean() > 0.97 and out["score"].between(0, 1).all()


def test_codewords_are_apart_and_split():
    for n in (2, 3, 4, 5, 9, 30):
        code = language.codewords(n)
        assert (np.abs(code.sum(0)) < n).all()
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= (1 if n == 2 else 2 if n == 3 else 4)


def test_language_ambiguity_and_edge_cases(spark, docs, no_docs, cluttered):
    model = language.train(docs, F.lit(True))
    assert model.languages == ["de", "en", "fr", "ja"]
    out = {r["doc_id"]: r for r in language.predict(cluttered, model).collect()}
    for i in (4, 5, 10, 15):
        assert (out[i]["lang_pred"], out[i]["score"]) == ("und", 0.0)
    assert all(out[i]["lang_pred"] in model.languages for i in (1, 6, 12, 13, 14, 18))
    assert out[1]["lang_pred"] == out[2]["lang_pred"] and out[1]["score"] == out[2]["score"]
    assert language.predict(no_docs, model).count() == 0
    nothing = language.train(no_docs, F.lit(True))
    assert {r["lang_pred"] for r in language.predict(docs, nothing).collect()} == {"und"}
    only = language.train(docs.where("lang = 'de'"), F.lit(True))
    assert {r["lang_pred"] for r in language.predict(docs, only).collect()} == {"und", "de"}
    even = language.decode(np.zeros((1, model.words.shape[1])), model)
    assert even[2][0]


def test_held_out_figures_on_the_given_tables(spark):
    """Accuracy of the languages and ranking of the quality labels on rows that were not learnt from."""
    from salesflow.llm.queries import QUERIES
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = QUERIES["op5_language"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred <> 'und'")
    rows = found.select("lang", "lang_pred").collect()
    assert len(rows) > 100 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    scored = QUERIES["op8_quality"](spark, "/root/testdata/sf0.01").join(labels.select("doc_id", "quality"), "doc_id").where("held_out").select("score", "quality").collect()
    good, bad = [r["score"] for r in scored if r["quality"] == 1], [r["score"] for r in scored if r["quality"] == 0]
    assert len(good) > 20 and len(bad) > 10
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) >= 0.95 * len(good) * len(bad)

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.operators import blocks as B
from salesflow.operators import sketched as SK
from salesflow.operators import windows as W
from salesflow.plans import io_q, missing_q, selection_q
from salesflow.plans.common import spool


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_running_sums_take_more_tasks_for_more_rows(spark, monkeypatch, capsys):
    df = spark.range(600).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"), F.lit(1).alias("n")).checkpoint()
    monkeypatch.setattr(B, "ROWS_PER_TASK", 20)
    out = B.prefix_sums_by_value(df, ["g"], "v", ["n"])
    assert "30), REPARTITION_BY_NUM" in plan(out, capsys)
    assert sorted((r["g"], r["v"], r["cum_n"]) for r in out.collect()) == sorted((i % 2, float(i), i // 2 + 1.0) for i in range(600))


def test_quantiles_in_brackets_of_repeated_values(spark):
    values = [0.0] * 50 + [1.0] * 3 + [float(i) for i in range(200)] + [7.0] * 90
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered, probs = sorted(values), [0.0, 0.1, 0.5, 0.77, 1.0]

    def exact(p):
        at = (len(ordered) - 1) * p
        low = int(at)
        return ordered[low] + (ordered[min(low + 1, len(ordered) - 1)] - ordered[low]) * (at - low)

    got = {r["p"]: r["q"] for r in B.bracket_quantiles(df, [], "v", probs, accuracy=20).collect()}
    assert all(abs(got[p] - exact(p)) < 1e-9 for p in probs)


def test_chunks_are_dealt_to_tasks_by_rows(spark, monkeypatch, capsys):
    df = spark.range(300).select(F.lit("a").alias("g"), "id", F.col("id").cast("double").alias("y"))
    monkeypatch.setattr(B, "ROWS_PER_TASK", 10)
    out = W.add_lags(df, "y", ["g"], ["id"], lags=(1,), chunk_rows=20)
    assert "30), REPARTITION_BY_NUM" in plan(out, capsys)
    assert all(r["y_lag_1"] == (r["id"] - 1 if r["id"] else None) for r in out.collect())


def test_sketches_of_a_day_stand_side_by_side(spark, capsys):
    rows = [(datetime.date(2024, 1, 1), 1.0, None), (datetime.date(2024, 1, 1), None, None), (datetime.date(2024, 1, 2), float("nan"), 2.0)]
    out = SK.daily_summaries(spark.createDataFrame(rows, "date date, a double, b double"), ["a", "b"])
    assert "Expand" not in plan(out, capsys)
    assert sorted((r["day"].day, r["feature"], r["n"]) for r in out.collect()) == [(1, "a", 1), (2, "b", 1)]


def test_selection_reads_one_copy_of_its_columns(spark, monkeypatch, capsys):
    x = spark.createDataFrame([(float(i), float(i % 3), float(i % 5)) for i in range(20)], "price double, predicted double, sales double")
    seen = []

    def correlations(df, *args):
        seen.append(plan(df, capsys))
        return spark.createDataFrame([("price", 0.5, 1)], "feature string, corr double, n long")

    joined = x.join(x.select("price").distinct(), "price")
    monkeypatch.setattr(missing_q, "_nan", lambda *a: joined)
    monkeypatch.setattr(missing_q.FS, "correlations", correlations)
    missing_q.spearman_nulls(spark, "")
    assert "Join" not in seen[0] and "parquet" in seen[0].lower()
    assert sorted(spool(joined, "test-copy").collect()) == sorted(joined.collect())


def test_consensus_reads_one_copy_of_its_columns(spark, monkeypatch, capsys):
    cols = [*selection_q.FEATS, selection_q.TARGET]
    x = spark.range(40).select(*[((F.col("id") * (i + 3)) % (7 + i)).cast("double").alias(c) for i, c in enumerate(cols)])
    monkeypatch.setattr(selection_q, "_frame", lambda *a: x)
    seen, by_f_test = [], selection_q.FS.by_f_test
    monkeypatch.setattr(selection_q.FS, "by_f_test", lambda df, *a: (seen.append(plan(df, capsys)), by_f_test(df, *a))[1])
    assert selection_q.consensus(spark, "").count() and "parquet" in seen[0].lower()


def test_appended_rows_are_found_by_all_tasks(spark, monkeypatch, tmp_path):
    rows = [(i, 1, 1, 1, "N" if i % 2 else "R", "O", datetime.datetime(2024, 1, 1)) for i in range(1, 129)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string, "
                                "l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")

    def refuse(*args):
        raise AssertionError("one task would scan the whole table")

    monkeypatch.setattr(DataFrame, "coalesce", refuse)
    monkeypatch.setattr(type(spark.range(1)), "coalesce", refuse)
    out = {r["l_returnflag"]: r for r in io_q.partition_status(spark, str(tmp_path)).collect()}
    assert {k: (r["n_rows"], r["status"], r["files_read"]) for k, r in out.items()} == {"N": (68, "changed", 1), "R": (64, "unchanged", 1)}

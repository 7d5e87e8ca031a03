"""Exact small-sample statistics, verified duplicates, grouped reports, fingerprints by partition, appended monitoring rows."""
import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesflow.operators import drift as D
from salesflow.operators import monitor as PM
from salesflow.operators import models as M
from salesflow.operators import quality as Q
from salesflow.operators import summary as S
from salesflow.session import scratch_path
from salesflow.sources import io as IO


def paths(n, m):
    """How many merges of n and m elements reach each largest |i/n - j/m| (times n m)."""
    found = Counter()
    for places in itertools.combinations(range(n + m), n):
        i = j = worst = 0
        places = set(places)
        for k in range(n + m):
            i, j = (i + 1, j) if k in places else (i, j + 1)
            worst = max(worst, abs(i * m - j * n))
        found[worst] += 1
    return found


def test_exact_pvalue_equals_path_enumeration(spark):
    want = {}
    for n in range(1, 7):
        for m in range(1, 7):
            found, total = paths(n, m), math.comb(n + m, n)
            for worst in found:
                want[n, m, worst / (n * m)] = sum(c for w, c in found.items() if w >= worst) / total
    want[3, 4, 0.0] = 1.0
    df = spark.createDataFrame([(n, m, d) for n, m, d in want], "n long, m long, d double")
    for r in df.select("*", D.exact_pvalue(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect():
        assert math.isclose(r["p"], want[r["n"], r["m"], r["d"]], abs_tol=1e-12), r


def test_exact_pvalue_near_the_asymptotic_one_for_larger_samples(spark):
    df = spark.createDataFrame([(700, 900, 0.06), (1000, 1000, 0.05), (400, 1500, 0.1)], "n long, m long, d double")
    out = df.select(D.exact_pvalue(F.col("d"), F.col("n"), F.col("m")).alias("p"),
                    D.kolmogorov_pvalue(F.col("d"), F.col("n").cast("double"), F.col("m").cast("double")).alias("q"),
                    D.ks_pvalue(F.col("d"), F.col("n"), F.col("m"), 100).alias("series")).collect()
    assert all(abs(r["p"] - r["q"]) < 0.03 and r["series"] == r["q"] for r in out)


def test_pruned_ks_keeps_null_groups(spark):
    r = random.Random(3)
    rows = [(r.choice(["a", None]), r.choice(["reference", "current"]), r.gauss(0, 1)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, period string, x double")
    full = {x["g"]: x["ks_statistic"] for x in D.ks_statistics(df, ["x"], "period", by=["g"]).collect()}
    pruned = {x["g"]: x["ks_statistic"] for x in D.ks_pruned(df, ["x"], "period", by=["g"], buckets=16).collect()}
    assert set(full) == {"a", None} and all(math.isclose(full[g], pruned[g]) for g in full)


@pytest.mark.parametrize("buckets", [None, 1, 5])
def test_duplicates_are_counted_exactly_whatever_the_hash(spark, monkeypatch, buckets):
    if buckets:  # hashes that collide for different rows
        monkeypatch.setattr(Q, "_row_hash", lambda df: [F.pmod(F.xxhash64(df.columns[0]), F.lit(buckets)).alias("_h1"), F.lit(0).alias("_h2")])
    r = random.Random(8)
    rows = [(r.choice([None, 1, 2]), r.choice([None, "x", "y"]), r.choice([0.0, -0.0, float("nan"), None, 1.5]), i % 9) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b string, c double, d int")
    key = lambda t: (t[0], t[1], "nan" if t[2] is not None and math.isnan(t[2]) else t[2], t[3])
    want = len(rows) - len({key(t) for t in rows})
    assert Q.exact_duplicates(df).first()["dup"] == want > 0
    by = {x["a"]: x["dup"] for x in Q.exact_duplicates(df, ["a"]).collect()}
    assert by == {a: n for a in (None, 1, 2) if (n := len([t for t in rows if t[0] == a]) - len({key(t) for t in rows if t[0] == a}))}
    unique = spark.range(50).withColumn("b", F.lit("x"))
    report = {x["check"]: x["observed"] for x in Q.duplicate_checks(unique, keys=("b",)).collect()}
    assert report == {"duplicates": 0.0, "key_duplicates": 49.0}


def test_unique_rows_do_not_travel_whole(spark):
    df = spark.createDataFrame([(i, "wide" * 10) for i in range(50)], "id long, text string")
    plan = Q.exact_duplicates(df)._jdf.queryExecution().executedPlan().toString()
    # the one exchange of whole rows lies above the semi-join with the repeated hashes
    assert "LeftSemi" in plan and plan.index("Exchange hashpartitioning(id") < plan.index("LeftSemi")


def test_grouped_report_equals_one_report_for_each_group(spark):
    r = random.Random(5)
    rows = [(f"2024-01-{r.randrange(1, 29):02d}", r.choice(["n", "s", None]), r.choice("ab"), "c", r.choice([10.0, 12.0, -1.0, 900.0, None]), r.randrange(1, 5), 30.0)
            for _ in range(200)]
    df = spark.createDataFrame(rows, "date string, region string, product string, category string, price double, quantity int, sales double") \
        .withColumn("date", F.to_date("date"))
    got = {}
    for x in Q.validate(df, by=["region"]).collect():
        got.setdefault(x["region"], set()).add((x["check"], x["column"], x["status"], x["observed"]))
    for region in ("n", "s", None):
        own = df.where(F.col("region").eqNullSafe(F.lit(region)))
        skip = {("schema", "region"), ("completeness", "region"), ("critical_completeness", "region")}
        want = {(x["check"], x["column"], x["status"], x["observed"]) for x in Q.validate(own).collect() if (x["check"], x["column"]) not in skip}
        assert got[region] == want
    verdicts = {x["region"]: x["is_valid"] for x in Q.verdict(Q.validate(df, by=["region"]), by=["region"]).collect()}
    assert verdicts == {g: not any(s == "failed" for _, _, s, _ in v) for g, v in got.items()}
    text = Q.report_text(Q.validate(df))
    assert text.startswith("INVALID: ") and any(line.startswith("- value_ranges of price: failed (observed ") for line in text.split("\n"))


def test_grouped_runs_and_alerts(spark):
    runs = spark.createDataFrame([("x", "r1", 1.0, 0.5), ("x", "r2", 2.0, 0.9), (None, "r3", 5.0, 0.1), (None, "r4", 4.0, 0.1), ("y", "r5", None, 0.3)],
                                 "g string, run_id string, rmse double, r2 double")
    flags = {x["run_id"]: (x["best_rmse"], x["best_r2"]) for x in M.compare_models(runs, metrics=("rmse", "r2"), by=["g"]).collect()}
    assert flags == {"r1": (True, False), "r2": (False, True), "r3": (False, True), "r4": (True, True), "r5": (None, True)}
    assert {x["g"]: x["run_id"] for x in M.best_run(runs, "rmse", by=["g"]).collect()} == {"x": "r1", None: "r4"}
    assert [x["run_id"] for x in M.search_runs(runs, "r2", False, 1, by=["g"]).collect()] == ["r2", "r5", "r3"]
    alerts = spark.createDataFrame([(1, "a", "info", 5, False), (2, "a", "critical", 1, False), (3, "b", "warning", 1, False), (4, "a", "warning", 9, True),
                                    (5, "a", "warning", 2, False)], "alert_id int, alert_type string, severity string, timestamp int, resolved boolean")
    ids = lambda df: [x["alert_id"] for x in df.collect()]
    assert ids(PM.open_alerts(alerts, 2)) == [5, 3] and ids(PM.open_alerts(alerts, 2, by_rank=True)) == [2, 5]
    assert sorted(ids(PM.open_alerts(alerts, 1, by_rank=True, by=["alert_type"]))) == [2, 3]


def test_one_sided_degradation(spark):
    df = spark.createDataFrame([(10.0, 11.0), (20.0, 19.0)], "y double, p double")
    base = PM.baseline_frame(spark, {"rmse": 5.0, "mae": 0.5})
    two = {x["metric"]: x["is_degraded"] for x in PM.check_performance(df, base, "y", "p").collect()}
    one = {x["metric"]: x["is_degraded"] for x in PM.check_performance(df, base, "y", "p", one_sided=True).collect()}
    assert two == {"rmse": True, "mae": True} and one == {"rmse": False, "mae": True}


def test_domain_rows_and_listed_domain(spark, monkeypatch):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), (None, "x")], "p string, q string")
    assert sorted(map(tuple, S.domain(df, ["p", "q"]).collect())) == [("p", "a", 1), ("p", "b", 1), ("q", "x", 3)]
    monkeypatch.setattr(S, "MAX_LISTED", 1)
    with pytest.raises(ValueError, match="domain of 2"):
        S.distinct_values(df, ["p", "q"], with_values=True)


def test_tree_reads_only_what_changed_and_names_it(spark):
    path = scratch_path(spark, "tree")
    df = spark.range(400).select("id", F.concat(F.lit("t"), "id").alias("text"), (F.col("id") % 4).alias("part"))
    df.repartition(3).write.partitionBy("part").parquet(path)
    old = IO.fingerprint_tree(spark.read.parquet(path), ["part"]).checkpoint()
    same, read = IO.refresh_tree(spark, path, old, ["part"])
    assert read == 0 and {x["status"] for x in IO.tree_status(old, same, ["part"]).collect()} == {"unchanged"}
    extra = spark.createDataFrame([(1000, "new", 2), (1001, None, 7)], "id long, text string, part long")
    extra.coalesce(1).write.mode("append").partitionBy("part").parquet(path)
    new, read = IO.refresh_tree(spark, path, old, ["part"])
    assert read == 2
    assert {x["part"]: (x["status"], x["n_rows"]) for x in IO.tree_status(old, new, ["part"]).collect()} == {
        0: ("unchanged", 100), 1: ("unchanged", 100), 2: ("changed", 101), 3: ("unchanged", 100), 7: ("new", 1)}
    # the same rows in other files and another order: unchanged content
    again = scratch_path(spark, "tree")
    df.orderBy(F.desc("id")).repartition(5).write.partitionBy("part").parquet(again)
    moved = IO.fingerprint_tree(spark.read.parquet(again), ["part"])
    assert {x["status"] for x in IO.tree_status(old, moved, ["part"]).collect()} == {"unchanged"}
    total, parts = IO.roll_up(new, []).first(), IO.roll_up(new, ["part"]).collect()
    assert total["digest"] == sum(p["digest"] for p in parts) and total["n_rows"] == 402
    gone = IO.tree_status(new, new.where("part <> 7"), ["part"]).where("status <> 'unchanged'").collect()
    assert [(x["part"], x["status"]) for x in gone] == [(7, "removed")]
    assert IO.row_digest(spark.range(1)) is not None


def test_appended_monitoring_rows_replace_their_day(spark):
    r = random.Random(1)
    rows = [(f"2024-0{1 + i // 100}-{1 + i % 28:02d}", r.gauss(0, 1) + (i > 250)) for i in range(300)]
    df = spark.createDataFrame(rows, "date string, x double").withColumn("date", F.to_date("date"))
    path = scratch_path(spark, "drift-metrics")
    for as_of in ("2024-02-28", "2024-03-28", "2024-03-28"):
        D.append_drift_metrics(D.monitoring_run(df.where(F.col("date") <= as_of), ["x"], "date"), path)
    out = D.read_drift_metrics(spark, path)
    assert sorted(str(x["as_of"]) for x in out.collect()) == ["2024-02-28", "2024-03-28"]
    assert D.read_drift_metrics(spark, path, since="2024-03-01").count() == 1 and D.read_drift_metrics(spark, path, ["y"]).count() == 0
    assert "as_of" in out.columns and "day" not in out.columns

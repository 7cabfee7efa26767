import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.functions.exprs import pearson, slug
from tablewright.functions.order_stats import exact_quantiles
from tablewright.functions.running import running_totals
from tablewright.operators import explore, metrics, profiling, split


def _frame(spark, **cols):
    return spark.createDataFrame(pd.DataFrame(cols))


@pytest.mark.parametrize("kind", ["uniform", "one_hot_value", "lognormal", "tiny"])
def test_quantiles_are_exact(spark, kind):
    rng = np.random.default_rng(1)
    values = {
        "uniform": rng.uniform(size=20_011),
        # a third of the rows share one value
        "one_hot_value": np.where(np.arange(9_000) % 3 == 0, 5.0, rng.normal(size=9_000)),
        "lognormal": rng.lognormal(sigma=3, size=5_003),
        "tiny": np.array([1.0, 2.0, 3.0, 10.0]),
    }[kind]
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(_frame(spark, v=values), ["v"], probs).orderBy("prob").collect()
    assert [r["value"] for r in got] == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)


def test_quantiles_narrow_brackets_find_their_rank(spark, monkeypatch):
    # a coarse sketch on many rows: the brackets cut most rows away
    from tablewright.functions import order_stats

    monkeypatch.setattr(order_stats, "ACCURACY", 50)
    monkeypatch.setattr(order_stats, "SLACK", 3.0 / 50)
    rng = np.random.default_rng(3)
    v, g = rng.normal(size=40_000), rng.integers(0, 3, size=40_000)
    got = order_stats.exact_quantiles(_frame(spark, v=v, g=g), ["v"], [0.25, 0.5], by=["g"]).collect()
    for r in got:
        assert r["value"] == pytest.approx(np.quantile(v[g == r["g"]], r["prob"]), rel=1e-12)


def test_quantiles_skip_nulls_and_keep_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), (None, 7.0)], "g string, v double")
    got = {r["g"]: r["value"] for r in exact_quantiles(df, ["v"], [0.5], by=["g"]).collect()}
    assert got == {"a": 2.0, None: 7.0}


def test_running_totals(spark):
    rng = np.random.default_rng(2)
    n = 5_000
    pdf = pd.DataFrame({"m": ["a"] * n + ["b"] * n, "s": np.concatenate([rng.permutation(n), rng.permutation(n)]).astype(float), "c": rng.integers(1, 9, 2 * n)})
    got = running_totals(spark.createDataFrame(pdf), ["m"], "s", ["c"], descending=True).toPandas()
    pdf = pdf.sort_values(["m", "s"], ascending=[True, False])
    pdf["c_before"] = pdf.groupby("m")["c"].cumsum() - pdf["c"]
    both = got.merge(pdf, on=["m", "s"])
    assert (both["c_before_x"] == both["c_before_y"]).all() and len(both) == 2 * n


def test_auc_equals_pair_counting(spark):
    rng = np.random.default_rng(4)
    y, s = rng.integers(0, 2, 600), np.round(rng.normal(size=600), 1)
    diff = s[y == 1][:, None] - s[y == 0][None, :]
    want = (np.sum(diff > 0) + 0.5 * np.sum(diff == 0)) / diff.size
    got = metrics.roc_auc(_frame(spark, model=["m"] * 600, y=y, score=s)).first()["ROC_AUC"]
    assert got == pytest.approx(want, abs=1e-12)


def test_auc_is_null_without_scores_or_classes(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", 1, 0.5), ("c", 0, 0.1), ("c", 1, 0.2)], "model string, y int, score double")
    got = {r["model"]: r["ROC_AUC"] for r in metrics.roc_auc(df).collect()}
    assert got == {"a": None, "b": None, "c": 1.0}


@pytest.mark.parametrize("factor", [1.0, 250.0])
def test_errors_scale_with_the_target_and_r2_does_not(spark, factor):
    rng = np.random.default_rng(11)
    y = rng.normal(50, 9, 300) * factor
    p = y + rng.normal(0, 3, 300) * factor
    r = metrics.regression_metrics(_frame(spark, model=["m"] * 300, y=y, p=p)).first()
    assert r["RMSE"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2))) and r["MAE"] == pytest.approx(np.mean(np.abs(y - p)))
    assert r["R2"] == pytest.approx(1 - np.var(y - p) / np.var(y), abs=1e-3)


def test_label_scores_from_the_counts_of_a_random_table(spark):
    rng = np.random.default_rng(12)
    y, p = rng.integers(0, 2, 500), rng.integers(0, 2, 500)
    r = metrics.label_metrics(_frame(spark, model=["m"] * 500, y=y, p=p)).first()
    hits = np.sum((y == 1) & (p == 1))
    assert r["Recall_failure"] == pytest.approx(hits / y.sum()) and r["Precision_failure"] == pytest.approx(hits / p.sum())
    share = lambda c: 2 * np.sum((y == c) & (p == c)) / (np.sum(y == c) + np.sum(p == c))
    assert r["F1_weighted"] == pytest.approx(sum(share(c) * np.mean(y == c) for c in (0, 1)))


def test_scores_without_positive_rows_are_zero(spark):
    for y, p, f1 in (([0, 0, 0, 0], [0, 0, 0, 0], 1.0), ([0, 0, 0, 0], [1, 1, 1, 1], 0.0)):
        r = metrics.label_metrics(_frame(spark, model=["m"] * 4, y=y, p=p)).first()
        assert (r["Precision_failure"], r["Recall_failure"], r["F1_failure"], r["F1_weighted"]) == (0, 0, 0, f1)


def test_baseline_takes_the_commonest_training_class(spark):
    rows = [("train", c) for c in [2] * 5 + [7] * 5 + [1] * 4] + [("test", c) for c in [2, 7, 7, 1, 1, 1, 2, 2]]
    r = metrics.majority_baseline(spark.createDataFrame(rows, "split string, t int"), "t").first()
    assert r["majority_class"] == 2 and r["baseline_accuracy"] == 3 / 8  # of two equal ones, the smaller
    assert r["baseline_f1_weighted"] == pytest.approx(3 / 8 * (2 * 3 / 11)) and r["test_rows"] == 8


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "a double, b double")
    assert df.agg(pearson(F.col("a"), F.col("b"))).first()[0] is None


def test_slug(spark):
    names = ["7. Random Forest Regressor", "10. K-Nearest Neighbors Regressor", "A4. Decision Tree Classifier", "5. Polynomial (deg 2) + Linear"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(slug(F.col("n"))).collect()] == [
        "07_random_forest_regressor",
        "10_k_nearest_neighbors_regressor",
        "A4_decision_tree_classifier",
        "05_polynomial_deg_2_linear",
    ]


def test_split_sizes_and_class_shares(spark):
    n = 10_000
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") < 339).cast("int").alias("t"))
    plain = split.hold_out(df, ["k"]).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in plain} == {"test": 2000, "train": 8000}
    strat = split.hold_out(df, ["k"], stratify="t").where("split = 'test'").groupBy("t").count().collect()
    assert {r["t"]: r["count"] for r in strat} == {0: 1932, 1: 68}
    folds = split.k_folds(df, ["k"], stratify="t").groupBy("t", "fold").count().collect()
    assert sorted(r["count"] for r in folds if r["t"] == 1) == [67, 68, 68, 68, 68]


def test_split_of_tiny_and_odd_sizes(spark):
    for n in (1, 2, 4, 7):
        rows = split.hold_out(spark.range(n).withColumnRenamed("id", "k"), ["k"]).collect()
        assert sum(r["split"] == "test" for r in rows) == -(-n // 5)


def test_binned_split_merges_equal_edges(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") < 60, 1.0).otherwise(F.col("id") * 1.0).alias("y"))
    bins = split.quantile_bins(df, "y", 4).groupBy("bin").count().orderBy("bin").collect()
    want = pd.qcut(pd.Series([1.0] * 60 + [float(i) for i in range(60, 100)]), 4, labels=False, duplicates="drop").value_counts().sort_index()
    assert [r["count"] for r in bins] == list(want)


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.normal(size=501), "t": rng.choice(["x", "y", "z"], 501)})
    got = {r["column"]: r for r in profiling.describe(spark.createDataFrame(pdf)).collect()}
    want = pdf["a"].describe()
    row = got["a"]
    assert [row[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(list(want))
    assert got["t"]["unique"] == 3 and got["t"]["freq"] == pdf["t"].value_counts().max()


def test_histogram_matches_numpy_auto(spark):
    rng = np.random.default_rng(6)
    v = rng.gamma(2.0, size=3_000)
    counts, edges = np.histogram(v, bins="auto")
    got = explore.histogram(_frame(spark, v=v), ["v"]).orderBy("bin").collect()
    assert [r["count"] for r in got] == list(counts)
    assert [r["lower"] for r in got] == pytest.approx(list(edges[:-1]))


def test_density_integrates_to_almost_one(spark):
    v = np.random.default_rng(7).normal(size=4_000)
    got = explore.density(_frame(spark, v=v), ["v"]).orderBy("point").toPandas()
    assert np.trapezoid(got["density"], got["x"]) == pytest.approx(1.0, abs=0.01)


def test_constant_column_survives_histogram_and_density(spark):
    df = _frame(spark, v=[2.0, 2.0, 2.0])
    assert explore.histogram(df, ["v"]).agg(F.sum("count")).first()[0] == 3
    assert explore.density(df, ["v"]).where("density IS NOT NULL").count() == 0


def test_duplicates_keep_the_first_row(spark):
    df = spark.createDataFrame([("r1", 1, "a"), ("r2", 1, "a"), ("r3", 2, None), ("r4", 2, None)], "id string, x int, y string")
    kept = profiling.drop_duplicates(df, ["x", "y"], "id").collect()
    assert sorted(r["id"] for r in kept) == ["r1", "r3"]
    assert profiling.duplicate_rows(df, ["x", "y"]).first()["duplicate_rows"] == 2


def test_an_eager_split_computes_each_digest_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def key(i):
        seen.add(1)
        return f"k{i}"

    rows = spark.range(0, 900, 1, 3).withColumn("key", key("id")).withColumn("class", F.col("id") % 3)
    for by in (None, "class"):
        before = seen.value
        eager = split.hold_out(rows, ["key"], stratify=by, eager=True)
        assert seen.value - before == 900
        assert sorted(eager.collect()) == sorted(split.hold_out(rows, ["key"], stratify=by).collect())


def test_tables_that_differ_nowhere_shuffle_no_rows(spark):
    """Buckets of rows are compared by their sums; the rows of those that differ alone are counted whole."""
    schema, nan = "id long, x double, s string", float("nan")
    rows = [(1, 0.0, "a"), (1, 0.0, "a"), (2, nan, None), (3, None, "c"), (None, 1.0, "d"), (5, 2.0, "e"), (None, None, None)]
    other = [(1, -0.0, "a"), (2, nan, None), (3, None, "c"), (None, 1.0, "d"), (6, 2.0, "e"), (6, 2.0, "e"), (None, None, None), (None, 3.0, None)]

    def compared(a, b):
        found = split.rows_in_one_only(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema))
        return tuple(found.collect()[0]), found._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]

    assert compared(rows, other)[0] == (2, 3)
    assert compared([(1, None, "a")], [(None, 1.0, "a")])[0] == (1, 1)
    assert compared([], [])[0] == (0, 0)
    same, plan = compared(rows, rows[::-1])
    assert same == (0, 0) and "hashpartitioning" not in plan

"""NaN counts as missing, outliers stay cheap, and function features reach a model."""

from decimal import Decimal

import hashlib

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tablewright import session
from tablewright.functions.order_stats import exact_quantiles
from tablewright.operators import explore, features, profiling
from tablewright.session import spread_out
from tablewright.sources import readers
from tablewright.sources.contracts import DATASETS

NAN = float("nan")


@pytest.fixture(scope="module")
def holed(spark):
    rows = [(1, 1.0, "a"), (2, NAN, "b"), (3, 3.0, "a"), (4, 5.0, None), (5, None, "a")]
    return spark.createDataFrame(rows, "row_id long, x double, s string")


def test_audit_counts_nan_as_missing(holed):
    got = {r["column"]: (r["missing"], r["n_unique"]) for r in profiling.audit(holed, "row_id").collect()}
    assert got == {"x": (2, 3), "s": (1, 2)}


def test_summary_counts_nan_as_missing(holed):
    assert profiling.summary(holed, columns=["x", "s"]).first()["missing_cells"] == 3


def test_median_and_description_leave_out_nan(holed):
    assert exact_quantiles(holed, ["x"], [0.5]).first()["value"] == 3.0
    row = profiling.numeric_description(holed, ["x"]).first()
    assert (row["count"], row["mean"], row["min"], row["max"]) == (3, 3.0, 1.0, 5.0)


def test_preparation_fills_nan_with_the_median(holed):
    model = features.TabularFeatures(numeric=["x"], categorical=["s"], scale=False).fit(holed)
    first = {r["row_id"]: r["features"][0] for r in model.transform(holed).collect()}
    assert first == {1: 1.0, 2: 3.0, 3: 3.0, 4: 5.0, 5: 3.0}


def test_target_profile_leaves_out_nan(holed):
    assert {r["value"]: r["count"] for r in profiling.value_counts(holed, "x").collect()} == {1.0: 1, 3.0: 1, 5.0: 1}


def test_histogram_of_an_outlier(spark):
    rows = spark.range(1000).selectExpr("cast(id % 100 as double) as x").unionAll(spark.sql("select 1e15 as x"))
    got = explore.histogram(rows, ["x"]).orderBy("bin").collect()
    assert sum(r["count"] for r in got) == 1001
    assert len(got) <= 1002
    assert all(a["upper"] == pytest.approx(b["lower"]) for a, b in zip(got, got[1:]))


def test_histogram_lists_short_runs_of_empty_bins(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (9.5,), (10.0,)], "x double")
    got = [(r["bin"], r["count"]) for r in explore.histogram(rows, ["x"], bins=10).orderBy("bin").collect()]
    assert got == [(0, 1), (1, 1), *[(b, 0) for b in range(2, 9)], (9, 2)]


def test_added_columns_of_both_kinds_run_in_pipelines(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "a double, b double")
    stage = features.FunctionStage(lambda df: df.withColumn("ab", F.col("a") * F.col("b")).withColumn("size", F.expr("if(a > 2, 'big', 'small')")))
    added = features.AddedColumns(stage, (("ab", "double"), ("size", "string")))
    numeric, texts = features.with_feature(["a", "b"], [], added)
    assert (numeric, texts) == (["a", "b", "ab"], ["size"])
    stages = [*features.hook_stages(added), features.TabularFeatures(numeric=numeric, categorical=texts, scale=False)]
    out = Pipeline(stages=stages).fit(rows).transform(rows)
    assert sorted(tuple(r["features"]) for r in out.collect()) == [(1.0, 2.0, 2.0, 1.0), (3.0, 4.0, 12.0, 0.0)]


def test_columns_that_were_declared_must_be_added(spark):
    rows = spark.createDataFrame([(1.0,)], "a double")
    added = features.AddedColumns(features.FunctionStage(lambda df: df), (("b", "int"),))
    with pytest.raises(ValueError, match="not added"):
        features.apply_feature(rows, added)
    whole = features.AddedColumns.by_sql("half of it", b=("decimal(9, 2)", "a / 2"), c=("string", "'x'"))
    assert features.apply_feature(rows, whole).first()["b"] == Decimal("0.50")
    assert whole.split_by_type() == (["b"], ["c"])


def test_sources_of_many_files_are_hashed(spark, tmp_path):
    spec = DATASETS["regression"]
    folder = tmp_path / spec.filename
    folder.mkdir()
    parts = {"a.csv": b"x,y\n1,2\n", "b.csv": b"x,y\n3,4\n"}
    for name, data in parts.items():
        (folder / name).write_bytes(data)
    df = spark.read.option("header", True).csv(str(folder))
    got = readers.provenance(spark, spec, str(tmp_path), df).first()
    listed = "\n".join(f"{n} {len(d)} {hashlib.sha256(d).hexdigest()}" for n, d in sorted(parts.items()))
    assert got["sha256"] == hashlib.sha256(listed.encode()).hexdigest()
    assert got["size_bytes"] == sum(map(len, parts.values()))


def test_spreading_runs_no_job(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).distinct()
    spark.sparkContext.setJobGroup("spreading", "none expected")
    try:
        spread_out(df, "id")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("spreading")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_parts_grow_with_the_source(spark, tmp_path, monkeypatch):
    """A part of a table stays as small as ever, whatever the table's size and however its files are named."""
    folder = tmp_path / "with space%41.parquet"
    spark.range(100_000).selectExpr("id", "uuid() AS v").coalesce(1).write.parquet(str(folder))
    df = spark.read.parquet(str(folder))
    size = sum(f.stat().st_size for f in folder.glob("*.parquet"))
    monkeypatch.setattr(session, "PART_BYTES", size // 40)
    spread = spread_out(df, "id")
    assert spread.rdd.getNumPartitions() in (40, 41) and spread.count() == 100_000
    monkeypatch.setattr(session, "PART_BYTES", size)
    assert spread_out(df, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_audit_sorts_no_cells(spark):
    """Only the different values are grouped: no sort, and no cell goes through a generator twice."""
    df = spark.createDataFrame([("b", 1.0, None), ("a", NAN, "x"), ("c", 2.0, "y")], "row_id string, v double, t string")
    out = profiling.audit(df, "row_id")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("min_by") == 2 and "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString().replace("SortAggregate(key=[], ", "")
    got = {r["column"]: (r["missing"], r["n_unique"], r["example"]) for r in out.collect()}
    assert got == {"v": (1, 2, "1.0"), "t": (1, 2, "x")}
    none = {r["column"]: (r["missing"], r["missing_pct"], r["example"]) for r in profiling.audit(df.where("false"), "row_id").collect()}
    assert none == {"v": (0, None, None), "t": (0, None, None)}

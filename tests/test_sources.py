import hashlib

import pytest

from tablewright.operators import checks
from tablewright.sources import contracts, readers, sinks
from tablewright.sources.contracts import DATASETS, NET_PRICE, STUDENT_PERFORMANCE


def _students(tmp_path, extra=""):
    text = "Hours Studied,Previous Scores,Extracurricular Activities,Sleep Hours,Sample Question Papers Practiced,Performance Index\n"
    text += "7,99,Yes,9,1,91.0\n4,82,No,4,2,65.0\n" + extra
    (tmp_path / STUDENT_PERFORMANCE.filename).write_text(text)
    return str(tmp_path)


def test_missing_table_names_path_and_source(spark, tmp_path):
    with pytest.raises(readers.DatasetMissing) as e:
        readers.load_raw(spark, STUDENT_PERFORMANCE, str(tmp_path))
    assert STUDENT_PERFORMANCE.filename in str(e.value) and STUDENT_PERFORMANCE.url in str(e.value)


def test_sweep_lists_every_absent_table(spark, tmp_path):
    rows = readers.sweep(spark, DATASETS.values(), _students(tmp_path)).collect()
    assert {r["track"]: r["present"] for r in rows} == {"regression": True, "classification": False}


def test_csv_keeps_its_schema_and_reports_its_shape(spark, tmp_path):
    root = _students(tmp_path)
    df = readers.load_raw(spark, STUDENT_PERFORMANCE, root)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "bigint", "string", "bigint", "bigint", "double"]
    shape = readers.shape(spark, STUDENT_PERFORMANCE, root).first()
    assert (shape["rows"], shape["cols"], shape["matches"]) == (2, 6, False)


def test_misfit_rows_are_kept_and_listed(spark, tmp_path):
    root = _students(tmp_path, "x,82,No,4,2,65.0\n")
    assert readers.load_raw(spark, STUDENT_PERFORMANCE, root).count() == 3
    assert [r["raw"] for r in readers.misfits(spark, STUDENT_PERFORMANCE, root).collect()] == ["x,82,No,4,2,65.0"]


def test_prepare_orders_columns_and_names_missing_ones(spark, tmp_path):
    df = readers.load_raw(spark, STUDENT_PERFORMANCE, _students(tmp_path))
    assert contracts.prepare(df, STUDENT_PERFORMANCE).columns == STUDENT_PERFORMANCE.kept
    with pytest.raises(KeyError, match="Sleep Hours"):
        contracts.prepare(df.drop("Sleep Hours"), STUDENT_PERFORMANCE)


def test_provenance_hash_and_upsert(spark, tmp_path):
    root = _students(tmp_path)
    df = readers.load_raw(spark, STUDENT_PERFORMANCE, root)
    new = readers.provenance(spark, STUDENT_PERFORMANCE, root, df)
    want = hashlib.sha256((tmp_path / STUDENT_PERFORMANCE.filename).read_bytes()).hexdigest()
    assert new.first()["sha256"] == want and new.first()["raw_rows"] == 2
    both = readers.upsert(readers.upsert(None, new), new)
    assert both.count() == 1


def test_row_digest_ignores_order(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS m")
    assert readers.row_digest(df).first() == readers.row_digest(df.orderBy("m").repartition(3)).first()
    assert readers.row_digest(df).first() != readers.row_digest(df.where("id > 0")).first()


def test_markdown_copy(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "n string, v double")
    path = sinks.save_table(df, str(tmp_path / "t"), "result", markdown=True)
    assert spark.read.option("header", True).csv(path).count() == 2
    lines = [r["value"] for r in spark.read.text(f"{path}_md").collect()]
    assert lines == ["| n | v |", "|---|---|", "| a | 1.5 |", "| b |  |"]


def test_report_verdicts(spark):
    rows = [("x", "PASS", ""), ("y", "TODO", "")]
    df = spark.createDataFrame(rows, "check string, status string, detail string")
    assert checks.report(df).first()["verdict"] == "COMPLETE, ITEMS AWAITING INPUT"
    assert checks.report(df.where("status = 'PASS'")).first()["verdict"] == "ALL CHECKS PASS"


def test_missing_auc_fails_the_check(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.9, 0.8, "predict_proba"), (2, "b", 0.95, None, "unavailable")],
        "rank int, model string, F1_weighted double, ROC_AUC double, AUC_source string",
    )
    got = {r["check"]: r["status"] for r in checks.result_table_checks(df, 2, "F1_weighted", ["F1_weighted"], "c").collect()}
    assert got["c: ranked by F1_weighted descending"] == "FAIL"
    assert got["c: no missing ROC-AUC"] == "FAIL" and got["c: ROC-AUC from scores"] == "FAIL"


def test_leakage_is_reported(spark):
    raw = spark.createDataFrame([(1, 2)], "l_orderkey int, overload_reason int")
    rows = contracts.exclusion_report(raw, raw, contracts.OVERLOAD).collect()
    assert {r["column_name"]: r["excluded"] for r in rows} == {"l_orderkey": False, "overload_reason": False}


def test_contract_features():
    assert NET_PRICE.features == ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus"]


def test_files_too_long_for_a_cell_are_hashed_as_a_stream(spark, tmp_path):
    """The same hash whichever way a file is read, of one file and of a folder with files of both kinds."""
    spec = contracts.DatasetSpec("t", "copy", "rows.csv", "a", ("a",), (), (3, 1))
    folder = tmp_path / "many"
    (folder / "rows.csv").mkdir(parents=True)
    for name, text in (("a.csv", "a\n" + "1\n" * 2000), ("b.csv", "a\n2\n"), ("c d.csv", "a\n" + "3\n" * 900)):
        (folder / "rows.csv" / name).write_text(text)
    (tmp_path / "rows.csv").write_text("a\n" + "1\n" * 3000)
    df, key = spark.range(3), "spark.sql.sources.binaryFile.maxLength"
    read = lambda root: readers.provenance(spark, spec, str(root), df).select("sha256", "size_bytes").first()
    whole = [read(root) for root in (tmp_path, folder)]
    assert whole[0]["sha256"] == hashlib.sha256((tmp_path / "rows.csv").read_bytes()).hexdigest()
    spark.conf.set(key, "1000")
    try:
        assert [read(root) for root in (tmp_path, folder)] == whole
    finally:
        spark.conf.unset(key)

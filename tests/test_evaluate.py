from pyspark.sql import functions as F

from tessella.operators import evaluate as E
from tessella.plans.tasks import ExtractionTask, SchemaField


def test_binary_metrics(spark):
    df = spark.createDataFrame([("True", "yes"), ("True", "no"), ("False", "true"), ("False", "ja")], "t string, p string")
    row = E.binary_metrics(df, F.col("t"), F.col("p")).first()
    assert tuple(row) == (1, 1, 1, 1, 4, 0.5, 0.5, 0.5, 0.5, 0.5)
    assert tuple(E.binary_metrics(df.limit(0), F.col("t"), F.col("p")).first())[4:] == (0, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_categorical_and_exact(spark):
    df = spark.createDataFrame([("a", "a "), ("b", "b"), ("c", "x"), (None, "")], "t string, p string")
    assert tuple(E.categorical_accuracy(df, F.col("t"), F.col("p")).first()) == (4, 0.75)
    assert E.categorical_confusion(df, F.col("t"), F.col("p")).filter("truth = 'c'").first()["guess"] == "x"
    assert E.exact_match_rate(df, [(F.col("t"), F.col("p"))]).first()[0] == 0.25


def test_align_and_compare(spark):
    pred = spark.createDataFrame([("1", True, "x"), ("1", False, "y"), ("2", True, "x"), ("9", True, "x")], "report_id string, b boolean, c string")
    gt = spark.createDataFrame([("1", False, "x", 0), ("1", True, "x", 1), ("2", True, "z", 2)], "report_id string, b boolean, c string, _order int")
    task = ExtractionTask(name="t", fields=(SchemaField("b", "boolean"), SchemaField("c")))
    assert E.align_by_id(pred, gt).count() == 3
    got = {r["field"]: r for r in E.compare(pred, gt, task).collect()}
    assert (got["b"]["tp"], got["b"]["fn"], got["b"]["n_aligned"]) == (2, 1, 3) and got["c"]["accuracy"] == 0.3333 and got["c"]["tp"] is None and got["b"]["exact_match_rate"] == 0.3333


def test_review_rows(spark):
    df = spark.createDataFrame([("nan", "P7", '["a", "", "b"]', "x\ny", "Ja"), ("R", "", "['odd']\nz", None, "null")], "report_id string, patient_id string, evidence_quotes string, reasoning string, rethoracotomy string")
    a, b = E.review_rows(df).collect()
    assert (a["patient_id"], a["evidence_quotes"], a["reasoning"], a["rethoracotomy"]) == ("P7", "a | b", "x y", "Ja")
    assert (b["patient_id"], b["evidence_quotes"], b["rethoracotomy"], b["notes"]) == ("R", "['odd'] | z", "", "")
    assert tuple(E.review_rows(df).columns) == E.REVIEW_COLUMNS


def test_checks_shapes_overlap(spark):
    df = spark.createDataFrame([("1", "x"), ("1", " "), ("", "y"), (None, None)], "report_id string, report_text string")
    got = {r["check"]: (r["status"], r["value"]) for r in E.input_checks(df).collect()}
    assert got == {"report_row_count": ("ok", "4"), "missing_report_ids": ("fail", "2"), "duplicate_report_ids": ("warn", "2"), "empty_report_text": ("warn", "2")}
    left = E.id_set(spark.createDataFrame([("1.0",), ("2",), ("A1",), ("3.5",), ("-x",)], "v string"), "v")
    right = E.id_set(spark.createDataFrame([("1",), ("002",), (None,)], "v string"), "v")
    row = E.id_overlap(left, right).first()
    assert tuple(row) == (5, 2, 1, 4, 1, 2, 20.0)
    assert {r["shape"]: r["n"] for r in E.shapes(left).collect()} == {"digits_len_1": 2, "starts_alpha": 1, "decimal_string": 1, "other_len_2": 1}
    assert [r["id"] for r in E.only_in(left, right, 2).collect()] == ["-x", "2"] and E.lengths(left).first()["n"] == 2

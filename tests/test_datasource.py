"""The format "reports" against the readers of the library."""

import pytest
from pyspark.sql import functions as F

from tessella.operators import evaluate as E
from tessella.operators.relational import ORDER
from tessella.sources import datasource, sinks, tables


@pytest.fixture
def folder(spark, tmp_path):
    datasource.register(spark)
    (tmp_path / "HER_Diagnose_a.csv").write_text("PatientID;FallNummer;OP_TerminNummer;OP_BeginnZeit;OP_EndeZeit;Diagnose_Time;Diagnose_Value\nP1;F1;O1;;;2026-01-11;\"CABG,\nunkompliziert\"\nP2;F2;;;;2026-01-10;x\nP1;NA;;;;;y\n")
    (tmp_path / "HER_Verlegungsbericht.csv").write_bytes("patnr;berdat;diag\nP1;2026-01-01;größer\nP2;2026-05-01;neu – alt\n".encode("cp1252"))
    (tmp_path / "reports.csv").write_bytes("report_id,report_text,ward\n1,fever noted,icu\n2,stable\n3,a,b,c\n".encode("utf-16"))
    (tmp_path / "texts").mkdir()
    for k, text in enumerate(("[History]\nhigh fever", "[Plan]\nnone", "b\xff")):
        (tmp_path / "texts" / f"report_{k:03d}.txt").write_bytes(text.encode("latin-1"))
    df = spark.createDataFrame([("P1", "extracted", '["q"]', "a & b")], ["report_id", "status", "evidence_quotes", "reasoning"])
    sinks.review_workbook(E.review_rows(df), str(tmp_path / "book.xlsx"))
    return tmp_path


def load(spark, *paths, **options):
    return spark.read.format("reports").options(**options).load(",".join(map(str, paths)))


def test_all_shapes_equal_the_readers(spark, folder):
    for name in ("HER_Diagnose_a.csv", "HER_Verlegungsbericht.csv", "reports.csv", "book.xlsx"):
        got, want = load(spark, folder / name), tables.read_table(spark, str(folder / name))
        assert got.columns[:-2] == want.columns[:-1] and got.columns[-2:] == ["_file", "_order"]
        assert [tuple(r)[:-2] for r in got.orderBy("_order").collect()] == [tuple(r)[:-1] for r in want.orderBy(ORDER).collect()], name
    texts = load(spark, folder / "texts").orderBy("_order")
    want = tables.load_texts(spark, str(folder / "texts")).orderBy(ORDER)
    assert [tuple(r)[:2] for r in texts.collect()] == [tuple(r)[:2] for r in want.collect()]
    with pytest.raises(Exception, match="no such input"):
        load(spark, folder / "missing.csv").collect()


def test_files_of_a_folder_are_united(spark, folder, monkeypatch):
    both = load(spark, folder / "HER_Diagnose_a.csv", folder / "HER_Verlegungsbericht.csv")
    assert both.count() == 5 and both.rdd.getNumPartitions() == 2 and {"PatientID", "patnr", "_file"} <= set(both.columns)
    assert both.filter("patnr is null").count() == 3
    whole = load(spark, folder)  # the tables of a folder without texts
    assert whole.select("_file").distinct().count() == 4
    chosen = spark.read.format("reports").schema("report_id string, _file string").load(str(folder / "reports.csv"))
    assert chosen.columns == ["report_id", "_file"] and sorted(r[0] for r in chosen.collect()) == ["1", "2"]


def test_filters_are_pushed(spark, folder, capfd):
    df = load(spark, folder)
    for condition, n in (("PatientID = 'P1'", 2), ("PatientID in ('P2', 'P9')", 1), ("patnr like 'P%'", 2), ("Diagnose_Value like '%unkompl%'", 1), ("ward is not null", 2), ("not PatientID = 'P1'", 1), ("berdat > '2026-02'", 1), ("patnr is null and ward is null", 4)):
        assert df.filter(condition).count() == n, condition
    found = df.filter(F.col("_file").contains("reports.csv") & (F.col("report_id") == "1"))
    plan = found._jdf.queryExecution().explainString(spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters" in plan and "report_id" in plan.split("PushedFilters")[1].split("\n")[0]
    assert found.count() == 1 and found.rdd.getNumPartitions() == 1


def test_sheets_are_partitions(spark, folder):
    one, all_sheets = load(spark, folder / "book.xlsx"), load(spark, folder / "book.xlsx", sheets="all")
    assert one.count() == all_sheets.count() == 1 and len(tables.sheet_names((folder / "book.xlsx").read_bytes())) == 1

import zipfile

import pytest

from tessella.operators import evaluate as E
from tessella.operators.relational import ORDER
from tessella.sources import sinks, tables


def cells(df):
    return [tuple(r) for r in df.orderBy(ORDER).drop(ORDER).collect()]


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "utf-16", "cp1252"])
@pytest.mark.parametrize("sep", [",", ";", "\t"])
def test_dialects(spark, tmp_path, encoding, sep):
    lines = [["PatientID ", "Text", "x"], ["1", "Grüße – ok", "NA"], ["2", '"a' + sep + 'b\n""q"""', ""], ["3", "short"], ["4", "too", "many", "cells"]]
    (tmp_path / "t.csv").write_bytes("\n".join(sep.join(r) for r in lines).encode(encoding))
    df = tables.read_tabular(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["PatientID", "Text", "x", ORDER]
    assert cells(df) == [("1", "Grüße – ok", ""), ("2", f'a{sep}b\n"q"', ""), ("3", "short", "")]


def test_sniffing():
    assert tables.sniff(b"a;b;c\n1;2;3")[:2] == ("utf-8-sig", ";") and tables.sniff(b"a,b\n", sep=";")[2] == ["a,b"]
    assert tables.sniff("a;ü\n".encode("cp1252"))[0] == "cp1252"
    with pytest.raises(ValueError):
        tables.sniff(b"")


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("P1", "extracted", '["q"]', "a & b\nc")], ["report_id", "status", "evidence_quotes", "reasoning"])
    path = str(tmp_path / "review.xlsx")
    sinks.review_workbook(E.review_rows(df), path)
    back = tables.read_table(spark, path)
    assert tuple(c for c in back.columns if c != ORDER) == E.REVIEW_COLUMNS
    row = back.first()
    assert (row["patient_id"], row["evidence_quotes"], row["reasoning"], row["notes"]) == ("P1", "q", "a & b c", "")
    sheet = zipfile.ZipFile(path).read("xl/worksheets/sheet1.xml").decode()
    assert 'topLeftCell="A2"' in sheet and "autoFilter" in sheet
    with pytest.raises(ImportError):
        tables.read_workbook(spark, "old.xls")


def test_review_csv(spark, tmp_path):
    df = spark.createDataFrame([("P1", "a;b")], ["report_id", "status"])
    sinks.review_csv(E.review_rows(df), str(tmp_path / "r.csv"))
    data = (tmp_path / "r.csv").read_bytes()
    assert data.startswith(b"\xef\xbb\xbfpatient_id;status;") and b'P1;"a;b"' in data


def test_reports_from_tables_and_folders(spark, tmp_path):
    (tmp_path / "reports.csv").write_text("report_id;report_text;ward\n1.0;fever noted;icu\n;gone;x\n2;stable;nan\n")
    got = tables.load_reports(spark, str(tmp_path / "reports.csv"))
    assert [(r["report_id"], r["report_text"], r["source_row_id"], r["ward"]) for r in got.orderBy(ORDER).collect()] == [("1", "fever noted", "row_0", "icu"), ("2", "stable", "row_2", "")]
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts" / "b.txt").write_bytes(b"two \xff")
    (tmp_path / "texts" / "a.txt").write_text("one")
    assert cells(tables.load_reports(spark, str(tmp_path / "texts"))) == [("a", "one", "row_0"), ("b", "two �", "row_1")]
    (tmp_path / "s.csv").write_text("report_id,hist,plan\n7,h,\n")
    assert tables.reports_from_table(spark, str(tmp_path / "s.csv"), section_columns=["hist", "plan"]).first()["report_text"] == "[hist]\nh"
    two = tables.load_reports(spark, [str(tmp_path / "reports.csv"), str(tmp_path / "s.csv")], text_column="report_text", section_columns=["hist"])
    assert two.count() == 3 and two.filter("source_row_id = 'row_0'").count() == 2  # row ids start anew in each file
    with pytest.raises(ValueError, match="id column"):
        tables.reports_from_table(spark, str(tmp_path / "s.csv"), id_column="nope")
    with pytest.raises(ValueError, match="neither"):
        tables.reports_from_table(spark, str(tmp_path / "s.csv"))
    with pytest.raises(FileNotFoundError):
        tables.load_reports(spark, str(tmp_path / "missing.csv"))
    with pytest.raises(FileNotFoundError):
        tables.load_reports(spark, None, raw_dir=str(tmp_path / "none"))


def test_clinical_sources(spark, tmp_path, caplog):
    (tmp_path / "HER_Diagnose_a.csv").write_text("PatientID;Diagnose_Value;Diagnose_Time\nP1;late;2026-02-01\nP2;x;2026-01-01\n")
    (tmp_path / "HER_Diagnose_b.csv").write_text("patient_id;Diagnose_Value;Diagnose_Time\nP1;early;2026-01-01\n")
    (tmp_path / "HER_Verlegungsbericht.csv").write_text("patnr;berdat;diag\nP1;2026-01-01;old\nP1;2026-05-01;new\n")
    names = lambda paths: [p.rpartition("/")[2] for p in paths]
    assert names(tables.discover_diagnoses(spark, f"file://{tmp_path}")) == ["HER_Diagnose_a.csv", "HER_Diagnose_b.csv"]
    assert names(tables.discover_transfers(spark, str(tmp_path))) == ["HER_Verlegungsbericht.csv"]
    got = {r["report_id"]: r for r in tables.load_reports(spark, None, raw_dir=str(tmp_path)).collect()}
    assert got["P1"]["n_diagnosis_entries"] == 2 and "early" in got["P1"]["report_text"].split("#2")[0] and got["P1"]["verlegung_text"].endswith("new")
    assert got["P1"]["source_files"] == "HER_Diagnose_a.csv, HER_Diagnose_b.csv, HER_Verlegungsbericht.csv" and got["P2"]["verlegung_text"] == ""
    alone = tables.load_reports(spark, [str(tmp_path / "HER_Verlegungsbericht.csv")]).first()
    assert alone["input_kind"] == "patient_verlegung" and alone["n_verlegung_rows"] == 2
    (tmp_path / "other.csv").write_text("report_id,report_text\n1,x\n")
    (tmp_path / "strangers.csv").write_text("patnr;berdat;diag\nQ9;2026-01-01;old\n")
    with caplog.at_level("WARNING"):
        apart = tables.load_reports(spark, [str(tmp_path / "HER_Diagnose_a.csv"), str(tmp_path / "strangers.csv")])
    assert apart.count() == 2 and "strangers.csv" in caplog.text
    with pytest.raises(ValueError, match="mixed"):
        tables.load_reports(spark, [str(tmp_path / "other.csv"), str(tmp_path / "HER_Diagnose_a.csv")])


def test_row_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", True, ["a"], None)], "id string, b boolean, l array<string>, n string")
    sinks.write_csv(df, str(tmp_path / "csv"), ["id", "b", "l"])
    assert tables.load_rows(spark, str(tmp_path / "csv")).first().asDict() == {"id": "1", "b": "True", "l": '["a"]'}
    sinks.write_jsonl(df, str(tmp_path / "j"))
    assert '"n":null' in "".join(p.read_text() for p in (tmp_path / "j").glob("part-*.json")) and tables.load_jsonl(spark, str(tmp_path / "j")).count() == 1
    assert tables.load_rows(spark, str(tmp_path / "no")) is None and tables.load_jsonl(spark, str(tmp_path / "no")) is None
    assert sinks.log_rows(df, str(tmp_path / "db.sqlite"), "id") == 1 == sinks.log_rows(df, str(tmp_path / "db.sqlite"), "id")
    assert sinks.safe_name("a/b c" + "x" * 99)[:5] == "a_b_c" and len(sinks.safe_name("y" * 99)) == 80


def test_encoding_holds_for_the_whole_file(spark, tmp_path):
    for name, last, want in (("cp1252", b"Gr\xfc\xdfe \x80", "Grüße €"), ("latin1", b"Gr\xfc\xdfe \x81", "Grüße \x81"), ("utf8", "Grüße €".encode(), "Grüße €")):
        path = tmp_path / f"{name}.csv"
        path.write_bytes(b"id,text\n" + b"".join(b"%d,plain words of a long file\n" % k for k in range(4000)) + b"4000," + last + b"\n")
        rows = read_last(spark, path)
        assert rows == [want], name


def read_last(spark, path):
    from tessella.sources import tables

    return [r["text"] for r in tables.read_tabular(spark, str(path)).filter("id = '4000'").collect()]


def test_long_files_without_line_ends_in_cells_are_split(spark, tmp_path):
    rows = [f'{k},"a, b",{"x" * 40}' for k in range(40_000)]
    (tmp_path / "long.csv").write_text("id,pair,pad\n" + "\n".join(rows) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300000")
        df = tables.read_tabular(spark, str(tmp_path / "long.csv"))
        got = [(r["id"], r["pair"], r[ORDER]) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got, key=lambda r: r[2]) == [(str(k), "a, b", k) for k in range(40_000)]

import pytest

from tessella import cli


def test_validate(spark, tmp_path, capsys):
    (tmp_path / "r.csv").write_text("report_id,report_text\n1,a\n1,b\n")
    assert cli.main(["validate", "--reports", str(tmp_path / "r.csv")], spark) == 0
    out = capsys.readouterr().out
    assert "[OK] report_row_count: 2" in out and "[WARN] duplicate_report_ids: 1" in out
    assert cli.main(["preflight", "--reports", str(tmp_path / "none.csv")], spark) == 1
    assert "task demo_extraction" in capsys.readouterr().out
    (tmp_path / "bad.csv").write_text("x,y\n1,2\n")
    assert cli.run_checks(spark, str(tmp_path / "bad.csv"))[-1]["check"] == "report_load"


def test_check_join(spark, tmp_path, capsys):
    (tmp_path / "HER_Diagnose.csv").write_text("PatientID;Diagnose_Value\n1.0;x\n2;y\n")
    (tmp_path / "HER_Verlegungsbericht.csv").write_text("patnr;diag\n1;x\n002;y\n")
    assert cli.main(["check-join", "--raw-dir", str(tmp_path)], spark) == 0
    out = capsys.readouterr().out
    assert "n_both=1" in out and "n_both_without_zeros=2" in out and "only in diagnoses: ['2']" in out
    (tmp_path / "other.csv").write_text("patnr;diag\n9;x\n")
    assert cli.main(["check-join", "--diagnose", str(tmp_path / "HER_Diagnose.csv"), "--verlegung", str(tmp_path / "other.csv")], spark) == 2
    with pytest.raises(SystemExit):
        cli.check_join(spark, [str(tmp_path / "other.csv")], [str(tmp_path / "other.csv")])
    with pytest.raises(SystemExit):
        cli.check_join(spark, [], [])


def test_review(spark, tmp_path, capsys):
    (tmp_path / "results.csv").write_text("report_id,status\n" + "".join(f"{k},extracted\n" for k in range(5)))
    assert cli.main(["review", "--results", str(tmp_path / "results.csv"), "--out", str(tmp_path / "sheet"), "--format", "both", "--max-rows", "3"], spark) == 0
    assert len((tmp_path / "sheet.csv").read_text(encoding="utf-8-sig").strip().splitlines()) == 4 and (tmp_path / "sheet.xlsx").exists()
    with pytest.raises(FileNotFoundError):
        cli.export_review(spark, str(tmp_path / "no.csv"), "x")

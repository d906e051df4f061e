"""Command line: run, validate, check-join, review, preflight.

``python -m tessella.cli run --task demo_extraction --reports reports.csv --output-dir outputs``
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessella.config import Settings
from tessella.operators import evaluate as E
from tessella.operators import relational as R
from tessella.plans import pipeline
from tessella.plans.tasks import available_tasks, load_task
from tessella.session import build_session
from tessella.sources import sinks, tables


def run_checks(spark: SparkSession, source: str | Sequence[str] | None, settings: Settings = Settings()) -> list[dict]:
    """Rows check, status, value, detail: whether reports are there, load, and how sound they are."""
    paths = [source] if isinstance(source, str) else list(source or [])
    there = bool(paths) and all(tables.exists(spark, p) for p in paths)
    rows = [{"check": "report_source_exists", "status": "ok" if there else "fail", "value": str(there), "detail": ", ".join(paths)}]
    if not there:
        return rows
    try:
        reports = tables.load_reports(spark, paths, settings.report_id_column, settings.report_text_column)
        return rows + [r.asDict() for r in E.input_checks(reports).collect()]
    except Exception as error:  # noqa: BLE001 - shown as a row
        return [*rows, {"check": "report_load", "status": "fail", "value": "error", "detail": str(error)}]


def check_join(spark: SparkSession, diagnoses: Sequence[str], transfers: Sequence[str], sample: int = 15) -> int:
    """Print how the patient ids of both kinds of tables fit; 2 if none does."""
    if not diagnoses or not transfers:
        raise SystemExit("diagnosis and transfer tables are both needed")
    for paths, fits, kind in ((diagnoses, tables.looks_like_diagnoses, "diagnosis"), (transfers, tables.looks_like_transfers, "transfer")):
        for p in paths:
            if not fits(spark, p):
                raise SystemExit(f"not a {kind} table: {p}")
    sets = []
    for name, paths, aliases in (("diagnoses", diagnoses, R.PATIENT_ALIASES), ("transfers", transfers, R.TRANSFER_PATIENT_ALIASES)):
        frames = [tables.read_table(spark, p) for p in paths]
        ids = E.id_set(R.union_all([f.select(F.col(f"`{R.find_column(f.columns, aliases, 'patient id')}`").alias("v")) for f in frames]), "v")
        sets.append(ids)
        print(f"{name}: shapes {[tuple(r) for r in E.shapes(ids).collect()]}, lengths {[tuple(r) for r in E.lengths(ids).collect()]}")
    found = E.id_overlap(*sets).first().asDict()
    print(", ".join(f"{k}={v}" for k, v in found.items()))
    for name, a, b in (("diagnoses", *sets), ("transfers", *reversed(sets))):
        print(f"only in {name}: {[r['id'] for r in E.only_in(a, b, sample).collect()]}")
    return 0 if found["n_both"] else 2


def export_review(spark: SparkSession, results: str, out: str, form: str = "csv", most: int | None = None, seed: int = 0) -> list[str]:
    """Review sheet of a result CSV, sampled if it has more than ``most`` rows; the files written."""
    rows = tables.load_rows(spark, results)
    if rows is None:
        raise FileNotFoundError(f"no such results: {results}")
    if most and rows.count() > most:
        rows = R.seeded_sample(rows, most, seed, "report_id" if "report_id" in rows.columns else rows.columns[0])
    sheet, written = E.review_rows(rows), []
    for kind, write in (("csv", sinks.review_csv), ("xlsx", sinks.review_workbook)):
        if form in (kind, "both"):
            write(sheet, f"{out}.{kind}")
            written.append(f"{out}.{kind}")
    return written


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessella")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="extract; see also tessella.plans.pipeline", add_help=False)
    run.add_argument("rest", nargs=argparse.REMAINDER)
    for name in ("validate", "preflight"):
        commands.add_parser(name).add_argument("--reports", nargs="*", default=[])
    join = commands.add_parser("check-join")
    join.add_argument("--diagnose", nargs="*", default=[])
    join.add_argument("--verlegung", nargs="*", default=[])
    join.add_argument("--raw-dir", default="data/raw")
    join.add_argument("--sample", type=int, default=15)
    review = commands.add_parser("review")
    review.add_argument("--results", required=True)
    review.add_argument("--out", default="review_sheet")
    review.add_argument("--format", choices=("csv", "xlsx", "both"), default="csv")
    review.add_argument("--max-rows", type=int)
    review.add_argument("--seed", type=int, default=0)
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv[:1] == ["run"]:
        pipeline.main(argv[1:])
        return 0
    args = parser.parse_args(argv)
    spark = spark or build_session()
    if args.command == "preflight":
        for name in available_tasks():
            print(f"task {name}: {len(load_task(name).fields)} fields")
    if args.command in ("validate", "preflight"):
        rows = run_checks(spark, args.reports, Settings.from_env())
        for r in rows:
            print(f"[{r['status'].upper()}] {r['check']}: {r['value']}" + (f" ({r['detail']})" if r["detail"] else ""))
        return int(any(r["status"] == "fail" for r in rows))
    if args.command == "check-join":
        diagnoses = args.diagnose or tables.discover_diagnoses(spark, args.raw_dir)
        transfers = args.verlegung or tables.discover_transfers(spark, args.raw_dir)
        return check_join(spark, diagnoses, transfers, args.sample)
    print("\n".join(export_review(spark, args.results, args.out, args.format, args.max_rows, args.seed)))
    return 0


if __name__ == "__main__":
    sys.exit(main())

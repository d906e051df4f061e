"""Reports in, one flat row and one nested record for each: the whole extraction as a DataFrame plan.

clean -> evidence for each variable -> (model call for the rows that need one) -> merge by report ->
rules -> flat row. A task without variables is run as a task with one.
"""

from __future__ import annotations

import argparse
import json
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.config import Settings, parse_max_reports
from tessella.functions.jsonx import bool_cell, default_column, join_cell, merge_quotes, one_hot, one_hot_name
from tessella.functions.rules import apply_rules
from tessella.functions.text import clean_text
from tessella.operators import model, relational
from tessella.operators.evidence import BUNDLE, evidence_column, fit_column
from tessella.operators.ledger import Ledger
from tessella.plans.prompts import fallback_prefix
from tessella.plans.tasks import ExtractionTask, available_tasks, load_task

# States of a row, and the columns every result has.
EXTRACTED, PARTIAL, FAILED, SKIPPED = "extracted", "partial", "failed", "skipped_no_evidence"
BASE_FIELDS = (
    "report_id", "source_row_id", "report_name", "status", "llm_called", "reduction_method", "original_report_text_length", "llm_report_text_length",
    "keyword_hits_count", "has_positive_evidence", "has_negation", "manual_review_candidate", "schema_errors", "guardrail_contradictions",
    "guardrail_missing_fields", "guardrail_normalized", "evidence_snippets", "reasoning", "evidence_quotes", "stage_path",
)
AUDIT_FIELDS = ("reasoning", "evidence_quotes", "information_sufficient")


def fieldnames(task: ExtractionTask) -> list[str]:
    """Columns of the flat row; a field that is a base column too appears once."""
    hot = [one_hot_name(f.name, o) for f in task.fields if f.type == "enum" for o in f.enum]
    return [*BASE_FIELDS, *[f.name for f in task.fields if f.name not in BASE_FIELDS], *hot]


def _get(df: DataFrame, name: str) -> Column:
    return F.trim(F.coalesce(F.col(name).cast("string"), F.lit(""))) if name in df.columns else F.lit("")


def variable_rows(reports: DataFrame, task: ExtractionTask, settings: Settings) -> DataFrame:
    """A row for each report and variable, with its text, evidence, and what the model would read."""
    minis = [(v.name, v.label, v.text_source, task.for_variable(v)) for v in task.variables] or [(task.name, "", None, task)]
    base = reports.select(
        _get(reports, "report_id").alias("report_id"), _get(reports, "source_row_id").alias("source_row_id"), _get(reports, "report_name").alias("report_name"),
        *[F.col(c).cast("string").alias(c) for c in ("diagnoseliste_text", "verlegung_text", "report_text") if c in reports.columns],
    ).withColumn("report_name", F.when(F.col("report_name") == "", F.col("report_id")).otherwise(F.col("report_name")))
    base = base.withColumn("_report", F.monotonically_increasing_id()).withColumn("_whole", clean_text("report_text"))
    sources = sorted({s for _, _, s, _ in minis if s})
    for k, source in enumerate(sources):  # each text source is cleaned once, however many variables read it
        own = clean_text(relational.text_for_source(base.columns, source))
        base = base.withColumn(f"_source_{k}", F.when(own == "", F.col("_whole")).otherwise(own))
    texts = {source: f"_source_{k}" for k, source in enumerate(sources)}
    structs = []
    for k, (name, label, source, mini) in enumerate(minis):
        text = F.col(texts[source] if source else "_whole")
        evidence = evidence_column(mini, text, settings)
        fit = fit_column(mini, F.when(F.lit(mini.send_full_text_when_no_evidence), text), settings=settings)
        structs.append(F.struct(F.lit(k).alias("place"), F.lit(name).alias("variable"), F.lit(label).alias("label"), text.alias("text"), evidence.alias("evidence"), fit.alias("fit")))
    rows = base.select("report_id", "source_row_id", "report_name", "_report", F.explode(F.array(*structs)).alias("x")).select("report_id", "source_row_id", "report_name", "_report", "x.*")
    positive, fallback = F.col("evidence.has_positive_evidence"), F.lit(task.send_full_text_when_no_evidence) & (F.trim("text") != "")
    prefix = F.when(F.col("fit.shortened"), fallback_prefix(task, True)).otherwise(fallback_prefix(task, False))
    mode = F.when(positive, "evidence_snippets").when(fallback & F.col("fit.shortened"), "full_text_fallback_truncated").when(fallback, "full_text_fallback")
    sent = F.when(positive, F.col("evidence.llm_report_text")).when(fallback, F.concat(prefix, F.col("fit.text")))
    return rows.withColumns({"input_mode": mode, "llm_text": sent}).drop("fit")


def answers(rows: DataFrame, task: ExtractionTask, client: model.Client, settings: Settings, wait: bool = True, ledger: Ledger | None = None) -> DataFrame:
    """Model answers of all rows; those without a text to send get the defaults, without a call.

    Evidence travels through the model stage as JSON text, so it is computed once and joined to nothing.
    """
    tasks = {v.name: task.for_variable(v) for v in task.variables} or {task.name: task}
    sent = rows.withColumn("evidence", F.to_json("evidence")).drop("text")
    found = model.call_rows(sent, tasks, client, settings, wait=wait, ledger=ledger)
    return found.withColumn("called", F.col("llm_text").isNotNull())


def merge_variables(found: DataFrame, task: ExtractionTask) -> DataFrame:
    """One row for each report: sums, ors and ands of its variables, lists in their order, fields, status."""
    joined = found.withColumn("evidence", F.from_json("evidence", BUNDLE))
    many = bool(task.variables)
    item = F.struct(
        "place", "variable", "label", "evidence", "fields", "schema_errors", "reasoning", "evidence_quotes", "called", "failed", "input_mode",
        F.length(F.coalesce("llm_text", F.lit(""))).alias("sent"), "attempts",
    )
    sufficient = F.coalesce(F.get_json_object("fields", "$.information_sufficient") == "true", F.lit(False))
    per = joined.groupBy("_report").agg(
        F.first("report_id").alias("report_id"), F.first("source_row_id").alias("source_row_id"), F.first("report_name").alias("report_name"),
        F.array_sort(F.collect_list(item), lambda a, b: a["place"] - b["place"]).alias("vars"), F.bool_or("called").alias("called"), F.bool_or("evidence.has_positive_evidence").alias("positive"),
        F.bool_or("evidence.has_negation").alias("negation"), F.sum("evidence.keyword_hits_count").cast("int").alias("hits"), F.bool_and(sufficient).alias("sufficient"),
        F.count_if(F.col("failed")).alias("n_failed"), F.count_if(F.col("called") & ~F.col("failed")).alias("n_fine"),
        F.max(F.when(F.col("called"), F.length("llm_text"))).alias("sent"),
    )
    v = F.col("vars")
    flat = lambda part: F.flatten(F.transform(v, part))
    status = F.when((F.col("n_fine") > 0) & (F.col("n_failed") > 0), PARTIAL).when(F.col("n_failed") > 0, FAILED).when(F.col("called"), EXTRACTED).otherwise(SKIPPED)
    named = lambda x: F.transform(x["schema_errors"], lambda e: F.concat(x["variable"], F.lit(": "), e)) if many else x["schema_errors"]
    reasons = F.filter(F.transform(v, lambda x: F.when(F.trim(x["reasoning"]) != "", F.concat(F.lit("### "), x["label"], F.lit("\n"), F.trim(x["reasoning"])))), lambda x: x.isNotNull())
    method = F.array_join(F.transform(v, lambda x: F.concat(x["variable"], F.lit(":"), x["evidence"]["reduction_method"])), " | ") if many else v[0]["evidence"]["reduction_method"]
    flags = F.aggregate(v, F.create_map().cast("map<string,boolean>"), lambda a, x: F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(x["evidence"]["evidence_flags"], k)), x["evidence"]["evidence_flags"]))
    return per.select(
        "_report", "report_id", "source_row_id", "report_name", "vars", status.alias("status"), F.col("called").alias("llm_called"), method.alias("reduction_method"),
        F.get(F.slice(v, -1, 1), F.lit(0))["evidence"]["original_report_text_length"].alias("original_report_text_length"),
        F.coalesce("sent", F.lit(0)).alias("llm_report_text_length"), F.col("hits").alias("keyword_hits_count"), F.col("positive").alias("has_positive_evidence"),
        F.col("negation").alias("has_negation"), flags.alias("evidence_flags"), flat(lambda x: x["evidence"]["evidence_snippets"]).alias("snippets"),
        flat(named).alias("schema_errors"), (F.array_join(reasons, "\n\n") if many else v[0]["reasoning"]).alias("reasoning"),
        merge_quotes(flat(lambda x: x["evidence_quotes"])).alias("evidence_quotes"), F.col("sufficient"),
    )


def field_columns(task: ExtractionTask) -> dict[str, Column]:
    """Typed columns of the task's fields out of the merged variables."""
    out: dict[str, Column] = {}
    for f in task.fields:
        kind = f.spark().dataType
        owners = [k for k, v in enumerate(task.variables) if any(x.name == f.name for x in v.fields)] if task.variables else [0]
        if task.variables and f.name in AUDIT_FIELDS:
            out[f.name] = {"reasoning": F.col("reasoning"), "evidence_quotes": F.col("evidence_quotes"), "information_sufficient": F.col("sufficient")}[f.name]
        elif not owners:
            out[f.name] = default_column(f)
        else:
            text = F.get_json_object(F.col("vars")[owners[-1]]["fields"], f"$.{f.name}")
            out[f.name] = F.from_json(text, kind) if f.type == "array" else text.cast(kind)
    return out


def finish(merged: DataFrame, task: ExtractionTask) -> DataFrame:
    """Rules, one-hot columns and cells: adds the final fields, ``guard`` and ``stage_path``."""
    typed = merged.withColumn("_fields", F.struct(*[c.alias(n) for n, c in field_columns(task).items()]))
    final, report = apply_rules(task, {f.name: F.col(f"_fields.{f.name}") for f in task.fields})
    out = typed.withColumn("guard", F.struct(*[c.alias(n) for n, c in report.items()])).withColumn("final", F.struct(*[final[f.name].alias(f.name) for f in task.fields]))
    # one pair of stages for each variable of a task that has some
    stages = ["preprocessing", *["rule_evidence", "llm_extraction"] * max(1, len(task.variables)), "schema_validation", "guardrails"]
    return out.withColumn("stage_path", F.lit(" -> ".join(stages)))


def flat_rows(done: DataFrame, task: ExtractionTask) -> DataFrame:
    cell = {
        "llm_called": bool_cell(F.col("llm_called")), "has_positive_evidence": bool_cell(F.col("has_positive_evidence")), "has_negation": bool_cell(F.col("has_negation")),
        "manual_review_candidate": bool_cell(F.col("guard.manual_review_candidate")), "schema_errors": join_cell(F.col("schema_errors")),
        "guardrail_contradictions": join_cell(F.col("guard.contradictions")), "guardrail_missing_fields": join_cell(F.col("guard.missing_dependent_fields")),
        "guardrail_normalized": join_cell(F.col("guard.normalized_fields")), "evidence_snippets": F.to_json("snippets"), "evidence_quotes": F.to_json("evidence_quotes"),
    }
    base = [cell.get(c, F.col(c)).alias(c) for c in BASE_FIELDS]
    fields = [F.col(f"final.{f.name}").alias(f.name) for f in task.fields if f.name not in BASE_FIELDS]
    return done.select(*base, *fields, *one_hot(task, lambda n: F.col(f"final.{n}")))


def nested_records(done: DataFrame, task: ExtractionTask) -> DataFrame:
    """The structured record: fields, one-hot, guard report, evidence, and an audit of the stages."""
    step = lambda stage, variable, action, **detail: F.struct(
        F.lit(stage).alias("stage"), variable.alias("variable"), action.alias("action"),
        F.create_map(*[x for k, c in detail.items() for x in (F.lit(k), c.cast("string"))]).cast("map<string,string>").alias("detail"),
    )
    per = F.flatten(F.transform("vars", lambda x: F.array(
        step("rule_evidence", x["variable"], F.lit("extract_rule_evidence"), reduction_method=x["evidence"]["reduction_method"], keyword_hits_count=x["evidence"]["keyword_hits_count"], snippet_count=F.size(x["evidence"]["evidence_snippets"])),
        step("llm_extraction", x["variable"], F.when(x["called"], "extract_entities").otherwise("skipped"), llm_called=x["called"], input_mode=x["input_mode"], attempts=x["attempts"]),
    )))
    failed = F.exists("schema_errors", lambda e: e.contains(model.FAILED))
    whole = F.lit(task.name)
    stages = F.concat(
        F.array(step("preprocessing", whole, F.lit("clean_text"), output_chars=F.col("original_report_text_length"))), per,
        F.array(step("schema_validation", whole, F.lit("validate"), ok=~failed), step("guardrails", whole, F.lit("apply_rules"), manual_review_candidate=F.col("guard.manual_review_candidate"))),
    )
    return done.select(
        "report_id", "source_row_id", F.lit(task.name).alias("task"), "status", F.col("final").alias("fields"),
        F.struct(*one_hot(task, lambda n: F.col(f"final.{n}")) or [F.lit(None).cast("int").alias("none")]).alias("one_hot"),
        F.col("guard.manual_review_candidate").alias("manual_review_candidate"), "schema_errors", F.col("guard").alias("guardrail"), "reasoning", "evidence_quotes", "stage_path",
        F.struct(stages.alias("stages"), F.exists("vars", lambda x: x["input_mode"].startswith("full_text")).alias("used_full_text_fallback"), F.lit(bool(task.variables)).alias("per_variable_llm")).alias("audit"),
        F.struct("reduction_method", "keyword_hits_count", "evidence_flags", "has_positive_evidence", "has_negation", F.col("snippets").alias("snippets")).alias("evidence"),
    )


def run_task(reports: DataFrame, task: ExtractionTask, client: model.Client, settings: Settings = Settings(), wait: bool = True, store: str | None = None, ledger: Ledger | None = None) -> tuple[DataFrame, DataFrame]:
    """Flat rows and nested records of all reports.

    With ``store`` the answers are written there and read back, so that no later action repeats a call;
    with ``ledger`` neither does a task that runs again, nor a later run that resumes.
    """
    rows = variable_rows(reports, task, settings)
    found = answers(rows, task, client, settings, wait, ledger)
    if store:
        found.write.mode("overwrite").parquet(store)
        found = reports.sparkSession.read.schema(found.schema).parquet(store)
    done = finish(merge_variables(found, task), task)
    return flat_rows(done, task), nested_records(done, task)


def asked_rows(found: DataFrame, task: ExtractionTask) -> DataFrame:
    """A row for each call, with what a failure record holds."""
    return found.filter("called").select(
        F.concat(F.lit(task.name), F.lit("_"), F.nullif("variable", F.lit(task.name)), F.lit("_extraction")).alias("long_name"), F.lit(f"{task.name}_extraction").alias("short_name"),
        F.col("report_id").alias("record_id"), "report_name", "failed", "system_prompt", "user_prompt", "raw_output", "error_message",
    ).withColumn("stage_name", F.coalesce("long_name", "short_name")).drop("long_name", "short_name")


def select_work(reports: DataFrame, results: DataFrame | None, resume: bool, retry: bool) -> DataFrame:
    """What a run has to do: everything, what is not done yet, or what failed."""
    if results is None or not (resume or retry):
        return reports
    return relational.to_retry(reports, results) if retry else relational.unprocessed(reports, relational.keep_done(results))


def run_job(spark: SparkSession, source: str | Sequence[str] | None, output: str, task_name: str | None = None, max_reports: int | None = None, retry_failed: bool = False, client: model.Client | None = None, settings: Settings | None = None, wait: bool = True) -> str:
    """Load, limit, choose the work, extract, merge with earlier results, write; returns the CSV's folder.

    Results are versions: a run writes a new folder and then names it in ``current.txt``, so a crash
    leaves the last complete results in place.
    """
    from tessella.sources import sinks, tables

    settings = settings or Settings.from_env()
    task = load_task(task_name or settings.task)
    client = client or model.client_for(settings)
    reports = tables.load_reports(spark, source, id_column=settings.report_id_column, text_column=settings.report_text_column)
    reports = relational.first_rows(reports, max_reports if max_reports is not None else settings.max_reports)
    before = sinks.current_version(spark, output)
    old = spark.read.parquet(f"{before}/rows") if before else None
    todo = select_work(reports, old, settings.resume, retry_failed)
    version = sinks.next_version(output, before)
    flat, nested = run_task(todo, task, client, settings, wait, store=f"{version}/answers", ledger=Ledger(f"{output}/ledger"))
    flat = relational.with_row_order(flat, "source_row_id", "report_id")
    merged = relational.upsert(old, flat) if old is not None and (settings.resume or retry_failed) else flat
    merged.write.parquet(f"{version}/rows")
    rows = spark.read.parquet(f"{version}/rows")
    sinks.write_csv(rows.orderBy(relational.ORDER), f"{version}/csv", fieldnames(task))
    sinks.write_jsonl(nested, f"{version}/jsonl")
    sinks.write_failures(asked_rows(spark.read.parquet(f"{version}/answers"), task), f"{version}/failures")
    if settings.sqlite:
        sinks.log_rows(rows.drop(relational.ORDER), os.path.join(sinks.local_path(output), "extraction.sqlite"), "report_id")
    sinks.publish(output, version)
    return f"{version}/csv"


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Structured extraction from reports")
    parser.add_argument("--task", choices=available_tasks())
    parser.add_argument("--reports", nargs="*")
    parser.add_argument("--output-dir", default="outputs")
    parser.add_argument("--max-reports", default=None)
    parser.add_argument("--retry-failed", action="store_true")
    parser.add_argument("--llm-timeout", type=float)
    args = parser.parse_args(argv)
    from dataclasses import replace

    from tessella.session import build_session

    settings = Settings.from_env()
    if args.llm_timeout:
        settings = replace(settings, timeout=args.llm_timeout)
    print(run_job(build_session(), args.reports, args.output_dir, args.task, parse_max_reports(args.max_reports), args.retry_failed, settings=settings))


if __name__ == "__main__":
    main()

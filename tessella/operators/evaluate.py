"""Scoring against ground truth, review rows, input checks, join diagnostics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import clean_id, normalize_str, review_cell, strip
from tessella.operators.relational import latest_per_key
from tessella.plans.tasks import ExtractionTask

# Columns of the review sheet, and what counts as true there and in metrics.
CLINICAL_COLUMNS = (
    "new_permanent_pacemaker", "postop_atrial_fibrillation", "cerebrovascular_event", "reoperation_required", "reoperation_context",
    "multi_system_failure", "rethoracotomy", "rethoracotomy_context", "liver_cirrhosis",
)
REVIEW_COLUMNS = ("patient_id", "status", *CLINICAL_COLUMNS, "information_sufficient", "evidence_quotes", "reasoning", "correct_reop", "notes")
TRUTH = ("1", "true", "yes", "y")


def as_bool(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c.cast("string"))).isin(*TRUTH), F.lit(False))


def _rate(part: Column, whole: Column) -> Column:
    return F.round(F.when(whole == 0, 0.0).otherwise(part / whole), 4)


def metrics_from_counts(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    """support, precision, recall, f1, accuracy, specificity; 0 on zero denominators, 4 digits."""
    return [
        (tp + fp + fn + tn).alias("support"), _rate(tp, tp + fp).alias("precision"), _rate(tp, tp + fn).alias("recall"),
        # 2pr / (p + r) in terms of counts
        _rate(2 * tp, 2 * tp + fp + fn).alias("f1"), _rate(tp + tn, tp + fp + fn + tn).alias("accuracy"), _rate(tn, tn + fp).alias("specificity"),
    ]


def confusion(df: DataFrame, truth: Column, guess: Column, keys: Sequence[str] = ()) -> DataFrame:
    """``tp, fp, fn, tn`` of two columns, for each key, in one aggregate."""
    t, p = as_bool(truth), as_bool(guess)
    return df.groupBy(*keys).agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"))


def binary_metrics(df: DataFrame, truth: Column, guess: Column, keys: Sequence[str] = ()) -> DataFrame:
    counts = confusion(df, truth, guess, keys)
    return counts.select(*keys, "tp", "fp", "fn", "tn", *metrics_from_counts(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def _shown(c: Column) -> Column:
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def categorical_confusion(df: DataFrame, truth: Column, guess: Column, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, _shown(truth).alias("truth"), _shown(guess).alias("guess")).agg(F.count("*").alias("n"))


def categorical_accuracy(df: DataFrame, truth: Column, guess: Column, keys: Sequence[str] = ()) -> DataFrame:
    hit = F.count_if(_shown(truth) == _shown(guess))
    return df.groupBy(*keys).agg(F.count("*").alias("support"), F.coalesce(_rate(hit, F.count("*")), F.lit(0.0)).alias("accuracy"))


def exact_match_rate(df: DataFrame, pairs: Sequence[tuple[Column, Column]]) -> DataFrame:
    """Share of rows in which all pairs have equal texts, untrimmed; null equals null only."""
    same = F.lit(True)
    for a, b in pairs:
        same &= F.coalesce(a.cast("string"), F.lit("None")) == F.coalesce(b.cast("string"), F.lit("None"))
    return df.agg(F.coalesce(_rate(F.count_if(same), F.count("*")), F.lit(0.0)).alias("exact_match_rate"))


def align_by_id(predictions: DataFrame, truth: DataFrame, key: str = "report_id", order: str = "_order") -> DataFrame:
    """INNER JOIN of predictions with the last truth row of their id; columns ``pred`` and ``gt``.

    ``order`` is a column of ``truth`` that tells which row is the last; where ids repeat it is needed.
    """
    id_of = lambda df: F.coalesce(df[key].cast("string"), F.lit("None"))
    keyed = truth.withColumn("_id", id_of(truth))
    if order in truth.columns:
        last = latest_per_key(keyed, ["_id"], None, order)
    else:
        alone = F.when(F.count("*") == 1, F.first(F.struct(*truth.columns))).otherwise(F.raise_error(F.lit(f"ids repeat and no column {order} tells the last row")))
        last = keyed.groupBy("_id").agg(alone.alias("_row")).select("_id", "_row.*")
    right = last.select("_id", F.struct(*[c for c in truth.columns if c != order]).alias("gt"))
    left = predictions.select(id_of(predictions).alias("_id"), F.struct(*predictions.columns).alias("pred"))
    return left.join(right, "_id").drop("_id")


def compare(predictions: DataFrame, truth: DataFrame, task: ExtractionTask, key: str = "report_id", order: str = "_order") -> DataFrame:
    """A row for each field: type, support, counts and rates (binary fields), accuracy; n_aligned; exact match.

    Fields are unpivoted, so that all are scored in one pass over the aligned rows.
    """
    aligned = align_by_id(predictions, truth, key, order)
    get = lambda side, f: F.col(f"{side}.{f}").cast("string") if f in (predictions if side == "pred" else truth).columns else F.lit(None).cast("string")
    fields = [f for f in task.fields]
    same = F.lit(True)
    for f in fields:
        same &= F.coalesce(get("pred", f.name), F.lit("None")) == F.coalesce(get("gt", f.name), F.lit("None"))
    long = aligned.select(same.alias("exact"), F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("field"), F.lit(f.type).alias("type"), get("gt", f.name).alias("t"), get("pred", f.name).alias("p")) for f in fields
    ])).alias("x")).select("exact", "x.*")
    t, p = as_bool(F.col("t")), as_bool(F.col("p"))
    scored = long.groupBy("field", "type").agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"),
        F.count_if(_shown(F.col("t")) == _shown(F.col("p"))).alias("hits"), F.count("*").alias("n_aligned"), F.count_if("exact").alias("exact"),
    )
    binary = F.col("type") == "boolean"
    rates = metrics_from_counts(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    accuracy = F.when(binary, _rate(F.col("tp") + F.col("tn"), F.col("n_aligned"))).otherwise(_rate(F.col("hits"), F.col("n_aligned")))
    only = lambda c, name: F.when(binary, c).alias(name)
    return scored.select(
        "field", "type", "n_aligned", accuracy.alias("accuracy"), *[only(F.col(c), c) for c in ("tp", "fp", "fn", "tn")],
        *[only(c, n) for c, n in zip((rates[1], rates[2], rates[3], rates[5]), ("precision", "recall", "f1", "specificity"))],
        _rate(F.col("exact"), F.col("n_aligned")).alias("exact_match_rate"),
    )


# --- review sheet --------------------------------------------------------------------------------
def quotes_cell(c: Column) -> Column:
    """A JSON list as ``a | b``; other text with its line feeds shown as ``|``."""
    s = review_cell(c)
    items = F.from_json(F.when(s.rlike(r"(?s)^\s*\[.*\]\s*$"), s), "array<string>")
    shown = F.array_join(F.filter(F.transform(items, review_cell), lambda x: x != ""), " | ")
    return F.coalesce(shown, F.replace(s, F.lit("\n"), F.lit(" | ")))


def review_rows(results: DataFrame) -> DataFrame:
    get = lambda c: review_cell(c) if c in results.columns else F.lit("")
    first = F.coalesce(*[F.nullif(get(c), F.lit("")) for c in ("report_id", "patient_id", "source_row_id", "report_name")], F.lit(""))
    cells = {"patient_id": first, "correct_reop": F.lit(""), "notes": F.lit("")}
    cells["evidence_quotes"] = quotes_cell(F.col("evidence_quotes")) if "evidence_quotes" in results.columns else F.lit("")
    cells["reasoning"] = F.replace(get("reasoning"), F.lit("\n"), F.lit(" "))
    return results.select(*[cells.get(c, get(c)).alias(c) for c in REVIEW_COLUMNS])


# --- input checks and join diagnostics -----------------------------------------------------------
def input_checks(reports: DataFrame, id_column: str = "report_id", text_column: str = "report_text") -> DataFrame:
    """Rows ``check, status, value, detail`` from one aggregate over the reports."""
    rid, text = F.coalesce(F.trim(F.col(id_column).cast("string")), F.lit("")), F.coalesce(strip(F.col(text_column).cast("string")), F.lit(""))
    one = reports.agg(F.count("*").alias("n"), F.count_if(rid == "").alias("missing"), (F.count("*") - F.count_distinct(rid)).alias("twice"), F.count_if(text == "").alias("empty"))
    checks = (
        ("report_row_count", F.col("n"), F.col("n") > 0, "warn", ""), ("missing_report_ids", F.col("missing"), F.col("missing") == 0, "fail", "must be 0"),
        ("duplicate_report_ids", F.col("twice"), F.col("twice") == 0, "warn", "report_id should be unique"), ("empty_report_text", F.col("empty"), F.col("empty") == 0, "warn", "reports with no text"),
    )
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("check"), F.when(fine, "ok").otherwise(bad).alias("status"), value.cast("string").alias("value"), F.lit(detail).alias("detail"))
        for name, value, fine, bad, detail in checks
    ])).alias("x")).select("x.*")


def id_shape(c: Column) -> Column:
    n = F.length(c).cast("string")
    return (
        F.when(c.rlike(r"^\d+$"), F.concat(F.lit("digits_len_"), n)).when(c.rlike(r"^\d+\.\d+$"), "decimal_string")
        .when(c.rlike(r"(?s)^[A-Za-z].*$"), "starts_alpha").otherwise(F.concat(F.lit("other_len_"), n))
    )


def id_set(df: DataFrame, column: str) -> DataFrame:
    return df.select(normalize_str(column).alias("id")).filter("id != ''").distinct()


def without_leading_zeros(c: Column) -> Column:
    stripped = F.regexp_replace(c, "^0+", "")
    return F.when(stripped == "", "0").otherwise(stripped)


def shapes(ids: DataFrame, most: int = 8) -> DataFrame:
    return ids.groupBy(id_shape(F.col("id")).alias("shape")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "shape").limit(most)


def lengths(ids: DataFrame, most: int = 8) -> DataFrame:
    return ids.groupBy(F.length("id").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "length").limit(most)


def id_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: sizes, overlap, both differences, match rate of the left, overlap without leading zeros.

    One union and two aggregates instead of separate INTERSECT and EXCEPT passes.
    """
    both = left.select("id", F.lit(1).alias("l"), F.lit(0).alias("r")).union(right.select("id", F.lit(0).alias("l"), F.lit(1).alias("r")))
    exact = both.groupBy("id").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    counts = exact.agg(
        F.count_if(F.expr("l = 1")).alias("n_left"), F.count_if(F.expr("r = 1")).alias("n_right"), F.count_if(F.expr("l = 1 and r = 1")).alias("n_both"),
        F.count_if(F.expr("l = 1 and r = 0")).alias("n_left_only"), F.count_if(F.expr("l = 0 and r = 1")).alias("n_right_only"),
    )
    loose = exact.groupBy(without_leading_zeros(F.col("id")).alias("z")).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    loose = loose.agg(F.count_if(F.expr("l = 1 and r = 1")).alias("n_both_without_zeros"))
    rate = F.round(F.when(F.col("n_left") > 0, 100.0 * F.col("n_both") / F.col("n_left")), 1).alias("match_percent")
    return counts.crossJoin(F.broadcast(loose)).select("*", rate)  # one row each


def only_in(left: DataFrame, right: DataFrame, sample: int) -> DataFrame:
    """The first ids that are in ``left`` alone."""
    return left.join(right, "id", "left_anti").orderBy("id").limit(sample)


def clean_keys(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, clean_id(column))

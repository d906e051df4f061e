"""Relational core: ordered concatenation and latest row per key, joins, resume, upsert, samples.

Row order is a column: sources give every row an ``_order`` (see ``with_row_order``), and operators
that mean "in file order" sort by it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tessella.functions.text import clean_id, normalize_str, report_type
from tessella.operators.staging import fixed, unused

# Names under which columns come, and columns shown in headers.
PATIENT_ALIASES = ("PatientID", "PatientenID", "patient_id", "patientenid")
VALUE_ALIASES = ("Diagnose_Value", "DiagnoseValue", "diagnose_value", "Diagnose")
TIME_ALIASES = ("Diagnose_Time", "DiagnoseTime", "diagnose_time")
TRANSFER_PATIENT_ALIASES = ("patnr", *PATIENT_ALIASES)
TRANSFER_DATE_ALIASES = ("berdat", "BerichtDatum", "bericht_datum")
SECTION_COLUMNS = ("diag", "epikrise", "jetziges_leiden", "prozedere")
ENTRY_COLUMNS = ("FallNummer", "OP_TerminNummer", "OP_BeginnZeit", "OP_EndeZeit")
TRANSFER_HEADER = ("FallNummer", "fallnr", "OP_TerminNummer", "berdat", "bertyp")
JOINED_KIND = "patient_diagnoseliste_verlegung"
DIAGNOSES, TRANSFER = "[Diagnoseliste]", "[Verlegungsbericht]"
ORDER = "_order"


class SchemaValidationError(ValueError):
    """A table lacks columns it needs."""


def require_columns(df: DataFrame, names: Sequence[str], context: str) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise SchemaValidationError(f"{context}: missing column(s) {', '.join(missing)}; available: {', '.join(df.columns)}")


def find_column(columns: Sequence[str], aliases: Sequence[str], label: str) -> str:
    """First alias that is there, exactly or but for case and outer blanks; ValueError if none is."""
    loose = {c.strip().lower(): c for c in columns}
    for alias in aliases:
        if alias in columns:
            return alias
        if alias.lower() in loose:
            return loose[alias.lower()]
    raise ValueError(f"no column for {label}: tried {', '.join(aliases)}; found {', '.join(columns)}")


def maybe_column(columns: Sequence[str], aliases: Sequence[str]) -> str | None:
    try:
        return find_column(columns, aliases, "")
    except ValueError:
        return None


def with_row_order(df: DataFrame, *by: str, into: str = ORDER) -> DataFrame:
    """Dense numbers from 0 in the order of ``by``, without a single-task window.

    Rows are range-partitioned, sorted and written once, with the number of their partition and
    their place in it; the driver adds up one count for each partition of what was written. Range
    bounds are sampled and partitions merged anew by every plan, so nothing but the written rows tells
    where a row stands. Rows that are equal in ``by`` get their numbers in any order.
    """
    part, place, start = unused([*df.columns, into], "_part", "_place", "_start")
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = fixed(ranged.withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id()}))
    at, starts = 0, []
    for number, count in sorted(map(tuple, rows.groupBy(part).count().collect())):  # a row for each partition
        starts.append((number, at))
        at += count
    known = F.broadcast(df.sparkSession.createDataFrame(starts, f"{part} int, {start} long"))
    within = F.col(place) - F.shiftleft(F.col(part).cast("long"), 33)
    return rows.join(known, part).select(*[F.col(f"`{c}`") for c in df.columns if c != into], (F.col(start) + within).alias(into))


def assign_row_ids(df: DataFrame, *by: str, prefix: str = "row_", into: str = "source_row_id") -> DataFrame:
    """``source_row_id`` = prefix + dense number in the order of ``by``; an existing column is replaced."""
    return with_row_order(df.drop(into), *by, into="_n").withColumn(into, F.concat(F.lit(prefix), F.col("_n").cast("string"))).drop("_n")


def parse_time(c: Column) -> Column:
    """Timestamp of a string, each value by itself; null if it is none."""
    return F.coalesce(F.try_to_timestamp(c), F.try_to_timestamp(c, F.lit("dd.MM.yyyy")), F.try_to_timestamp(c, F.lit("dd.MM.yyyy HH:mm")))


def _header(parts: list[Column], between: str = " | ") -> Column:
    return F.concat_ws(between, *parts)


def _labelled(label: str, c: Column) -> Column:
    return F.when(c != "", F.concat(F.lit(f"{label}="), c))


def format_entry(index: Column, value: Column, time: Column, meta: dict[str, Column]) -> Column:
    """``[#1 | time=... | FallNummer=...]`` and the value on the next line; empty parts are left out."""
    head = _header([F.concat(F.lit("#"), index.cast("string")), _labelled("time", time), *[_labelled(k, c) for k, c in meta.items()]])
    return F.concat(F.lit("["), head, F.lit("]\n"), value)


#: entries that are joined into one text, or intervals that are united, before their key's are
ENTRIES, INTERVALS = 1000, 100_000


def numbered_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], into: str = "_rn", count: str = "_of") -> DataFrame:
    """Rows of each key numbered from 1 in their order, and how many it has, without a task for a key.

    Rows are numbered over all keys by ranges, so a key with half of all rows lies in half of the
    ranges; its first number comes from an aggregate that is combined before the shuffle.
    """
    place, first = unused([*df.columns, into, count], "_n", "_from")
    whole = with_row_order(df, *keys, *order, into=place)
    firsts = whole.groupBy(*keys).agg(F.min(place).alias(first), F.count("*").alias(count))
    names = unused([*whole.columns, first, count], *[f"_key{k}" for k in range(len(keys))])
    renamed = firsts.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], first, count)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return whole.join(renamed, same).withColumn(into, F.col(place) - F.col(first) + 1).drop(place, first, *names)


def joined_texts(rows: DataFrame, key: str, entry: str, number: str, between: str, into: str, count: str, first: str | None = None) -> DataFrame:
    """One row for each key: its entries in the order of their numbers from 1, joined in two steps, how many, and the least ``first``.

    ``ENTRIES`` neighbours become one text in the first step, so a key's rows meet in many tasks, and only these
    texts in one.
    """
    ordered = lambda n, text: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(n, text))), lambda x: x[text]), between)
    least = [F.min(first).alias(first)] if first else []
    some = rows.groupBy(key, F.floor((F.col(number) - 1) / ENTRIES).alias("_part")).agg(ordered(number, entry).alias("_text"), F.count("*").alias("_some"), *least)
    return some.groupBy(key).agg(ordered("_part", "_text").alias(into), F.sum("_some").cast("int").alias(count), *least)


def ordered_concat(df: DataFrame, key: str, entry: str, order: Sequence[Column], between: str = "\n\n", into: str = "text", count: str = "n") -> DataFrame:
    """One row for each key: its entries joined in order, and how many there are."""
    names = [f"_by{k}" for k in range(len(order))]
    rows = df.select(key, entry, *[c.alias(n) for c, n in zip(order, names)])
    return joined_texts(numbered_within(rows, [key], names), key, entry, "_rn", between, into, count)


def diagnosis_records(df: DataFrame, order: str = ORDER) -> DataFrame:
    """One record for each patient, with all diagnoses as numbered entries in the order of their times.

    Rows without patient or value go; without a time column, and among equal times, rows keep the
    order of ``order``; rows whose time cannot be read come last.
    """
    names = [c for c in df.columns if c != order]
    patient, value = find_column(names, PATIENT_ALIASES, "patient id"), find_column(names, VALUE_ALIASES, "diagnosis value")
    time = maybe_column(names, TIME_ALIASES)
    meta = {c: f"_meta_{k}" for k, c in enumerate(ENTRY_COLUMNS) if c in names}
    rows = df.select(
        normalize_str(patient).alias("patient_id"), normalize_str(value).alias("_value"),
        (normalize_str(time) if time else F.lit("")).alias("_time"), F.col(order), *[normalize_str(c).alias(a) for c, a in meta.items()],
    ).filter("patient_id != '' and _value != ''")
    rows = rows.withColumn("_at", parse_time(F.col("_time")) if time else F.lit(None).cast("timestamp"))
    numbered = numbered_within(rows.withColumn("_undated", F.col("_at").isNull()), ["patient_id"], ["_undated", "_at", order])
    entry = format_entry(F.col("_rn"), F.col("_value"), F.col("_time"), {c: F.col(a) for c, a in meta.items()})
    grouped = joined_texts(numbered.withColumns({"_entry": entry, "_first": F.col(order)}), "patient_id", "_entry", "_rn", "\n\n", "_body", "n_diagnosis_entries", "_first")
    text = F.concat(F.lit(f"{DIAGNOSES}\n\n"), F.col("_body"))
    placed = with_row_order(grouped, *(["patient_id"] if time else ["_first"]), into=order)
    return placed.select(
        F.col("patient_id").alias("report_id"), text.alias("report_text"), text.alias("diagnoseliste_text"),
        F.concat(F.lit("patient_"), F.col(order).cast("string")).alias("source_row_id"), "patient_id", "n_diagnosis_entries",
        F.lit("patient_diagnoseliste").alias("input_kind"), order,
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns that a frame lacks are null."""
    if not frames:
        raise ValueError("no tables to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def transfer_text(names: Sequence[str]) -> Column:
    """Header of a transfer report, then its sections that are not empty."""
    header = _header([_labelled(c, normalize_str(c)) for c in TRANSFER_HEADER if c in names])
    head = F.when(header == "", TRANSFER).otherwise(F.concat(F.lit(f"{TRANSFER} "), header))
    loose = {c.strip().lower(): c for c in reversed(list(names))}
    parts = [F.when((t := normalize_str(loose[s])) != "", F.concat(F.lit(f"[{s}]\n"), t)) for s in SECTION_COLUMNS if s in loose]
    return F.concat_ws("\n\n", head, *parts)


def latest_per_key(df: DataFrame, keys: Sequence[str], time: Column | None, order: str = ORDER, count: str | None = None) -> DataFrame:
    """The row with the latest time of each key; undated rows lose, ties go to the last in order.

    One ``max_by`` hash aggregate with map-side combine, no sort.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct((time if time is not None else F.lit(None).cast("timestamp")).alias("t"), F.col(order).alias("o"))
    counts = [F.count("*").cast("int").alias(count)] if count else []
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"), *counts)
    return best.select(*keys, "_row.*", *([count] if count else []))


def latest_transfer(df: DataFrame, order: str = ORDER) -> DataFrame:
    """``patient_id, verlegung_text, verlegung_berdat, verlegung_fallnr, n_verlegung_rows`` of the latest report."""
    names = [c for c in df.columns if c != order]
    patient, date = find_column(names, TRANSFER_PATIENT_ALIASES, "patient id"), maybe_column(names, TRANSFER_DATE_ALIASES)
    case = next((c for c in ("fallnr", "FallNummer") if c in names), None)
    rows = df.select(
        normalize_str(patient).alias("patient_id"), transfer_text(names).alias("verlegung_text"),
        (normalize_str(date) if date else F.lit("")).alias("verlegung_berdat"), (normalize_str(case) if case else F.lit("")).alias("verlegung_fallnr"), order,
    ).filter("patient_id != ''")
    return latest_per_key(rows, ["patient_id"], parse_time(F.col("verlegung_berdat")) if date else None, order, "n_verlegung_rows").drop(order)


def attach_transfer(records: DataFrame, transfers: DataFrame | None, files: str = "") -> DataFrame:
    """LEFT OUTER join of the latest transfer report by patient; records without one get an empty text.

    The engine chooses the join: neither side's size is known here.
    """
    if transfers is None:
        return records
    key = normalize_str("patient_id") if "report_id" not in records.columns else F.when(normalize_str("patient_id") != "", normalize_str("patient_id")).otherwise(normalize_str("report_id"))
    right = transfers.withColumnRenamed("patient_id", "_patient").withColumn("_matched", F.lit(True))
    out = records.withColumn("_key", key).join(right, F.col("_key") == F.col("_patient"), "left")
    out = out.withColumn("verlegung_text", F.coalesce("verlegung_text", F.lit("")))
    out = out.withColumn("input_kind", F.when(F.col("_matched"), JOINED_KIND).otherwise(F.col("input_kind")))
    if "source_files" in records.columns and files:
        out = out.withColumn("source_files", F.when(F.col("_matched"), F.concat_ws(", ", F.when(F.col("source_files") != "", F.col("source_files")), F.lit(files))).otherwise(F.col("source_files")))
    return out.drop("_key", "_patient", "_matched")


def text_for_source(columns: Iterable[str], source: str) -> Column:
    """The text a variable reads: diagnoses, transfer report, both, or the report; with fallbacks."""
    held = set(columns)
    get = lambda c: normalize_str(c) if c in held else F.lit("")
    raw_diag, raw_transfer, report = get("diagnoseliste_text"), get("verlegung_text"), get("report_text")
    is_transfer = report.contains(TRANSFER)
    diag = F.when(raw_diag != "", raw_diag).when((report != "") & ~is_transfer, report).otherwise("")
    transfer = F.when(raw_transfer != "", raw_transfer).when((report != "") & is_transfer & (diag == ""), report).otherwise("")
    first = lambda *cs: F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], F.lit(""))
    both = F.concat_ws("\n\n", F.nullif(diag, F.lit("")), F.nullif(transfer, F.lit("")))
    kinds = {"diagnoseliste": first(diag, report), "verlegung": transfer, "both": first(both, report)}
    return kinds.get((source or "report").strip().lower(), first(report, diag, transfer))


def stitch_sections(columns: Sequence[str]) -> Column:
    """``[column]`` and its text for every column that is not empty, joined by a blank line."""
    return F.concat_ws("\n\n", *[F.when(normalize_str(c) != "", F.concat(F.lit(f"[{c}]\n"), normalize_str(c))) for c in columns])


def normalize_id_column(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, clean_id(column)) if column in df.columns else df


def exclude_types(df: DataFrame, types: Iterable[str], column: str = "report_type", told: Observation | None = None) -> DataFrame:
    """NOT IN on the trimmed type; nulls stay, and so does all if there is no such column or no type.

    ``told`` learns ``excluded``, the number of rows left out, from the first action, at no cost of its own.
    """
    unwanted = sorted({t.strip() for t in types if t.strip()})
    out = report_type(column).isin(*unwanted) if unwanted and column in df.columns else F.lit(False)
    seen = df.observe(told, F.count_if(out).alias("excluded")) if told is not None else df
    return seen.filter(~out) if unwanted and column in df.columns else seen


def first_rows(df: DataFrame, n: int | None, order: str = ORDER) -> DataFrame:
    """The first ``n`` rows in load order, as a filter on the dense order column."""
    return df if n is None else df.filter(F.col(order) < n)


# --- resume, retry, upsert -----------------------------------------------------------------------
def resume_key(df: DataFrame) -> Column:
    """Struct (kind, value): source_row_id, else report_id, else the whole row."""
    def value(c: str) -> Column:
        s = F.trim(F.col(c).cast("string"))
        return F.when((s != "") & ~F.lower(s).isin("nan", "none"), F.struct(F.lit(c).alias("kind"), s.alias("value")))

    whole = F.struct(F.lit("idx").alias("kind"), F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))
    return F.coalesce(*[value(c) for c in ("source_row_id", "report_id") if c in df.columns], whole)


def unprocessed(reports: DataFrame, done: DataFrame) -> DataFrame:
    """LEFT ANTI join on the resume key."""
    keys = done.select(resume_key(done).alias("_k")).distinct()
    return reports.withColumn("_k", resume_key(reports)).join(keys, "_k", "left_anti").drop("_k")


def to_retry(reports: DataFrame, results: DataFrame, statuses: tuple[str, ...] = ("failed", "partial")) -> DataFrame:
    """LEFT SEMI on the resume key or on report_id, as two equi-joins and a mark, not an OR condition."""
    bad = results.filter(F.lower(F.trim("status")).isin(*statuses))
    by_key = bad.select(resume_key(bad).alias("_k")).distinct().withColumn("_by_key", F.lit(True))
    by_id = bad.select(F.trim(F.col("report_id").cast("string")).alias("_r")).filter("_r != ''").distinct().withColumn("_by_id", F.lit(True))
    marked = reports.withColumn("_k", resume_key(reports)).withColumn("_r", F.trim(F.col("report_id").cast("string")))
    marked = marked.join(by_key, "_k", "left").join(by_id, "_r", "left")
    return marked.filter("_by_key or _by_id").select(*reports.columns)


def upsert(existing: DataFrame, updates: DataFrame, order: str = ORDER) -> DataFrame:
    """Rows of ``existing`` replaced by the last update with their key; new keys follow, in their order.

    Columns are those of ``existing``; ``order`` continues behind the existing rows.
    """
    columns = [c for c in existing.columns if c != order]
    keyed = updates.select(*[F.col(c) for c in columns], order).withColumn("_k", resume_key(updates.select(*columns)))
    last = keyed.groupBy("_k").agg(F.max_by(F.struct(*columns), order).alias("_new"), F.min(order).alias("_at"))
    base = existing.withColumn("_k", resume_key(existing.select(*columns)))
    top = existing.agg(F.coalesce(F.max(order) + 1, F.lit(0)).alias("_top"))
    joined = base.join(last, "_k", "full").crossJoin(F.broadcast(top))  # one row
    chosen = [F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    return joined.select(*chosen, F.coalesce(F.col(order), F.col("_top") + F.col("_at")).alias(order))


def count_statuses(df: DataFrame) -> DataFrame:
    return df.groupBy("status").agg(F.count("*").alias("n"))


def keep_done(df: DataFrame) -> DataFrame:
    """Rows that a resumed run keeps: all but the failed ones (partial counts as done)."""
    return df.filter(F.coalesce(F.lower(F.trim("status")), F.lit("")) != "failed")


def seeded_sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """``n`` rows without replacement, the same for the same seed: those with the smallest hashes."""
    return df.orderBy(F.md5(F.concat_ws(" ", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)

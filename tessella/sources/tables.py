"""Sources: delimited text of unknown dialect, spreadsheets, folders of texts, and what they hold.

Head bytes are sniffed on the driver; files are then read once, by Spark where it knows the
encoding. Every cell is a string, header names are stripped, and each row keeps its place in
``_order``.
"""

from __future__ import annotations

import csv
import io
import logging
import re
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path, PurePosixPath
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.functions.text import normalize_str
from tessella.operators import relational as R
from tessella.sources import delimited

# Dialects to try, in this order, cells that count as missing, and file names.
ENCODINGS = ("utf-8-sig", "utf-8", "utf-16", "cp1252", "latin-1")
SEPARATORS = (",", ";", "\t")
LOGGER = logging.getLogger(__name__)
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
EXCEL = (".xlsx", ".xls", ".xlsm")
TABULAR = (".csv", ".tsv", ".txt", *EXCEL)
DIAGNOSIS_PREFIX, TRANSFER_PREFIX = "HER_Diagnose", "HER_Verlegungsbericht"
_HEAD = 1 << 16
#: how Spark's reader takes the encodings whose lines end with a single byte
_SPARK_ENCODING = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "cp1252": "ISO-8859-1", "latin-1": "ISO-8859-1"}


def _head(spark: SparkSession, path: str) -> bytes:
    """First bytes of a file in any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(str(path))
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, _HEAD)))
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(path))
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def sniff(head: bytes, sep: str | None = None, encodings: Sequence[str] = ENCODINGS) -> tuple[str, str, list[str]]:
    """Encoding, separator and header of a delimited file: the parse with the most columns, the first
    of equals; with ``sep`` given the first encoding that decodes. ValueError if none does."""
    best: tuple[str, str, list[str]] | None = None
    for encoding in encodings:
        text = _decode(head, encoding)
        if text is None:
            continue
        for s in (sep,) if sep else SEPARATORS:
            header = next(csv.reader(io.StringIO(text), delimiter=s), None)
            if header and (best is None or len(header) > len(best[2])):
                best = (encoding, s, header)
        if sep and best:
            break
    if best is None:
        raise ValueError("the file could not be read as delimited text")
    return best


def _decode(head: bytes, encoding: str) -> str | None:
    """The head in an encoding, forgiving only a character cut off at its end; UTF-16 needs its mark."""
    if encoding == "utf-16" and not head.startswith((b"\xff\xfe", b"\xfe\xff")):
        return None
    for cut in range(4):
        try:
            return head[: len(head) - cut].decode(encoding)
        except UnicodeError:
            if len(head) < _HEAD:
                return None
    return None


@dataclass
class Scan:
    """What one pass over all lines of a file tells: whether they decode, and by which separators all of them are whole rows."""

    utf8: bool
    cp1252: bool
    rows: dict[str, bool]


def _scan(spark: SparkSession, path: str, separators: Sequence[str]) -> Scan:
    lines = spark.read.option("lineSep", "\n").text(str(path)).select("value", F.hex(F.col("value").cast("binary")).alias("octets"))
    undefined = F.col("octets").rlike("^(?:..)*?(?:81|8D|8F|90|9D)")
    latin = F.decode(F.col("value").cast("binary"), "ISO-8859-1")  # quotes, separators and line ends are single bytes
    odd = [F.max((~latin.rlike(delimited.well_formed(s))).cast("int")).alias(f"s{k}") for k, s in enumerate(separators)]
    found = lines.agg(F.max((~F.is_valid_utf8("value")).cast("int")).alias("utf8"), F.max(undefined.cast("int")).alias("cp1252"), *odd).first()
    return Scan(not found["utf8"], not found["cp1252"], {s: not found[f"s{k}"] for k, s in enumerate(separators)})


def _scan_head(head: bytes, separators: Sequence[str]) -> Scan:
    """The same of a file that is no longer than its head."""
    plain = head.decode("latin-1").split("\n")
    strict = lambda encoding: _decode(head, encoding) is not None
    return Scan(strict("utf-8"), strict("cp1252"), {s: all(re.match(delimited.well_formed(s).replace("\\r?$", r"\r?\Z"), x) for x in plain) for s in separators})


def dialects(head: bytes, sep: str | None) -> Iterator[tuple[str, str, list[str]]]:
    """What ``sniff`` finds in the head, then what it finds without the encodings before."""
    encodings = list(ENCODINGS)
    while encodings:
        found = sniff(head, sep, encodings)
        yield found
        encodings.remove(found[0])


def _blank_missing(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(F.col(f"`{c}`").isin(*MISSING) | F.col(f"`{c}`").isNull(), "").otherwise(F.col(f"`{c}`")).alias(c) if c != R.ORDER else F.col(c) for c in df.columns])


def _unique(names: Sequence[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for k, name in enumerate(n.strip().lstrip("﻿") for n in names):
        name = name or f"Unnamed: {k}"
        seen[name] = seen.get(name, -1) + 1
        out.append(f"{name}.{seen[name]}" if seen[name] else name)
    return out


def read_tabular(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """A delimited file as strings, its dialect found out. Short rows are filled up, rows with too
    many cells are skipped, missing-value marks become empty cells.

    One pass over the lines tells whether they decode and whether each is a row. Where all are,
    Spark's reader takes them; else, and in UTF-16, ``delimited`` does, by as many tasks.
    """
    head = _head(spark, path)
    separators = (sep,) if sep else SEPARATORS
    scan: Scan | None = None
    for encoding, sep, header in dialects(head, sep):
        layout = None
        if encoding == "utf-16":
            python = "utf-16-be" if head.startswith(b"\xfe\xff") else "utf-16-le"
            layout = delimited.block_states(spark, path, python, sep)
            if layout is None:
                return _whole(spark, path, encoding, sep, header)
            fits = layout.decodes
        else:
            scan = scan or (_scan(spark, path, separators) if len(head) == _HEAD else _scan_head(head, separators))
            fits, python = {"cp1252": scan.cp1252, "latin-1": True}.get(encoding, scan.utf8), encoding.removesuffix("-sig")
        if fits:
            break
    else:
        raise ValueError("the file could not be read as delimited text")
    names = _unique(header)
    if layout is None and scan.rows[sep]:
        return _lines(spark, path, encoding, sep, names)
    layout = layout or delimited.block_states(spark, path, python, sep)
    ordered = delimited.in_order(delimited.parsed_blocks(spark, path, python, sep, len(names), layout), R.ORDER)
    return _named(ordered, names)


def _named(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    return _blank_missing(rows.select(*[F.col(f"c{k}").alias(n) for k, n in enumerate(names)], R.ORDER))


def _lines(spark: SparkSession, path: str, encoding: str, sep: str, names: Sequence[str]) -> DataFrame:
    """A file whose lines are rows, by Spark's reader."""
    extra = "_extra"
    schema = T.StructType([*[T.StructField(f"c{k}", T.StringType()) for k in range(len(names))], T.StructField(extra, T.StringType())])
    reader = spark.read.schema(schema).options(sep=sep, header=True, quote='"', escape='"', encoding=_SPARK_ENCODING[encoding], mode="PERMISSIVE", enforceSchema=True, maxCharsPerColumn=-1)
    rows = reader.csv(str(path)).withColumns({"_block": F.col("_metadata.file_block_start"), "_at": F.monotonically_increasing_id()})
    rows = rows.filter(F.col(extra).isNull()).drop(extra)
    if encoding == "cp1252":
        rows = rows.withColumns({c: delimited.from_latin1(F.col(c)) for c in rows.columns if c.startswith("c")})
    return _named(R.with_row_order(rows, "_block", "_at").drop("_block", "_at"), names)


def _whole(spark: SparkSession, path: str, encoding: str, sep: str, header: Sequence[str]) -> DataFrame:
    """A file in UTF-16 that has a block border within what looks like a line end: by one task."""
    names = _unique(header)
    raw = spark.read.format("binaryFile").load(str(path)).select("content")

    def parse(frames):
        for pdf in frames:
            for content in pdf["content"]:
                found = csv.reader(io.StringIO(content.decode(encoding, "replace"), newline=""), delimiter=sep)
                next(found, None)
                kept = [(k, *row, *[None] * (len(names) - len(row))) for k, row in enumerate(found) if row and len(row) <= len(names)]
                yield pd.DataFrame(kept, columns=["_at", *[f"c{k}" for k in range(len(names))]])

    rows = raw.mapInPandas(parse, "_at long, " + ", ".join(f"c{k} string" for k in range(len(names))))
    return _named(R.with_row_order(rows, "_at").drop("_at"), names)


# --- spreadsheets --------------------------------------------------------------------------------
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}


def sheet_names(data: bytes) -> list[str]:
    """Names of a workbook's sheets, in their order."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        return [s.get("name", "") for s in ElementTree.fromstring(book.read("xl/workbook.xml")).findall("m:sheets/m:sheet", _NS)]


def sheet_rows(data: bytes, number: int = 0) -> Iterator[list[str]]:
    """Rows of a sheet of a workbook, the first one, as strings; missing cells are empty."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
        first = ElementTree.fromstring(book.read("xl/workbook.xml")).findall("m:sheets/m:sheet", _NS)[number]
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        target = links[first.get(f"{{{_NS['r']}}}id")].lstrip("/")
        sheet = ElementTree.fromstring(book.read(target if target.startswith("xl/") else f"xl/{target}"))
    for row in sheet.iterfind("m:sheetData/m:row", _NS):
        cells: dict[int, str] = {}
        for place, c in enumerate(row.findall("m:c", _NS)):
            if ref := re.match(r"[A-Z]+", c.get("r", "")):
                place = sum((ord(ch) - 64) * 26**k for k, ch in enumerate(reversed(ref[0]))) - 1
            value = c.find("m:v", _NS)
            if c.get("t") == "inlineStr":
                cells[place] = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
            elif value is not None:
                text = value.text or ""
                cells[place] = shared[int(text)] if c.get("t") == "s" else {"1": "True", "0": "False"}[text] if c.get("t") == "b" else text
        yield [cells.get(k, "") for k in range(max(cells, default=-1) + 1)]


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    """First sheet of a workbook (at most a million rows by its format), all strings.

    An executor reads and parses the book; the driver sees the header alone.
    """
    if str(path).lower().endswith(".xls"):
        raise ImportError("the binary .xls format needs a converter that is not installed; save the file as .xlsx")
    raw = spark.read.format("binaryFile").load(str(path)).select("content")
    names = _unique(raw.select(_first_row("content").alias("names")).first()["names"])

    def parse(frames):
        for pdf in frames:
            for content in pdf["content"]:
                rows = sheet_rows(bytes(content))
                next(rows, None)
                kept = [(k, *(row + [""] * len(names))[: len(names)]) for k, row in enumerate(rows) if any(row)]
                yield pd.DataFrame(kept, columns=[R.ORDER, *[f"c{k}" for k in range(len(names))]])

    rows = raw.mapInPandas(parse, f"{R.ORDER} long, " + ", ".join(f"c{k} string" for k in range(len(names)))) if names else spark.createDataFrame([], f"{R.ORDER} long")
    return _blank_missing(rows.select(*[F.col(f"c{k}").alias(n) for k, n in enumerate(names)], R.ORDER))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _first_row(content: pd.Series) -> pd.Series:
    return content.map(lambda b: next(sheet_rows(bytes(b)), []))


def is_excel(path: str) -> bool:
    return PurePosixPath(str(path)).suffix.lower() in EXCEL


def read_table(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    return read_workbook(spark, path) if is_excel(path) else read_tabular(spark, path, sep)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names alone, from the head of the file; none for a file that cannot be read."""
    try:
        if is_excel(path):
            return [c for c in read_workbook(spark, path).columns if c != R.ORDER]
        return _unique(sniff(_head(spark, path))[2])
    except Exception:  # noqa: BLE001 - whatever cannot be read is no table of ours
        return []


def looks_like_diagnoses(spark: SparkSession, path: str) -> bool:
    names = {c.strip().lower() for c in header_of(spark, path)}
    return all(any(a.lower() in names for a in aliases) for aliases in (R.PATIENT_ALIASES, R.VALUE_ALIASES))


def looks_like_transfers(spark: SparkSession, path: str) -> bool:
    names = {c.strip().lower() for c in header_of(spark, path)}
    return any(a.lower() in names for a in R.TRANSFER_PATIENT_ALIASES) and any(s in names for s in R.SECTION_COLUMNS)


def _files(spark: SparkSession, pattern: str) -> list[tuple[str, str, bool]]:
    """Name, path and whether it is a folder, of all that a pattern names in any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return [(f.getPath().getName(), f.getPath().toString(), f.isDirectory()) for f in found or []]


def files_in(spark: SparkSession, pattern: str) -> list[str]:
    """Files whose paths fit a pattern of any store that Spark reads, by name."""
    return [path for _, path, folder in sorted(_files(spark, pattern)) if not folder]


def is_folder(spark: SparkSession, path: str) -> bool:
    return any(folder for _, _, folder in _files(spark, str(path)))


def discover(spark: SparkSession, folder: str, prefix: str, without: str = "") -> list[str]:
    """Tabular files with a prefix; a CSV goes before a spreadsheet of the same stem; by name."""
    best: dict[str, tuple[str, str]] = {}
    for name, path, is_dir in sorted(_files(spark, f"{folder}/{prefix}*")):
        stem, _, suffix = name.rpartition(".")
        if is_dir or f".{suffix.lower()}" not in TABULAR or (without and without in name.lower()):
            continue
        if stem not in best or suffix.lower() == "csv" and not best[stem][0].lower().endswith(".csv"):
            best[stem] = (name, path)
    return [path for _, path in sorted(best.values(), key=lambda x: x[0].lower())]


def discover_diagnoses(spark: SparkSession, folder: str) -> list[str]:
    return discover(spark, folder, DIAGNOSIS_PREFIX, without="verlegung")


def discover_transfers(spark: SparkSession, folder: str) -> list[str]:
    return discover(spark, folder, TRANSFER_PREFIX)


# --- reports -------------------------------------------------------------------------------------
@F.pandas_udf(T.StringType())
def _utf8(s: pd.Series) -> pd.Series:
    return s.map(lambda b: None if b is None else bytes(b).decode("utf-8", "replace"))


def load_texts(spark: SparkSession, folder: str) -> DataFrame:
    """``*.txt`` of a folder as reports, by path; bytes that are not UTF-8 become U+FFFD."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(str(folder))
    rows = raw.select(F.col("path"), F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.txt$", "").alias("report_id"), _utf8("content").alias("report_text"))
    rows = R.with_row_order(rows, "path").withColumn("source_row_id", F.concat(F.lit("row_"), F.col(R.ORDER).cast("string")))
    return rows.select("report_id", "report_text", "source_row_id", R.ORDER)


def reports_from_table(spark: SparkSession, path: str, id_column: str = "report_id", text_column: str = "report_text", section_columns: Sequence[str] = ()) -> DataFrame:
    """A table of reports; rows get ids before those without a report id go; other columns stay."""
    if looks_like_diagnoses(spark, path):
        return diagnoses_many(spark, [path])
    df = read_table(spark, path)
    if id_column not in df.columns:
        raise ValueError(f"{path} has no id column {id_column!r}; found {', '.join(df.columns)}")
    sections = [c for c in section_columns if c in df.columns]
    if text_column not in df.columns and not sections:
        raise ValueError(f"{path} has neither {text_column!r} nor section columns; found {', '.join(df.columns)}")
    text = normalize_str(text_column) if text_column in df.columns else R.stitch_sections(sections)
    others = [c for c in df.columns if c not in (id_column, text_column, "report_id", "report_text", "source_row_id", R.ORDER)]
    return df.select(
        normalize_str(id_column).alias("report_id"), text.alias("report_text"), F.concat(F.lit("row_"), F.col(R.ORDER).cast("string")).alias("source_row_id"),
        *[normalize_str(f"`{c}`").alias(c) for c in others], R.ORDER,
    ).filter("report_id != ''")


def _united(spark: SparkSession, paths: Sequence[str], key_aliases: Sequence[str]) -> DataFrame:
    """UNION ALL of files in their order; the key's alias is resolved for each file before."""
    frames, target = [], key_aliases[0]
    for k, path in enumerate(paths):
        if not exists(spark, str(path)):
            raise FileNotFoundError(f"no such input: {path}")
        df = read_table(spark, str(path))
        found = R.maybe_column(df.columns, key_aliases)
        df = df.withColumnRenamed(found, target) if found else df
        frames.append(df.withColumn(R.ORDER, F.col(R.ORDER) + F.lit(k << 40)))
    return R.union_all(frames)


def diagnoses_many(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    if not paths:
        raise FileNotFoundError("no diagnosis files were given")
    names = ", ".join(PurePosixPath(str(p)).name for p in paths)
    return R.diagnosis_records(_united(spark, paths, R.PATIENT_ALIASES)).withColumn("source_files", F.lit(names))


def transfers_by_patient(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    return R.latest_transfer(_united(spark, paths, R.TRANSFER_PATIENT_ALIASES)) if paths else None


def load_reports(spark: SparkSession, source: str | Sequence[str] | None = None, id_column: str = "report_id", text_column: str = "report_text", section_columns: Sequence[str] = (), raw_dir: str = "data/raw") -> DataFrame:
    """Reports from whatever the paths hold: nothing given means the discovered files of ``raw_dir``.

    Diagnosis tables become one record for each patient, with the latest transfer report joined;
    transfer tables alone become records of their own; other tables are concatenated (row ids start
    anew in each file); a folder holds texts. Clinical and other tables do not mix.
    """
    paths = [str(p) for p in ([source] if isinstance(source, (str, Path)) else source or [])]
    if not paths:
        paths = [*discover_diagnoses(spark, raw_dir), *discover_transfers(spark, raw_dir)]
        if not paths and exists(spark, f"{raw_dir}/reports.csv"):
            paths = [f"{raw_dir}/reports.csv"]
        elif not paths and is_folder(spark, f"{raw_dir}/reports"):
            paths = [f"{raw_dir}/reports"]
        if not paths:
            raise FileNotFoundError(f"no reports under {raw_dir}")
    for p in paths:
        if not exists(spark, p):
            raise FileNotFoundError(f"no such input: {p}")
    if len(paths) == 1 and is_folder(spark, paths[0]):
        return load_texts(spark, paths[0])
    diagnoses = [p for p in paths if looks_like_diagnoses(spark, p)]
    transfers = [p for p in paths if p not in diagnoses and looks_like_transfers(spark, p)]
    others = [p for p in paths if p not in diagnoses and p not in transfers]
    if others and (diagnoses or transfers):
        raise ValueError("diagnosis or transfer tables cannot be mixed with other sources")
    if others:
        frames = [reports_from_table(spark, p, id_column, text_column, section_columns).withColumn(R.ORDER, F.col(R.ORDER) + F.lit(k << 40)) for k, p in enumerate(others)]
        return R.with_row_order(R.union_all(frames).withColumnRenamed(R.ORDER, "_at"), "_at").drop("_at")
    latest, files = transfers_by_patient(spark, transfers), ", ".join(PurePosixPath(p).name for p in transfers)
    if diagnoses:
        joined = R.attach_transfer(diagnoses_many(spark, diagnoses), latest, files)
        if latest is not None and joined.filter(F.col("input_kind") == R.JOINED_KIND).isEmpty():
            LOGGER.warning("no transfer report of %s belongs to a patient of the diagnosis tables; are the ids alike?", files)
        return joined
    alone = R.with_row_order(latest, "patient_id")
    return alone.select(
        F.col("patient_id").alias("report_id"), F.col("verlegung_text").alias("report_text"), F.lit("").alias("diagnoseliste_text"),
        F.concat(F.lit("patient_"), F.col(R.ORDER).cast("string")).alias("source_row_id"), "patient_id", F.lit(0).alias("n_diagnosis_entries"),
        F.lit("patient_verlegung").alias("input_kind"), F.lit(files).alias("source_files"), "verlegung_text", "verlegung_berdat", "verlegung_fallnr", "n_verlegung_rows", R.ORDER,
    )


def load_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """A result CSV as strings; None if it is not there."""
    return spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(str(path)) if exists(spark, path) else None


def load_jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """One JSON object for each line, blank lines left out; None if the file is not there."""
    if not exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(str(path))

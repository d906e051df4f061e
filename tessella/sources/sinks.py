"""Sinks: CSV and JSON lines by Spark, review sheets, SQLite log, failures, versions of results."""

from __future__ import annotations

import csv
import io
import re
import sqlite3
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path
from urllib.parse import urlparse
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.evaluate import REVIEW_COLUMNS


def write_csv(df: DataFrame, path: str, names: Sequence[str]) -> None:
    """The named columns as CSV with a header; other columns are left out, earlier files replaced."""
    cells = [F.to_json(c) if df.schema[c].dataType.typeName() in ("array", "struct", "map") else F.when(F.col(c), "True").otherwise("False") if df.schema[c].dataType.typeName() == "boolean" else F.col(c) for c in names]
    df.select(*[c.alias(n) for c, n in zip([F.col(n) if isinstance(c, str) else c for c, n in zip(cells, names)], names)]).write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def safe_name(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9._-]+", "_", name).strip("_")[:80] or "record"


def write_failures(asked: DataFrame, path: str) -> None:
    """Calls that failed, as JSON lines: what was asked, the last raw answer and the error, under a file-safe name.

    ``asked`` has a row for each call: see ``pipeline.asked_rows``.
    """
    safe = lambda c: F.substring(F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_"), 1, 80)
    failed = asked.filter("failed").withColumn("name", F.concat_ws("_", safe("stage_name"), safe("record_id"), safe("report_name")))
    failed.select("name", "stage_name", "record_id", "report_name", "system_prompt", "user_prompt", "raw_output", "error_message").write.mode("overwrite").json(path)


def log_rows(df: DataFrame, path: str, id_column: str) -> int:
    """Append (record_id, payload) to the SQLite table ``extraction_rows``, row by row through one iterator."""
    rows = df.select(F.col(id_column).cast("string").alias("record_id"), F.to_json(F.struct(*df.columns)).alias("payload"))
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    n = 0
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE IF NOT EXISTS extraction_rows (id INTEGER PRIMARY KEY AUTOINCREMENT, record_id TEXT NOT NULL, payload TEXT NOT NULL, created_at TEXT NOT NULL DEFAULT (datetime('now')))")
        db.execute("CREATE INDEX IF NOT EXISTS extraction_rows_record ON extraction_rows (record_id)")
        for row in rows.toLocalIterator():
            db.execute("INSERT INTO extraction_rows (record_id, payload) VALUES (?, ?)", (row["record_id"] or "", row["payload"]))
            n += 1
    return n


# --- review sheets: bounded by the number of rows a person reads -----------------------------------
def review_csv(df: DataFrame, path: str) -> None:
    """Semicolons, a byte order mark, the review columns: one file for a spreadsheet program."""
    out = io.StringIO()
    writer = csv.writer(out, delimiter=";", lineterminator="\r\n")
    writer.writerow(REVIEW_COLUMNS)
    writer.writerows([r[c] or "" for c in REVIEW_COLUMNS] for r in df.select(*REVIEW_COLUMNS).toLocalIterator())
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_bytes(b"\xef\xbb\xbf" + out.getvalue().encode())


_WIDTHS = {"patient_id": 14, "status": 12, "evidence_quotes": 40, "reasoning": 40, "reoperation_context": 40, "rethoracotomy_context": 40, "notes": 30}


def _column(k: int) -> str:
    name = ""
    k += 1
    while k:
        k, r = divmod(k - 1, 26)
        name = chr(65 + r) + name
    return name


def review_workbook(df: DataFrame, path: str) -> None:
    """The same sheet as a workbook: bold header, wrapped cells, widths, frozen header, filter."""
    rows = [list(REVIEW_COLUMNS), *[[str(r[c] or "") for c in REVIEW_COLUMNS] for r in df.select(*REVIEW_COLUMNS).toLocalIterator()]]
    clean = lambda s: escape(re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", s))
    cell = lambda i, k, s: f'<c r="{_column(k)}{i}" t="inlineStr" s="{1 if i == 1 else 2}"><is><t xml:space="preserve">{clean(s)}</t></is></c>'
    body = "".join(f'<row r="{i}">{"".join(cell(i, k, s) for k, s in enumerate(row))}</row>' for i, row in enumerate(rows, 1))
    widths = "".join(f'<col min="{k}" max="{k}" width="{_WIDTHS.get(c, 18)}" customWidth="1"/>' for k, c in enumerate(REVIEW_COLUMNS, 1))
    area = f"A1:{_column(len(REVIEW_COLUMNS) - 1)}{len(rows)}"
    main, doc = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package, kind = "http://schemas.openxmlformats.org/package/2006", "application/vnd.openxmlformats-officedocument.spreadsheetml"
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{doc}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{doc}"><sheets><sheet name="review" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{doc}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{doc}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf/><xf fontId="1" applyFont="1"/><xf applyAlignment="1"><alignment vertical="top" wrapText="1"/></xf></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><cols>{widths}</cols><sheetData>{body}</sheetData><autoFilter ref="{area}"/></worksheet>',
    }
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, head + text)


# --- versions of results -------------------------------------------------------------------------
def local_path(uri: str) -> str:
    found = urlparse(uri)
    return found.path if found.scheme == "file" else uri


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def current_version(spark: SparkSession, output: str) -> str | None:
    """Folder of the last complete results, or None."""
    fs, p = _fs(spark, f"{output}/current.txt")
    return spark.read.text(f"{output}/current.txt").first()["value"] if fs.exists(p) else None


def next_version(output: str, before: str | None) -> str:
    n = int(before.rsplit("-", 2)[-2]) + 1 if before else 0
    return f"{output}/results-{n:05d}-{uuid.uuid4().hex[:8]}"


def publish(output: str, version: str) -> None:
    """Name ``version`` the current results, by a rename that replaces the earlier name in one step.

    Readers see the earlier name or the new one; where a file system cannot replace atomically (an
    object store) its own rename decides.
    """
    spark = SparkSession.getActiveSession()
    fs, draft = _fs(spark, f"{output}/.current-{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{output}/current.txt")
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(draft).toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(draft), fs.makeQualified(target), how
    )

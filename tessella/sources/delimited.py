"""Delimited files of any size, cells with line ends included, read by many tasks.

A file is read as lines, block by block. Whether a line begins inside a quoted cell depends on all that
stands before it, so every block first tells where a reader comes out that enters it outside quotes, and one that
enters it inside (``block_states``). These maps are put together block after block, a row for each on
the driver, and every block knows how it begins. Then each is parsed by itself: the lines before its first record belong
to the record that an earlier block leaves open, and are sent there (``parsed_blocks``); such a record is
put together from its parts, however many blocks it covers.

Rules are those of Python's ``csv`` reader: quotes count only where a cell begins with one, and two of them within it
are one. Lines end at \\n, \\r\\n and \\r. Of a cell that never closes, the file's last line end is not seen.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.staging import fixed

_CLOSES = re.compile(r'[^"]*+(?:""[^"]*+)*+"')
_LONE = re.compile(r"(?<=\r)(?!\n|$)")
ROWS = 2000  # of an Arrow batch
#: line ends as bytes, and the names Python knows the encodings of a file without its mark by
_ENDS = {"utf-16-le": b"\n\0", "utf-16-be": b"\0\n"}
# What windows-1252 has in the places 80 to 9F, but for those it leaves undefined.
CP1252 = dict(zip(
    (0x80, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x8B, 0x8C, 0x8E, 0x91, 0x92, 0x93, 0x94, 0x95, 0x96, 0x97, 0x98, 0x99, 0x9A, 0x9B, 0x9C, 0x9E, 0x9F),
    "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ",
))


def from_latin1(c: Column) -> Column:
    """Text that was read as Latin-1, in windows-1252."""
    return F.translate(c, "".join(map(chr, CP1252)), "".join(CP1252.values()))


def pieces(line: str) -> list[str]:
    """A line cut behind each \\r that ends one by itself."""
    return _LONE.split(line) if "\r" in line else [line]


def leaves_open(line: str, sep: str, inside: bool) -> bool:
    """Whether a reader that comes to ``line`` outside or inside of quotes leaves it inside."""
    if '"' not in line:
        return inside
    for part in pieces(line):
        at = 0
        while at <= len(part):
            if not inside and part[at : at + 1] != '"':
                at = part.find(sep, at) + 1
            elif m := _CLOSES.match(part, at + (not inside)):
                inside = False
                at = part.find(sep, m.end()) + 1
            else:
                inside = True
                break
            if not at:
                break
    return inside


def well_formed(sep: str) -> str:
    """A pattern of lines that are whole rows: cells are quoted as a whole or hold no quote, and no \\r is within."""
    s = re.escape(sep)
    return rf'^(?:(?:"[^"\r]*+(?:""[^"\r]*+)*+"|[^"\r{s}]*+){s})*+(?:"[^"\r]*+(?:""[^"\r]*+)*+"|[^"\r{s}]*+)\r?$'


def raw_lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """``block, line``: the bytes between line ends, and where the file's block begins that they are of."""
    reader = spark.read.option("lineSep", "\n")
    if encoding in _ENDS:
        reader = reader.option("encoding", encoding.upper().replace("-LE", "LE").replace("-BE", "BE"))
    return reader.text(str(path)).select(F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))


def _blocks(batches: Iterator[pa.RecordBatch], encoding: str) -> Iterator[tuple[int, Iterator[tuple[str | None, int]]]]:
    """Each block with its lines, decoded (None: they can't be), and the bytes of each."""
    ahead: list = [None]
    rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))

    def lines(block: int) -> Iterator[tuple[str | None, int]]:
        glued, first = b"", block == 0
        while ahead[0] is not None and ahead[0][0] == block:
            line = glued + ahead[0][1]
            ahead[0] = next(rows, None)
            if encoding in _ENDS and len(line) % 2 and ahead[0] is not None and ahead[0][0] == block:
                glued = line + _ENDS[encoding]  # two characters that together look like a line end
                continue
            glued, size = b"", len(line)
            try:
                text = line.decode(encoding)
            except UnicodeError:
                text = None
            yield (text.removeprefix("﻿") if first and text else text), size
            first = False

    ahead[0] = next(rows, None)
    while ahead[0] is not None:
        block = ahead[0][0]
        held = lines(block)
        yield block, held
        for _ in held:  # what the caller did not take
            pass


@dataclass
class Layout:
    """Of a file: whether all of it decodes, the blocks that begin inside a cell and where that began, and the last block."""

    decodes: bool
    origin: dict[int, int]
    last: int


def block_states(spark: SparkSession, path: str, encoding: str, sep: str) -> Layout | None:
    """The layout of a file, by one pass; None if a block begins within a character (UTF-16 alone)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, lines in _blocks(batches, encoding):
            outside, inside, fine, odd, closes = False, True, True, 0, False
            for line, size in lines:
                odd ^= size & 1
                if line is None:
                    fine = False
                    continue
                outside, inside = leaves_open(line, sep, outside), leaves_open(line, sep, inside)
                closes |= not inside
            values = (block, outside, inside, fine, bool(odd), closes)
            yield pa.RecordBatch.from_pylist([dict(zip(("block", "outside", "inside", "fine", "odd", "closes"), values))])

    found = raw_lines(spark, path, encoding).mapInArrow(run, "block long, outside boolean, inside boolean, fine boolean, odd boolean, closes boolean")
    blocks = sorted(map(tuple, found.collect()))  # a row for each block of the file
    origin: dict[int, int] = {}
    opened, at = False, 0
    for block, outside, inside, _, _, closes in blocks:
        if opened:
            origin[block] = at
        after = inside if opened else outside
        if after and (not opened or closes):  # the record that is open behind this block began in it
            at = block
        opened = after
    if encoding in _ENDS and any(odd for *_, odd, _ in blocks):
        return None
    return Layout(all(b[3] for b in blocks), origin, blocks[-1][0] if blocks else 0)


def _cells(records: Iterable[str], sep: str, width: int) -> Iterator[list[str | None]]:
    """Rows of up to ``width`` cells, filled up; empty and longer ones go."""
    csv.field_size_limit(sys.maxsize)
    for row in csv.reader((part for record in records for part in pieces(record)), delimiter=sep):
        if row and len(row) <= width:
            yield row + [None] * (width - len(row))


def parsed_blocks(spark: SparkSession, path: str, encoding: str, sep: str, width: int, layout: Layout) -> DataFrame:
    """``block, at, c0, c1, ...``: all rows but the header in the order of ``block, at``, written once."""
    names = [f"c{k}" for k in range(width)]

    def records(block: int, lines: Iterator[tuple[str | None, int]], loose: list[tuple[int, str]]) -> Iterator[str]:
        if block in layout.origin:
            head, inside = [], True
            for line, _ in lines:
                head.append(line)
                if not (inside := leaves_open(line, sep, True)):
                    break
            loose.append((layout.origin[block], "\n".join(head)))
        held: list[str] = []
        inside, first = False, block == 0
        for line, _ in lines:
            held.append(line)
            inside = leaves_open(line, sep, inside)
            if not inside:
                if not first:
                    yield "\n".join(held) + "\n"
                held, first = [], False
        if held and block == layout.last and not first:
            yield "\n".join(held)  # a cell that never closes
        elif held:
            loose.append((block, "\n".join(held)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(block: int, at: int, rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * width
            return pa.RecordBatch.from_arrays(
                [pa.array([block] * len(rows), pa.int64()), pa.array(range(at, at + len(rows)), pa.int64()), pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.string()), *[pa.array(c, pa.string()) for c in columns]],
                names=["block", "at", "part", "fragment", *names],
            )

        for block, lines in _blocks(batches, encoding):
            loose: list[tuple[int, str]] = []
            at, rows = 0, []
            for row in _cells(records(block, lines, loose), sep, width):
                rows.append(row)
                if len(rows) == ROWS:
                    yield batch(block, at, rows)
                    at, rows = at + len(rows), []
            yield batch(block, at, rows)
            at += len(rows)
            for origin, text in loose:
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (origin, at if origin == block else -1, block, text)] + [pa.nulls(1, pa.string())] * width, names=["block", "at", "part", "fragment", *names])

    typed = ", ".join(f"{c} string" for c in names)
    rows = fixed(raw_lines(spark, path, encoding).mapInArrow(run, f"block long, at long, part long, fragment string, {typed}"))
    whole = rows.filter("fragment is null").drop("part", "fragment")
    if not layout.origin:
        return whole

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = pdf.sort_values("part")
        return pd.DataFrame([(parts["block"].iat[0], parts["at"].max(), *row) for row in _cells(["\n".join(parts["fragment"])], sep, width)], columns=["block", "at", *names])

    return whole.unionByName(fixed(rows.filter("fragment is not null").groupBy("block").applyInPandas(join, f"block long, at long, {typed}")))


def in_order(rows: DataFrame, into: str) -> DataFrame:
    """``block, at`` (dense from 0 within a block) become one dense number, by a count for each block."""
    at, starts = 0, []
    for block, count in sorted(map(tuple, rows.groupBy("block").count().collect())):  # a row for each block of the file
        starts.append((block, at))
        at += count
    known = F.broadcast(rows.sparkSession.createDataFrame(starts, "block long, _start long"))
    return rows.join(known, "block").withColumn(into, F.col("_start") + F.col("at")).drop("block", "at", "_start")

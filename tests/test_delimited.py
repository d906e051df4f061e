"""Delimited files by blocks against Python's csv reader on the whole text."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.operators.relational import ORDER
from tessella.sources import delimited as D
from tessella.sources import tables


def plain_rows(text, sep, width):
    found = csv.reader(io.StringIO(text, newline=""), delimiter=sep)
    next(found)
    return [tuple(row + [""] * (width - len(row))) for row in found if row and len(row) <= width]


@settings(max_examples=500, deadline=None)
@given(st.text('a,"\n\r', max_size=30))
def test_lines_that_leave_a_cell_open(text):
    def ends_inside(part):  # a reader inside quotes takes the next line into the same row
        rows = list(csv.reader(io.StringIO(part + "\nz", newline=""), delimiter=","))
        return rows[-1] != ["z"]

    state = False
    lines = text.split("\n")
    for k, line in enumerate(lines):
        state = D.leaves_open(line, ",", state)
        assert state == ends_inside("\n".join(lines[: k + 1]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.text('ab";\r', max_size=5), min_size=1, max_size=4), min_size=1, max_size=4))
def test_well_formed_lines_are_rows(rows):
    import re

    out = io.StringIO()
    csv.writer(out, delimiter=";", lineterminator="\n").writerows(rows)
    for line in [*out.getvalue().split("\n"), *(";".join(r) for r in rows)]:
        if re.match(D.well_formed(";"), line):
            assert not D.leaves_open(line, ";", False) and "\r" not in line[:-1] and len(list(csv.reader([line], delimiter=";"))) <= 1


def sample(seed, sep, rows=150, letters="aü–b ਊ"):
    """A file with line ends, quotes and separators in cells, short, long and empty rows, and stray quotes."""
    rnd = random.Random(seed)

    def cell():
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 8)))
        kind = rnd.random()
        if kind < 0.25:
            inner = text + rnd.choice(["\n", "\r\n", sep, '"', "\n\n", '",\n"', "\r"]) * rnd.randint(1, 3) + text
            return '"' + inner.replace('"', '""') + '"'
        return text + '"' + text if kind < 0.3 and text else text

    lines = [sep.join(["id", "Text", "x"])]
    for k in range(rows):
        lines.append(sep.join([f"r{k}", *(cell() for _ in range(rnd.choice([0, 1, 2, 2, 2, 2, 3])))]))
        if rnd.random() < 0.05:
            lines.append("")
    return rnd.choice(["\n", "\r\n"]).join(lines) + rnd.choice(["", "\n"])


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("encoding,letters", [("utf-8", "aü–b 😀"), ("utf-8-sig", "aü"), ("utf-16", "aü–b😀"), ("utf-16-le", "aü"), ("cp1252", "aü–€b")])
@pytest.mark.parametrize("sep", [",", ";"])
def test_blocks_equal_the_whole(spark, tmp_path, small_blocks, monkeypatch, encoding, letters, sep):
    monkeypatch.setattr(tables, "_HEAD", 2000)  # so that the file goes beyond it
    text = sample(len(encoding) + ord(sep), sep, letters=letters)
    mark = "﻿" if encoding == "utf-16-le" else ""
    (tmp_path / "t.csv").write_bytes((mark + text).encode(encoding))
    df = tables.read_tabular(spark, str(tmp_path / "t.csv"), sep)
    want = plain_rows(text, sep, 3)
    got = df.orderBy(ORDER).collect()
    assert [tuple(r)[:3] for r in got] == want and [r[ORDER] for r in got] == list(range(len(want))) and len(want) > 50


def test_a_cell_over_many_blocks_and_one_that_never_closes(spark, tmp_path, small_blocks):
    cell = "\n".join(f"line {k} of a cell" for k in range(100))
    for tail, last in (("4;end\n", ("4", "end")), ('4;"open\n' + "more\n" * 100, ("4", "open\n" + "more\n" * 99 + "more"))):
        (tmp_path / "t.csv").write_text(f'id;text\n1;a\n2;"{cell}"\n3;b\n{tail}')
        layout = D.block_states(spark, str(tmp_path / "t.csv"), "utf-8", ";")
        assert len(layout.origin) > 5
        got = tables.read_tabular(spark, str(tmp_path / "t.csv")).orderBy(ORDER).collect()
        assert [tuple(r)[:2] for r in got] == [("1", "a"), ("2", cell), ("3", "b"), last]


def test_characters_that_look_like_a_line_end(spark, tmp_path, small_blocks, monkeypatch):
    """U+0Axx before U+yy00 has the bytes of a UTF-16 line end, a byte off."""
    monkeypatch.setattr(tables, "_HEAD", 400)
    text = "id;text\n" + "".join(f"{k};ਕ　ਊĀ{'x' * (k % 7)}\n" for k in range(60))
    for encoding in ("utf-16-le", "utf-16-be"):
        (tmp_path / "t.csv").write_bytes(("﻿" + text).encode(encoding))
        got = tables.read_tabular(spark, str(tmp_path / "t.csv")).orderBy(ORDER).collect()
        assert [tuple(r)[:2] for r in got] == plain_rows(text, ";", 2)


def test_lines_that_are_rows_stay_in_the_jvm(spark, tmp_path, small_blocks, monkeypatch):
    monkeypatch.setattr(tables, "_HEAD", 300)
    monkeypatch.setattr(D, "block_states", None)  # not called
    for encoding, text in (("utf-8", "ü–😀"), ("cp1252", "ü–€Ž"), ("latin-1", "ü\x81\x9d")):
        body = "id,text\n" + "".join(f'{k},"{text}, and ""more"""\n' for k in range(80))
        (tmp_path / "t.csv").write_bytes(body.encode(encoding))
        got = tables.read_tabular(spark, str(tmp_path / "t.csv")).orderBy(ORDER).collect()
        assert [tuple(r)[:2] for r in got] == plain_rows(body, ",", 2), encoding

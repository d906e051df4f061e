"""Reports as a Python data source: ``spark.read.format("reports").load(path)``.

Delimited files, workbooks and folders of texts in one form: strings, with ``_file`` and ``_order`` (the row's place in its
file) behind the columns of all files by name. A partition is a file, a sheet, or a share of a folder's texts. Filters on columns
are pushed into the scan, where they stop rows before these leave Python, and filters on ``_file`` leave files
unread; a schema that is given names the columns that are built at all.

Files are opened by ``pyarrow.fs`` where the tasks run. Each is read by one task; ``tables.read_tabular`` reads a large
file by many, and in any store that Spark knows.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import urlparse

from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessella.operators.ledger import store_of
from tessella.sources import tables

FILE, PLACE = "_file", "_order"
TEXTS = 200  # of a folder, in a partition
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def register(spark: SparkSession) -> None:
    """Make the format known and let filters be pushed."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(ReportsSource)


@dataclass
class Share(InputPartition):
    """What a task reads: files of one kind, or one sheet of a workbook."""

    kind: str
    paths: list[str]
    sheet: int = 0
    first: int = 0  # the place of the first text in its folder


def _test(f: Filter) -> Callable[[str | None], bool] | None:
    """A filter on one column as a test of its cell; None for what is left to Spark."""
    if isinstance(f, Not):
        inner = _test(f.child)
        return (lambda x: x is not None and not inner(x)) if inner is not None and not isinstance(f.child, (IsNull, EqualNullSafe)) else None
    compare = {
        EqualTo: lambda x, v: x == v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v,
        StringContains: lambda x, v: v in x, StringStartsWith: lambda x, v: x.startswith(v), StringEndsWith: lambda x, v: x.endswith(v), In: lambda x, v: x in v,
    }
    if isinstance(f, IsNotNull):
        return lambda x: x is not None
    if type(f) in compare and isinstance(f.value, (str, tuple, list)):
        if isinstance(f.value, str) and type(f) in (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual) and not f.value.isascii():
            return None  # Spark orders by bytes
        return lambda x, by=compare[type(f)], v=f.value: x is not None and by(x, v)
    return None


def _column(f: Filter) -> str | None:
    names = (f.child if isinstance(f, Not) else f).attribute
    return names[0] if len(names) == 1 else None


class ReportsSource(DataSource):
    """Options: ``path`` (a file, a folder, or several joined by commas), ``sep``, ``sheets`` (``first`` or ``all``)."""

    @classmethod
    def name(cls) -> str:
        return "reports"

    def _shares(self) -> list[Share]:
        paths = [p for p in self.options.get("path", "").split(",") if p]
        if not paths:
            raise ValueError("no path of reports")
        out = []
        for path in paths:
            store, place = store_of(path)
            scheme = path[: len(path) - len(urlparse(path).path)] if urlparse(path).scheme else ""
            info = store.get_file_info(place)
            if info.type == pafs.FileType.NotFound:
                raise FileNotFoundError(f"no such input: {path}")
            if info.type == pafs.FileType.File:
                out += _file_shares(store, f"{scheme}{place}", place, self.options.get("sheets", "first"))
                continue
            inside = sorted((x for x in store.get_file_info(pafs.FileSelector(place)) if x.type == pafs.FileType.File), key=lambda x: x.path)
            texts = [f"{scheme}{x.path}" for x in inside if x.extension == "txt"]
            out += [Share("texts", texts[k : k + TEXTS], first=k) for k in range(0, len(texts), TEXTS)]
            if not texts:
                for x in inside:
                    if f".{x.extension.lower()}" in tables.TABULAR:
                        out += _file_shares(store, f"{scheme}{x.path}", x.path, self.options.get("sheets", "first"))
        return out

    def schema(self) -> StructType:
        names: dict[str, None] = {}
        for share in self._shares():
            names |= dict.fromkeys(_header(share, self.options.get("sep")))
        return StructType([*[StructField(n, StringType()) for n in names], StructField(FILE, StringType()), StructField(PLACE, LongType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return ReportsReader(self._shares(), schema, self.options.get("sep"))


def _file_shares(store: pafs.FileSystem, path: str, place: str, sheets: str) -> list[Share]:
    if not tables.is_excel(path):
        return [Share("delimited", [path])]
    count = len(tables.sheet_names(store.open_input_file(place).read())) if sheets == "all" else 1
    return [Share("sheet", [path], sheet=k) for k in range(count)]


def _bytes(path: str) -> bytes:
    store, place = store_of(path)
    with store.open_input_file(place) as file:
        return file.read()


def _rows(share: Share, sep: str | None) -> Iterator[tuple[str, int, list[str], Sequence[str | None]]]:
    """File, place, header and cells of each row."""
    if share.kind == "texts":
        for k, path in enumerate(share.paths):
            yield path, share.first + k, ["report_id", "report_text"], [path.rpartition("/")[2].removesuffix(".txt"), _bytes(path).decode("utf-8", "replace")]
        return
    path, = share.paths
    if share.kind == "sheet":
        found = tables.sheet_rows(_bytes(path), share.sheet)
        header = tables._unique(next(found, []))
        for k, row in enumerate(row for row in found if any(row)):
            yield path, k, header, (row + [""] * len(header))[: len(header)]
        return
    csv.field_size_limit(sys.maxsize)
    data = _bytes(path)
    for encoding, mark, names in tables.dialects(data, sep):
        try:
            text = data.decode(encoding)
            break
        except UnicodeError:
            continue
    header = tables._unique(names)
    found = csv.reader(io.StringIO(text, newline=""), delimiter=mark)
    next(found, None)
    for k, row in enumerate(row for row in found if row and len(row) <= len(header)):
        cells = [*row, *[""] * (len(header) - len(row))]
        yield path, k, header, ["" if c in tables.MISSING else c for c in cells]


def _header(share: Share, sep: str | None) -> list[str]:
    if share.kind == "texts":
        return ["report_id", "report_text"]
    path, = share.paths
    if share.kind == "sheet":
        return tables._unique(next(tables.sheet_rows(_bytes(path), share.sheet), []))
    store, place = store_of(path)
    with store.open_input_file(place) as file:
        return tables._unique(tables.sniff(file.read(tables._HEAD), sep)[2])


@dataclass
class ReportsReader(DataSourceReader):
    shares: list[Share]
    wanted: StructType
    sep: str | None
    tests: list[tuple[str, Callable[[str | None], bool]]] = field(default_factory=list)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        strings = {f.name for f in self.wanted.fields if isinstance(f.dataType, StringType)}
        for f in filters:
            name, test = _column(f), _test(f)
            if name in strings and test is not None:
                self.tests.append((name, test))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        kept = [s for s in self.shares if s.kind == "texts" or all(test(s.paths[0]) for name, test in self.tests if name == FILE)]
        return kept or [Share("none", [])]

    def read(self, share: Share) -> Iterator[tuple]:
        names = [f.name for f in self.wanted.fields]
        if share.kind == "none":
            return
        at: dict[str, int] = {}
        header: list[str] | None = None
        for path, place, now, cells in _rows(share, self.sep):
            if now is not header:
                header, at = now, {n: k for k, n in enumerate(now)}
            cell = lambda n: path if n == FILE else cells[at[n]] if n in at else None  # noqa: B023, E731
            if all(test(cell(n)) for n, test in self.tests):
                yield tuple(place if n == PLACE else cell(n) for n in names)

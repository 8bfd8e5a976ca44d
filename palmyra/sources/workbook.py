"""Spreadsheet workbooks (.xlsx) as a Spark data source, format ``workbook``.

    spark.dataSource.register(WorkbookSource)
    df.write.format("workbook").mode("append").save(folder)
    spark.read.format("workbook").schema(df.schema).load(folder)

Every task writes its rows as one workbook of its own: a part, with as many sheets as its
rows need. Parts are written under a hidden name; when all tasks are done, the driver
gives them their names and then writes ``_parts.json``, which lists them. Readers take only
what the list names, so a failed task or a lost executor leaves nothing that counts.

Text is kept as inline strings (characters that XML cannot hold are escaped as
``_xHHHH_``), numbers as numbers, dates and times as ISO text; nulls have no cell.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, InputPartition,
                                    WriterCommitMessage)

#: Rows of a sheet, its header among them; fixed by the format.
SHEET_ROWS = 1_048_576
LIST = "_parts.json"

# Fixed values of the format.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATIONS = "http://schemas.openxmlformats.org/package/2006/relationships"
_DOCUMENT = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
_SHEET_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_UNFIT = re.compile(r"[\x00-\x08\x0B\x0C\x0D\x0E-\x1F￾￿]|_(?=x[0-9A-Fa-f]{4}_)")
_ESCAPED = re.compile(r"_x([0-9A-Fa-f]{4})_")


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _cell(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) and value == value and abs(value) != float("inf"):
        return f"<c><v>{value!r}</v></c>"
    text = value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else str(value)
    text = _UNFIT.sub(lambda m: f"_x{ord(m.group()):04X}_", text)
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def write_workbook(target, names: list[str], rows: Iterator, sheet_rows: int = SHEET_ROWS) -> int:
    """Write rows to an open binary file, a sheet at a time; return how many."""
    n, sheets, more = 0, 0, True
    rows = iter(rows)
    head = f"<row>{''.join(map(_cell, names))}</row>"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as book:
        while more:
            sheets, more = sheets + 1, False
            with book.open(f"xl/worksheets/sheet{sheets}.xml", "w", force_zip64=True) as sheet:
                sheet.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>{head}'.encode())
                for i, row in enumerate(rows, 2):
                    sheet.write(f"<row>{''.join(map(_cell, row))}</row>".encode())
                    n += 1
                    if i == sheet_rows:
                        more = True
                        break
                sheet.write(b"</sheetData></worksheet>")
        number = range(1, sheets + 1)
        book.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_TYPES}">'
                      '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.'
                      'relationships+xml"/><Override PartName="/xl/workbook.xml" '
                      f'ContentType="{_SHEET_TYPE}.sheet.main+xml"/>' + "".join(
                          f'<Override PartName="/xl/worksheets/sheet{i}.xml" '
                          f'ContentType="{_SHEET_TYPE}.worksheet+xml"/>' for i in number) + "</Types>")
        book.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{_RELATIONS}"><Relationship Id="rId1" '
                      f'Type="{_DOCUMENT}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_DOCUMENT}"><sheets>'
                      + "".join(f'<sheet name="Sheet{i}" sheetId="{i}" r:id="rId{i}"/>' for i in number)
                      + "</sheets></workbook>")
        book.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_RELATIONS}">' + "".join(
            f'<Relationship Id="rId{i}" Type="{_DOCUMENT}/worksheet" Target="worksheets/sheet{i}.xml"/>'
            for i in number) + "</Relationships>")
    return n


def _value(cell, data_type: T.DataType):
    kind = cell.get("t")
    if kind == "inlineStr":
        text = "".join(t.text or "" for t in cell.iter(f"{{{_MAIN}}}t"))
        text = _ESCAPED.sub(lambda m: chr(int(m.group(1), 16)), text)
    else:
        found = cell.find(f"{{{_MAIN}}}v")
        if found is None:
            return None
        text = found.text or ""
    if isinstance(data_type, T.BooleanType):
        return text == "1"
    if isinstance(data_type, T.IntegralType):
        return int(text)
    if isinstance(data_type, T.FractionalType):
        return float(text)
    if isinstance(data_type, T.DateType):
        return dt.date.fromisoformat(text)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return dt.datetime.fromisoformat(text)
    return text


def read_workbook(source, schema: T.StructType) -> Iterator[tuple]:
    """Rows of all sheets, streamed; columns go by the header's names."""
    with zipfile.ZipFile(source) as book:
        sheets = sorted((n for n in book.namelist() if n.startswith("xl/worksheets/sheet")),
                        key=lambda n: int(re.sub(r"\D", "", n)))
        for name in sheets:
            places = None
            with book.open(name) as sheet:
                for _, element in ElementTree.iterparse(sheet):
                    if element.tag != f"{{{_MAIN}}}row":
                        continue
                    cells = list(element)
                    if places is None:
                        header = [_value(c, T.StringType()) for c in cells]
                        places = [header.index(f.name) for f in schema.fields]
                    else:
                        yield tuple(_value(cells[p], f.dataType) for p, f in zip(places, schema.fields))
                    element.clear()


@dataclass
class Part(WriterCommitMessage):
    name: str
    rows: int


class WorkbookWriter(DataSourceWriter):
    def __init__(self, folder: str, schema: T.StructType, sheet_rows: int):
        self.folder, self.names, self.sheet_rows = folder.rstrip("/"), schema.fieldNames(), sheet_rows

    def write(self, iterator) -> Part:
        from pyspark import TaskContext
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}.xlsx"
        store, path = _store(self.folder)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/_{name}.tmp") as out:
            n = write_workbook(_Unseekable(out), self.names, iterator, self.sheet_rows)
        return Part(name, n)

    def commit(self, messages) -> None:
        store, path = _store(self.folder)
        parts = [m for m in messages if m is not None]
        for p in parts:
            store.move(f"{path}/_{p.name}.tmp", f"{path}/{p.name}")
        listed = _listed(store, path) + [{"name": p.name, "rows": p.rows} for p in parts]
        draft = f"{path}/_{uuid.uuid4().hex}.tmp"
        with store.open_output_stream(draft) as out:
            out.write(json.dumps(listed).encode())
        store.move(draft, f"{path}/{LIST}")

    def abort(self, messages) -> None:
        store, path = _store(self.folder)
        for p in messages:
            if p is not None and store.get_file_info(f"{path}/_{p.name}.tmp").is_file:
                store.delete_file(f"{path}/_{p.name}.tmp")


class _Unseekable:
    """A file that is only written forward, as stores want it."""

    def __init__(self, out):
        self.out, self.at = out, 0

    def write(self, data) -> int:
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def tell(self) -> int:
        return self.at

    def flush(self) -> None:
        pass

    def seekable(self) -> bool:
        return False


def _listed(store: pafs.FileSystem, path: str) -> list[dict]:
    if not store.get_file_info(f"{path}/{LIST}").is_file:
        return []
    with store.open_input_stream(f"{path}/{LIST}") as src:
        return json.loads(src.read())


@dataclass
class PartName(InputPartition):
    name: str


class WorkbookReader(DataSourceReader):
    def __init__(self, folder: str, schema: T.StructType):
        self.folder, self.schema = folder.rstrip("/"), schema

    def partitions(self) -> list[PartName]:
        return [PartName(p["name"]) for p in sorted(_listed(*_store(self.folder)), key=lambda p: p["name"])] \
            or [PartName("")]

    def read(self, partition: PartName) -> Iterator[tuple]:
        if partition.name:
            store, path = _store(self.folder)
            with store.open_input_file(f"{path}/{partition.name}") as src:
                yield from read_workbook(src, self.schema)


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self):
        raise ValueError("a workbook is read with a schema: its cells carry no Spark types")

    def reader(self, schema) -> WorkbookReader:
        return WorkbookReader(self.options["path"], schema)

    def writer(self, schema, overwrite) -> WorkbookWriter:
        if overwrite:
            raise ValueError("workbooks are appended to a folder; take a new folder to replace them")
        return WorkbookWriter(self.options["path"], schema,
                              int(self.options.get("sheetrows", SHEET_ROWS)))


def export_workbook(df: DataFrame, path: str, **options) -> None:
    """Write ``df`` as workbook parts, one a task, in parallel."""
    spark = df.sparkSession
    spark.dataSource.register(WorkbookSource)
    df.write.format("workbook").mode("append").options(**options).save(path)


def load_workbook(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    spark.dataSource.register(WorkbookSource)
    return spark.read.format("workbook").schema(schema).load(path)

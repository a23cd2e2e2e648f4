"""Sources: files of a kit as tables. Binary formats are read inside tasks, one file at a time."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lines as L

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
BLOCKS = "path string, sheet int, ord int, kind string, text string, cells array<array<string>>"
FINDING_SCHEMA = "level string, kind string, count int, note string, examples array<string>"
BROKEN = "broken"
JOB_SCHEMA = "id string, path string, status string, created string, total int, done int, errors array<string>, cancel boolean"


def discover(spark: SparkSession, root: str, suffixes: tuple[str, ...]) -> DataFrame:
    """(path, length, modified) of files below root with a suffix, case ignored; file contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    return found.filter(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*[s.lower().lstrip(".") for s in suffixes]))


def page_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, page, body) of Markdown files cut at their page headings."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    return L.pages(whole, ["path"])


def _number(props: ElementTree.Element | None, name: str) -> int:
    """Value of a numeric property such as gridSpan, 0 if it is not there."""
    found = props.find(f"{W}{name}") if props is not None else None
    return int(found.get(f"{W}val", "1")) if found is not None else 0


def _cell_text(cell: ElementTree.Element) -> str:
    """Paragraphs of a cell as lines; a table inside the cell gives a line for each of its rows."""
    parts = []
    for element in cell:
        if element.tag == f"{W}p":
            parts.append("".join(t.text or "" for t in element.iter(f"{W}t")))
        elif element.tag == f"{W}tbl":
            parts += [" | ".join(row) for row in _rows_of(element)]
    return "\n".join(parts)


def _rows_of(table: ElementTree.Element) -> list[list[str]]:
    """The table's own rows on its grid: a cell's text stands in the first of the columns it spans, blanks in the others, in
    those left out before or after a row, and where a cell goes on from above."""
    grid = []
    for row in table.findall(f"{W}tr"):
        edge = row.find(f"{W}trPr")
        cells = [""] * _number(edge, "gridBefore")
        for cell in row.findall(f"{W}tc"):
            props = cell.find(f"{W}tcPr")
            merge = props.find(f"{W}vMerge") if props is not None else None
            goes_on = merge is not None and merge.get(f"{W}val", "continue") == "continue"
            cells.append("" if goes_on else _cell_text(cell))
            cells.extend([""] * (_number(props, "gridSpan") - 1))
        grid.append(cells + [""] * _number(edge, "gridAfter"))
    return grid


def docx_blocks(data: bytes) -> Iterator[tuple[int, int, str, str, list[list[str]]]]:
    """(sheet, ord, kind, text, cells) of a document; only explicit page breaks start a sheet."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{W}body")
    sheet, n = 1, 0
    for element in body if body is not None else ():
        if element.tag == f"{W}tbl":
            yield sheet, n, "table", "", _rows_of(element)
            n += 1
        elif element.tag == f"{W}p":
            if any(b.get(f"{W}type") == "page" for b in element.iter(f"{W}br")):
                sheet += 1
            style = element.find(f"{W}pPr/{W}pStyle")
            heading = style is not None and (style.get(f"{W}val") or "").lower().startswith("heading")
            text = "".join(t.text or "" for t in element.iter(f"{W}t")).strip()
            if text:
                yield sheet, n, "heading" if heading else "text", text, []
                n += 1


def docx_media(data: bytes) -> int:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return sum(n.startswith("word/media/") for n in z.namelist())


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of text documents; a file that can't be read gives one block of kind error."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, data in zip(frame["path"], frame["content"], strict=True):
                try:
                    rows += [(name, *block) for block in docx_blocks(data)]
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as e:
                    rows.append((name, 1, 0, "error", type(e).__name__, []))
            yield pd.DataFrame(rows, columns=["path", "sheet", "ord", "kind", "text", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, BLOCKS)


def bad_group_codes(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, line) of drawing exchange files where a line that must be a group code is no integer."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    numbered = text.select("path", F.posexplode(F.split(F.regexp_replace("text", "\r", ""), "\n")).alias("line_no", "line"))
    return numbered.filter((F.col("line_no") % 2 == 0) & ~F.trim("line").rlike("^-?[0-9]+$") & (F.trim("line") != ""))


# Entities of a drawing exchange file whose text is cut into parts, and the group codes of parts and end.
CUT_ENTITIES, PART_CODE, END_CODE = (b"ATTRIB", b"ATTDEF", b"TEXT", b"MTEXT"), b"3", b"1"


def joined_text_groups(data: bytes) -> tuple[bytes, int]:
    """A drawing exchange file whose cut texts are whole again, and how many were joined.

    A long text is cut at a number of bytes into groups of code 3 and a last one of code 1, in the middle of a letter too, so
    the parts are joined as bytes. Parts that no end follows stay as they are.
    """
    rows = data.splitlines(keepends=True)
    groups = [(rows[k], rows[k + 1]) for k in range(0, len(rows) - 1, 2)]
    codes = [code.strip() for code, _ in groups]
    inside, entity = [], b""
    for code, (_, value) in zip(codes, groups, strict=True):
        entity = value.strip() if code == b"0" else entity
        inside.append(entity in CUT_ENTITIES)
    out, joined, k = [], 0, 0
    while k < len(groups):
        end = k
        while end < len(groups) and codes[end] == PART_CODE and inside[end]:
            end += 1
        if end > k and end < len(groups) and codes[end] == END_CODE:
            out += [groups[end][0], *(value.rstrip(b"\r\n") for _, value in groups[k:end]), groups[end][1]]
            joined, k = joined + 1, end + 1
        else:
            out += groups[k]
            k += 1
    return b"".join([*out, *rows[2 * len(groups) :]]), joined


def joined_drawings(spark: SparkSession, path: str) -> DataFrame:
    """(path, content, joined) of drawing exchange files with their cut texts joined."""

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(p, *joined_text_groups(bytes(c))) for p, c in zip(frame["path"], frame["content"], strict=True)], columns=["path", "content", "joined"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(join, "path string, content binary, joined long")


def repaired_json(raw: str) -> str:
    """nan becomes null and a number loses its trailing full stop, outside of strings."""
    out = []
    for piece in re.split(r'("(?:[^"\\]|\\.)*")', raw):
        if not piece.startswith('"'):
            piece = re.sub(r"-?\bnan\b", "null", piece, flags=re.I)
            piece = re.sub(r"([0-9])\.(?=\s*[,\]}])", r"\1", piece)
        out.append(piece)
    return "".join(out)


def drawing_objects(spark: SparkSession, path: str) -> DataFrame:
    """(path, handle, owner, entity, layout, text, x, y) of JSON dumps of drawings, repaired first."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, value in zip(frame["path"], frame["value"], strict=True):
                for o in json.loads(repaired_json(value)).get("OBJECTS", []):
                    at = o.get("ins_pt") or [None, None]
                    rows.append((name, str(o.get("handle")), str(o.get("ownerhandle")), o.get("entity") or o.get("object"), o.get("layout_name"), o.get("text") or o.get("text_value"), at[0], at[1]))
            yield pd.DataFrame(rows, columns=["path", "handle", "owner", "entity", "layout", "text", "x", "y"])

    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return raw.mapInPandas(read, "path string, handle string, owner string, entity string, layout string, text string, x double, y double")


def layout_texts(objects: DataFrame) -> DataFrame:
    """Texts owned directly by a layout; definitions of attributes are none."""
    texts = objects.filter(F.col("entity").isin("TEXT", "MTEXT", "ATTRIB") & F.col("text").isNotNull())
    layouts = objects.filter("layout is not null").select("path", F.col("handle").alias("owner"), F.col("layout").alias("layout_name"))
    return texts.join(layouts, ["path", "owner"])


def sidecars(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON sidecars with a declared schema and the text of those that are broken in column broken; unknown fields are ignored."""
    reader = spark.read.schema(f"{schema}, {BROKEN} string").option("multiLine", "true").option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", BROKEN).json(path)


def jobs(lines: DataFrame, column: str = "value") -> DataFrame:
    """Job rows from JSON lines; bad lines are skipped."""
    return lines.select(F.from_json(column, JOB_SCHEMA, {"mode": "PERMISSIVE"}).alias("j")).filter("j.id is not null").select("j.*")


def read_pages_with(client: Callable[[str, bytes], str], pages: DataFrame) -> DataFrame:
    """(path, page, body, error) of page images read by an injected model client, with retries."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, page, content in zip(frame["path"], frame["page"], frame["content"], strict=True):
                error = None
                for _ in range(3):
                    try:
                        rows.append((path, page, client(path, bytes(content)), None))
                        break
                    except Exception as e:  # noqa: BLE001
                        error = str(e)
                else:
                    rows.append((path, page, None, error))
            yield pd.DataFrame(rows, columns=["path", "page", "body", "error"])

    return pages.select("path", "page", "content").mapInPandas(read, "path string, page int, body string, error string")

"""Spreadsheets and archives -> cells, decoded on executors.

A workbook is a ZIP of XML parts and cannot be split, so one task decodes
one file; everything after the decode (header detection, cleaning, melt) is
column expressions over the cell rows. Decoding streams the sheet XML with
``iterparse`` and emits cells in Arrow batches, so a large sheet never
becomes one in-memory matrix. Only the standard library is used.

Cell kinds: ``n`` number (text is the stored number), ``s`` text, ``d`` date
(text is ISO ``yyyy-MM-dd HH:mm:ss``, converted from the serial number when
the cell's number format is a date format), ``b`` boolean.
"""

from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.schemas import ARCHIVE_MEMBER_POLLUTANTS, CELLS

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Built-in number formats that display dates or times.
_DATE_FORMAT_IDS = set(range(14, 23)) | {45, 46, 47}
_EXCEL_EPOCH = dt.datetime(1899, 12, 30)
_BATCH = 50_000


def _col_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + (ord(ch.upper()) - 64)
        else:
            break
    return n - 1


def _is_date_format(code: str) -> bool:
    code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code.lower())
    return bool(re.search(r"[dyhs]", code)) or ("m" in code and ("d" in code or "y" in code))


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out = []
    with z.open("xl/sharedStrings.xml") as fh:
        for _, el in ET.iterparse(fh):
            if el.tag == f"{_NS}si":
                out.append("".join(t.text or "" for t in el.iter(f"{_NS}t")))
                el.clear()
    return out


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {}
    fmts = root.find(f"{_NS}numFmts")
    if fmts is not None:
        for f in fmts:
            custom[int(f.get("numFmtId"))] = f.get("formatCode", "")
    xfs = root.find(f"{_NS}cellXfs")
    dates = set()
    if xfs is not None:
        for i, xf in enumerate(xfs):
            fid = int(xf.get("numFmtId", "0"))
            if fid in _DATE_FORMAT_IDS or (fid in custom and _is_date_format(custom[fid])):
                dates.add(i)
    return dates


def _first_sheet(z: zipfile.ZipFile) -> str:
    names = z.namelist()
    if "xl/workbook.xml" in names and "xl/_rels/workbook.xml.rels" in names:
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        sheets = wb.find(f"{_NS}sheets")
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target") for r in rels}
        if sheets is not None and len(sheets):
            rid = sheets[0].get(f"{_REL_NS}id")
            target = targets.get(rid)
            if target:
                target = target.lstrip("/")
                return target if target.startswith("xl/") else posixpath.normpath(posixpath.join("xl", target))
    candidates = sorted(n for n in names if n.startswith("xl/worksheets/sheet") and n.endswith(".xml"))
    if not candidates:
        raise ValueError("workbook has no worksheet")
    return candidates[0]


def _serial_to_iso(text: str) -> str | None:
    try:
        days = float(text)
    except ValueError:
        return None
    stamp = _EXCEL_EPOCH + dt.timedelta(days=days)
    # round to the second, as spreadsheet tools display it
    stamp = (stamp + dt.timedelta(microseconds=500_000)).replace(microsecond=0)
    return stamp.strftime("%Y-%m-%d %H:%M:%S")


def workbook_cells(name: str, content: bytes) -> Iterator[tuple[str, int, int, str, str]]:
    """Decode the first sheet of an .xlsx into (file, row, col, text, kind) tuples."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        strings = _shared_strings(z)
        dates = _date_styles(z)
        with z.open(_first_sheet(z)) as fh:
            row_idx = -1
            for _, el in ET.iterparse(fh):
                if el.tag == f"{_NS}row":
                    el.clear()
                    continue
                if el.tag != f"{_NS}c":
                    continue
                ref = el.get("r", "")
                m = re.match(r"([A-Za-z]+)(\d+)", ref)
                if m:
                    col = _col_index(m.group(1))
                    row_idx = int(m.group(2)) - 1
                else:  # cells without references follow each other
                    col = -1
                t = el.get("t", "n")
                v = el.find(f"{_NS}v")
                raw = v.text if v is not None else None
                if t == "s" and raw is not None:
                    text, kind = strings[int(raw)], "s"
                elif t == "inlineStr":
                    text, kind = "".join(x.text or "" for x in el.iter(f"{_NS}t")), "s"
                elif t in ("str", "e"):
                    text, kind = raw, "s"
                elif t == "b":
                    text, kind = ("True" if raw == "1" else "False"), "b"
                elif raw is not None and int(el.get("s", "0")) in dates:
                    text, kind = _serial_to_iso(raw), "d"
                else:
                    text, kind = raw, "n"
                el.clear()
                if text is None or col < 0:
                    continue
                yield (name, row_idx, col, text, kind)


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = [f.name for f in CELLS.fields]
    for pdf in batches:
        for name, content in zip(pdf["file"], pdf["content"]):
            buf = []
            for cell in workbook_cells(name, bytes(content)):
                buf.append(cell)
                if len(buf) >= _BATCH:
                    yield pd.DataFrame(buf, columns=cols)
                    buf = []
            if buf:
                yield pd.DataFrame(buf, columns=cols)


def cells_from_content(files: DataFrame) -> DataFrame:
    """(file, content) rows -> cells; one decode per file on the executors."""
    return files.select("file", "content").mapInPandas(_decode, CELLS)


def materialize(cells: DataFrame) -> DataFrame:
    """Decode once: header detection, timestamps and values all read the cell
    frame, so it is checkpointed (shared checkpoint folder) instead of being
    decoded again by each branch; this also cuts the lineage to the raw files."""
    from stratus.session import checkpoint_dir

    checkpoint_dir(cells.sparkSession)
    return cells.checkpoint(eager=True)


def read_grid(spark: SparkSession, path: str, pattern: str = "*.xlsx", decode_once: bool = True) -> DataFrame:
    """Every workbook under ``path`` as cells (file, sheet_row, col, text, kind)."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    files = raw.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    cells = cells_from_content(files)
    return materialize(cells) if decode_once else cells


def _members(batches: Iterator[pd.DataFrame], keep: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    cols = ["archive", "member", "content"]
    for pdf in batches:
        for archive, content in zip(pdf["archive"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                for info in z.infolist():
                    base = posixpath.basename(info.filename)
                    if info.is_dir() or not base.lower().endswith((".xls", ".xlsx")):
                        continue
                    if keep and not any(k in base.upper() for k in keep):
                        continue
                    # one member per batch: members are decoded one at a time downstream
                    yield pd.DataFrame([(archive, base, z.read(info))], columns=cols)


def expand_archives(
    spark: SparkSession, path: str, keep: tuple[str, ...] = tuple(ARCHIVE_MEMBER_POLLUTANTS)
) -> DataFrame:
    """ZIP bundles -> (archive, member, content) of the spreadsheets inside,
    keeping members whose name contains one of ``keep`` (upper-cased)."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    arch = raw.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")
    return arch.mapInPandas(
        lambda it: _members(it, keep), "archive string, member string, content binary"
    )


def archive_cells(members: DataFrame) -> DataFrame:
    """Cells of the .xlsx members of expanded archives (file = member name).

    Legacy binary .xls members have no standard-library decoder and must be
    converted first; ``undecoded_members`` lists them."""
    x = members.filter(F.lower("member").endswith(".xlsx"))
    return materialize(cells_from_content(x.select(F.col("member").alias("file"), "content")))


def undecoded_members(members: DataFrame) -> DataFrame:
    """(archive, member) of the members that ``archive_cells`` cannot read."""
    return members.filter(~F.lower("member").endswith(".xlsx")).select("archive", "member")

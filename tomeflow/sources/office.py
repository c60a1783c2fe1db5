"""Markdown from office files, with the standard library: a small helper inside of tasks.

Readers take the bytes of one file and give Markdown; what they can't read raises, and what holds no text raises
``NoText``. PDF needs pypdf. A caller may bring readers of its own: ``convert`` sends them to the tasks.
"""

from __future__ import annotations

import io
import re
import signal
import threading
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta
from xml.etree import ElementTree

_NS = re.compile(r"\{[^}]*\}")


#: Bytes that an archive may unpack to, and pages of a PDF that are read at once.
UNPACKED, PAGES = 1 << 30, 40


class NoText(Exception):
    """A file that can be read but holds no text."""


@contextmanager
def limited(seconds: int) -> Iterator[None]:
    """Raises TimeoutError if what is inside takes longer; 0 is no limit. Only main threads, as in tasks, can be stopped."""
    if not seconds or threading.current_thread() is not threading.main_thread():
        yield
        return

    def stop(*_: object) -> None:
        raise TimeoutError(f"reader stopped after {seconds} s")

    before = signal.signal(signal.SIGALRM, stop)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def _archive(content: bytes) -> zipfile.ZipFile:
    """An archive that unpacks to a bounded size."""
    z = zipfile.ZipFile(io.BytesIO(content))
    if sum(x.file_size for x in z.infolist()) > UNPACKED:
        raise ValueError(f"archive unpacks to more than {UNPACKED} bytes")
    return z


def _name(e: ElementTree.Element) -> str:
    return _NS.sub("", e.tag)


def _all(e: ElementTree.Element, name: str) -> list[ElementTree.Element]:
    return [x for x in e.iter() if _name(x) == name]


def _attr(e: ElementTree.Element | None, name: str) -> str:
    return next((v for k, v in e.attrib.items() if _NS.sub("", k) == name), "") if e is not None else ""


def _xml(z: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    return ElementTree.fromstring(z.read(name)) if name in z.namelist() else None


def _runs(e: ElementTree.Element) -> str:
    return "".join(x.text or "" for x in _all(e, "t"))


def _heading(style: str) -> str:
    m = re.search(r"(?:heading|标题)\s*(\d)", style, re.I)
    if m:
        return "#" * min(6, int(m[1])) + " "
    return "# " if style.lower() == "title" else "#### " if "heading" in style.lower() else ""


def read_docx(content: bytes) -> str:
    """Paragraphs and tables in the order of the body; heading styles become heading marks."""
    with _archive(content) as z:
        styles = _xml(z, "word/styles.xml")
        named = {_attr(s, "styleId"): _attr(next((x for x in s if _name(x) == "name"), None), "val") for s in (_all(styles, "style") if styles is not None else [])}
        body = next(x for x in _xml(z, "word/document.xml").iter() if _name(x) == "body")
    out = []
    for child in body:
        if _name(child) == "p":
            style = _attr(next(iter(_all(child, "pStyle")), None), "val")
            if text := _runs(child).strip():
                out.append(_heading(named.get(style, style)) + text)
        elif _name(child) == "tbl":
            rows = [[" ".join(_runs(p) for p in _all(c, "p")).strip() for c in r if _name(c) == "tc"] for r in child if _name(r) == "tr"]
            out.append("\n".join("| " + " | ".join(r) + " |" for r in rows))
    return "\n\n".join(out)


def read_docx_plain(content: bytes) -> str:
    """The text of every paragraph, whatever the file lacks else."""
    with _archive(content) as z:
        name = next((n for n in ("word/document.xml", "Word/document.xml") if n in z.namelist()), None)
        if name is None:
            raise ValueError("no word/document.xml in the archive")
        return "\n\n".join(t for p in _all(_xml(z, name), "p") if (t := _runs(p).strip()))


def read_docx_or_plain(content: bytes) -> str:
    """As ``read_docx``; where that fails for whatever reason, the plain paragraphs."""
    try:
        return read_docx(content)
    except (TimeoutError, zipfile.BadZipFile):
        raise
    except Exception:  # noqa: BLE001 - broken styles, relations or bodies
        return read_docx_plain(content)


#: Built-in number formats that are dates or times, and the letters that make a format of one's own such.
DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))
_DATE_LETTERS = re.compile(r"[ymdhs]", re.I)


def _date_styles(z: zipfile.ZipFile) -> list[bool]:
    """Of each cell style, whether its numbers are dates."""
    styles = _xml(z, "xl/styles.xml")
    if styles is None:
        return []
    own = {_attr(f, "numFmtId"): _attr(f, "formatCode") for f in _all(styles, "numFmt")}
    bare = {k: re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", v) for k, v in own.items()}
    cells = next(iter(_all(styles, "cellXfs")), None)
    ids = [_attr(x, "numFmtId") or "0" for x in cells if _name(x) == "xf"] if cells is not None else []
    return [bool(_DATE_LETTERS.search(bare[i])) if i in bare else int(i) in DATE_FORMATS for i in ids]


def _moment(serial: float, from_1904: bool) -> str:
    """A day number as date and time; one below 1 is a time of day."""
    at = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30)
    moment = at + timedelta(seconds=round(serial * 86400))
    return moment.strftime("%H:%M:%S") if serial < 1 else moment.isoformat(" ")


def _cell(c: ElementTree.Element, strings: list[str], dates: list[bool], from_1904: bool) -> str:
    kind, raw = _attr(c, "t"), next((x.text or "" for x in c if _name(x) == "v"), "")
    if kind == "inlineStr":
        return _runs(c)
    if kind == "s":
        return strings[int(raw)] if raw else ""
    if kind == "b":
        return {"1": "True", "0": "False"}.get(raw, raw)
    style = int(_attr(c, "s") or 0)
    if kind in ("", "n") and raw and style < len(dates) and dates[style]:
        return _moment(float(raw), from_1904)
    return raw


def read_xlsx(content: bytes) -> str:
    """A table a sheet; rows of nothing but empty cells and zeros are left out. Dates, times and truth values are written out."""
    with _archive(content) as z:
        shared = _xml(z, "xl/sharedStrings.xml")
        strings = [_runs(s) for s in shared if _name(s) == "si"] if shared is not None else []
        links = {_attr(r, "Id"): _attr(r, "Target") for r in _all(_xml(z, "xl/_rels/workbook.xml.rels"), "Relationship")}
        book, dates = _xml(z, "xl/workbook.xml"), _date_styles(z)
        from_1904 = any(_attr(p, "date1904") in ("1", "true") for p in _all(book, "workbookPr"))
        out = []
        for sheet in _all(book, "sheet"):
            target = links[next(v for k, v in sheet.attrib.items() if k.endswith("}id"))].lstrip("/")
            data = _xml(z, target if target.startswith("xl/") else f"xl/{target}")
            rows = []
            for row in _all(data, "row"):
                cells: dict[int, str] = {}
                for n, c in enumerate(x for x in row if _name(x) == "c"):
                    ref = re.match(r"[A-Z]+", _attr(c, "r"))
                    col = sum((ord(x) - 64) * 26**k for k, x in enumerate(reversed(ref[0]))) - 1 if ref else n
                    cells[col] = _cell(c, strings, dates, from_1904)
                line = [cells.get(k, "").strip() for k in range(max(cells, default=-1) + 1)]
                if any(x not in ("", "0", "0.0") for x in line):
                    rows.append(line)
            if rows:
                width = max(map(len, rows))
                lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
                out.append("\n".join([f"## {_attr(sheet, 'name')}", "", lines[0], "|" + " --- |" * width, *lines[1:]]))
    return "\n\n".join(out)


def read_pptx(content: bytes) -> str:
    """The paragraphs of every slide under its number."""
    with _archive(content) as z:
        names = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
        out = []
        for i, n in enumerate(names, 1):
            lines = [t for p in _all(_xml(z, n), "p") if (t := _runs(p).strip())]
            out.append("\n\n".join([f"## Slide {i}", *lines]))
    return "\n\n".join(out)


def read_pdf(content: bytes, reader: Callable | None = None) -> str:
    """The text of every page under a mark with its number. So many pages are read at once; a page that can't be read counts as blank."""
    if reader is None:
        from pypdf import PdfReader as reader  # noqa: N813
    out, total = [], len(reader(io.BytesIO(content)).pages)
    for first in range(0, total, PAGES):
        pages = reader(io.BytesIO(content)).pages  # what earlier pages took is let go
        for i in range(first, min(first + PAGES, total)):
            try:
                text = pages[i].extract_text() or ""
            except TimeoutError:
                raise
            except Exception:  # noqa: BLE001 - one broken page
                text = ""
            if text.strip():
                out.append(f"<!-- Page {i + 1} -->\n\n{text.strip()}")
    if not out:
        raise NoText("no text on any page (possibly scanned)")
    return "\n\n".join(out)


READERS: dict[str, Callable[[bytes], str]] = {"docx": read_docx_or_plain, "xlsx": read_xlsx, "pptx": read_pptx, "pdf": read_pdf}


def sniff(ext: str, content: bytes) -> str | None:
    """What keeps a file from being read as what its extension says; null if nothing does."""
    if ext == "docx":
        try:
            with _archive(content) as z:
                types = z.read("[Content_Types].xml").decode("utf-8", "replace")
            return "macro-enabled document named .docx" if "macroEnabled" in types else None
        except (zipfile.BadZipFile, KeyError):
            return "no zip archive"
    if ext == "xlsx" and not content.startswith(b"PK"):
        return "old binary workbook named .xlsx" if content.startswith(b"\xd0\xcf\x11\xe0") else "no zip archive"
    if ext == "pdf" and b"%PDF-" not in content[:1024]:
        return "no PDF header"
    if ext == "txt" and not content.strip():
        return "blank"
    return None

"""Splitting of oversized texts at natural boundaries.

Every text has boundaries of several strengths: starts of its natural units (statements, keys, sections,
Markdown blocks), then lines, sentences and words. A sparse table answers, for any window of permissible
lengths, which boundary in it is the strongest, the rightmost among equals; the piece ends there, and the
next begins an overlap before it. Where a window holds no boundary the text is cut at the limit.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeflow.operators.ordering import running_total

LIMIT, OVERLAP = 1200, 300
UNIT, LINE, SENTENCE, WORD = 4, 3, 2, 1

#: doc_type by extension; everything else is doc.
KIND_OF_EXTENSION = {"sql": "sql", "yaml": "yaml", "yml": "yaml", "json": "json", "ini": "ini", "conf": "ini", "toml": "toml"}

_SQL = re.compile(r"'(?:[^']|'')*'?|\"(?:[^\"]|\"\")*\"?|--[^\n]*|/\*.*?(?:\*/|\Z)|(\$(?:[A-Za-z_]\w*)?\$).*?(?:\1|\Z)|(;)\s*", re.S)
_YAML_KEY = re.compile(r"(?:\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\n]|'')*'|(?:[^\s#\-?:,\[\]{}&*!|>'\"%@`]|[-?:](?=\S))(?:[^:#\n]|:(?=\S)|(?<=\S)#)*?)[ \t]*:(?=\s|\Z)")
_JSON_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],:]', re.S)
_INI_HEADER = re.compile(r"[ \t]*\[[^\]\n]+\][ \t]*(?:[;#][^\n]*)?\r?\Z")
_TOML_HEADER = re.compile(r"[ \t]*\[\[?[^\[\]\n]+\]\]?[ \t]*(?:#[^\n]*)?\r?\Z")
_TOML_TOKEN = re.compile(r'"""|' + r"'''" + r'|"(?:[^"\\\n]|\\.)*"|' + r"'[^'\n]*'|#[^\n]*|[\[\]]")
_FENCE = re.compile(r" {0,3}(`{3,}|~{3,})([^\n]*)")
_SENTENCE = re.compile(r"[.!?…]+[\"'”’»)\]]*\s+|[。！？；]+[”’」』）]*\s*")
_SPACE = re.compile(r"\s+")


def _lines(text: str) -> Iterator[tuple[int, str]]:
    at = 0
    for line in text.split("\n"):
        yield at, line
        at += len(line) + 1


def _sql(text: str) -> list[int]:
    return [m.end() for m in _SQL.finditer(text) if m[2] and m.end() < len(text)]


def _yaml(text: str) -> list[int]:
    return [at for at, line in _lines(text) if _YAML_KEY.match(line)][1:]


def _refuse(name: str) -> None:
    raise ValueError(name)


def _json(text: str) -> list[int]:
    try:
        if not isinstance(json.loads(text, parse_constant=_refuse), dict):
            return []
    except (ValueError, RecursionError):
        return []
    depth, key, out = 0, False, []
    for m in _JSON_TOKEN.finditer(text):
        c = m[0][0]
        if c in "{[":
            depth += 1
            key = depth == 1
        elif c in "}]":
            depth -= 1
        elif c == "," and depth == 1:
            key = True
        elif c == '"' and depth == 1 and key:
            out.append(m.start())
            key = False
    return out[1:]


def _ini(text: str) -> list[int]:
    return [at for at, line in _lines(text) if _INI_HEADER.match(line)]


def _toml(text: str) -> list[int]:
    """Headers outside of arrays and of strings that span lines."""
    out, depth, quote = [], 0, ""
    for at, line in _lines(text):
        if not quote and not depth and _TOML_HEADER.match(line):
            out.append(at)
            continue
        for m in _TOML_TOKEN.finditer(line):
            t = m[0]
            if quote:
                quote = "" if t == quote else quote
            elif t in ('"""', "'''"):
                quote = t
            elif t == "[":
                depth += 1
            elif t == "]":
                depth = max(0, depth - 1)
    return out


def _doc(text: str) -> list[int]:
    """First lines of Markdown blocks; blank lines within a fence separate nothing."""
    out, fence, inside = [], "", False
    for at, line in _lines(text):
        m = _FENCE.match(line)
        if fence:
            inside = True
            if m and m[1][0] == fence[0] and len(m[1]) >= len(fence) and not m[2].strip():
                fence = ""
            continue
        if not line.strip():
            inside = False
            continue
        if not inside:
            out.append(at)
            inside = True
        if m and not (m[1][0] == "`" and "`" in m[2]):
            fence = m[1]
    return out[1:]


_UNITS = {"sql": _sql, "yaml": _yaml, "json": _json, "ini": _ini, "toml": _toml, "doc": _doc}


class Boundaries:
    """Positions where a text may be cut, their strengths, and the sparse table of range maxima over them."""

    def __init__(self, text: str, kind: str, limit: int = LIMIT) -> None:
        strength: dict[int, int] = {}
        for pattern, value in ((_SPACE, WORD), (_SENTENCE, SENTENCE)):
            strength |= dict.fromkeys((m.end() for m in pattern.finditer(text)), value)
        strength |= dict.fromkeys((at for at, _ in _lines(text)), LINE)
        strength |= dict.fromkeys(_UNITS.get(kind, _doc)(text), UNIT)
        strength.pop(0, None)
        strength.pop(len(text), None)
        self.size, self.limit = len(text), limit
        self.at = sorted(strength)
        self.units = [0, *(p for p in self.at if strength[p] == UNIT)]
        # a stronger boundary has the larger value, and among equals the one further right
        values = np.array([strength[p] * (len(text) + 1) + p for p in self.at], dtype=np.int64)
        self.table = [values]
        while (width := 1 << len(self.table)) <= min(len(values), limit):
            below = self.table[-1]
            self.table.append(np.maximum(below[: len(values) - width + 1], below[width // 2 : width // 2 + len(values) - width + 1]))

    def strongest(self, low: int, high: int) -> int:
        """The strongest boundary in (low, high], the rightmost among equals; ``high`` itself if there is none."""
        return self._strongest(low, high)[1]

    def _strongest(self, low: int, high: int) -> tuple[int, int]:
        """Strength and position of the strongest boundary in (low, high]; strength 0 at ``high`` if there is none."""
        a, b = bisect_right(self.at, low), bisect_right(self.at, high)
        if a >= b:
            return 0, high
        level = (b - a).bit_length() - 1
        best = max(self.table[level][a], self.table[level][b - (1 << level)])
        return divmod(int(best), self.size + 1)

    def pieces(self, overlap: int) -> list[tuple[int, int]]:
        """Start and end of each piece: none longer than the limit, together the whole text.

        Cuts are looked for in the second half of the limit, so that no piece is little else than its overlap; nearer
        to the start only where a line would have to be broken otherwise.
        """
        out, start = [], 0
        while self.size - start > self.limit:
            strength, cut = self._strongest(start + max(overlap, self.limit // 2), start + self.limit)
            if strength < LINE:
                cut = max((strength, cut), self._strongest(start + overlap, start + self.limit))[1]
            out.append((start, cut))
            start = cut - overlap
        return [*out, (start, self.size)]


def kind_of(doc_type: Column, source: Column) -> Column:
    """The doc_type in small letters; of a null one, that of the extension of the source."""
    ext = F.lower(F.regexp_extract(F.coalesce(source, F.lit("")), r"\.([^./\\]+)$", 1))
    by_ext = F.create_map(*[F.lit(x) for kv in KIND_OF_EXTENSION.items() for x in kv])
    return F.coalesce(F.lower(F.trim(doc_type)), by_ext[ext], F.lit("doc"))


def splitter(limit: int = LIMIT, overlap: int = OVERLAP):  # noqa: ANN201
    """A column function of (text, kind): unit starts and pieces. Null text has null."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")

    @F.pandas_udf("units array<int>, pieces array<struct<piece_no int, start int, text string>>")
    def split(text: pd.Series, kind: pd.Series) -> pd.DataFrame:
        units, pieces = [], []
        for t, k in zip(text, kind, strict=True):
            if t is None:
                units.append(None)
                pieces.append(None)
                continue
            found = Boundaries(t, k, limit)
            units.append(found.units)
            pieces.append([{"piece_no": n, "start": a, "text": t[a:b]} for n, (a, b) in enumerate(found.pieces(0 if k in _UNITS and k != "doc" else overlap))])
        return pd.DataFrame({"units": units, "pieces": pieces})

    return split.asNondeterministic()  # or a filter on its result runs it again


def split_oversized(chunks: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """The rows of ``chunks`` (chunk_id, source, doc_type, text) whose text is above ``limit`` code points, with ``units`` and ``pieces``.

    Texts at the limit or under it, empty and null ones are no rows of the result. A doc_type that is not one of
    the known ones counts as doc. Other columns are dropped, whatever their names.
    """
    kind = kind_of(F.col("doc_type"), F.col("source"))
    big = chunks.select("chunk_id", "source", kind.alias("kind"), "text").where(F.length("text") > limit)
    return big.select("chunk_id", "kind", splitter(limit, overlap)("text", "kind").alias("cut")).select("chunk_id", "kind", "cut.units", "cut.pieces")


def rechunk(chunks: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of the oversized chunks with new chunk indexes.

    A file's chunks count on in the order of their old index; each takes as many numbers as it has pieces. A
    chunk that is stored again, under the same (source, file_hash, chunk_index), gets the numbers of its place
    again: the place counts the pieces of the row stored last. Null keys are keys like any other.
    """
    key = ["source", "file_hash", "chunk_index"]
    kind = kind_of(F.col("doc_type"), F.col("source"))
    rows = chunks.select("chunk_id", *key, "ingested_at", kind.alias("kind"), F.when(F.length("text") > limit, F.col("text")).alias("text"))
    cut = rows.select("chunk_id", *key, "ingested_at", splitter(limit, overlap)("text", "kind")["pieces"].alias("pieces"))
    places = cut.groupBy(*key).agg(F.max_by(F.coalesce(F.size("pieces"), F.lit(1)), F.struct("ingested_at", "chunk_id")).cast("long").alias("n"))
    places = places.withColumn("n", F.greatest("n", F.lit(1).cast("long")))
    places = running_total(places, ["source", "file_hash"], ["chunk_index"], "n", "through")
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"p.{k}")) for k in key]
    big = cut.where("pieces is not null").alias("c").join(places.alias("p"), same)
    piece = big.select("c.chunk_id", "c.source", "c.file_hash", F.col("c.chunk_index").alias("old_index"), (F.col("p.through") - F.col("p.n")).alias("first"), F.explode("c.pieces").alias("x"))
    return piece.select("chunk_id", "source", "file_hash", "old_index", "x.piece_no", "x.start", (F.col("first") + F.col("x.piece_no")).cast("int").alias("chunk_index"), F.col("x.text").alias("text"))

"""Column expressions over text: trimming, readability, boilerplate lines, Markdown clean-up, file types.

White space is that of Unicode everywhere. All functions give null for null text unless they say otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEAD = 2000

# What tells readable text.
CJK_PUNCTUATION = "。，、；：？！—…·「」『』【】（）《》〈〉．"
TEMPLATES = ("技  术  文  件", "技术文件", "<!-- image -->", "<!--image-->", "# ", "## ", "### ", "| ---", "|序号", "| 序号", "目  录", "目录", "第1章", "第 1 章", "第一章", "1. ", "1）", "1、", "前  言", "前言", "版  本", "版本", "修订记录", "修  订  记  录")

# Words of covers, headers and footers that say nothing about the subject. Blanks may stand between the signs of SPACED words.
BOILERPLATE_HEADINGS = ("引言", "概述", "背景", "Contents")
SPACED_HEADINGS = ("前言", "目录")
BOILERPLATE_WORDS = ("版权", "著作权", "Confidential", "机密", "秘密", "绝密", "变更记录", "变更历史", "修订历史", "文档变更")
SPACED_WORDS = ("版本:", "版本：", "版本号", "修订记录")
BOILERPLATE_STARTS = ("作者", "编写", "编制", "审核", "批准", "校对", "会审", "评审", "起草", "复核", "技术文件", "技术手册", "产品文档", "产品手册", "用户手册", "操作指南")
#: What stands before and behind the number of a page on a line of its own.
PAGE_FRAMES = (("第", "页"), ("—", "—"), ("-", "-"))
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"

# The extensions that are read, and the type that each gives.
DOC_EXTENSIONS = ("docx", "md", "pdf", "txt", "pptx", "xlsx")
CODE_TYPES = {"sql": "sql", "yaml": "yaml", "yml": "yaml", "json": "json", "ini": "ini", "conf": "ini", "toml": "toml"}


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def utrim(c: Column | str) -> Column:
    """Text without white space at its ends."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column | str) -> Column:
    """True for null, empty and blank text."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | ~c.rlike(r"(?U)\S")


def extension(path: Column | str) -> Column:
    """The extension of a path in small letters, without the dot; "" for none."""
    return F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))


def doc_type(ext: Column) -> Column:
    """The type of content by extension; everything that is no code or configuration is doc."""
    types = F.create_map(*[F.lit(x) for kv in CODE_TYPES.items() for x in kv])
    return F.coalesce(types[ext], F.lit("doc"))


def iso_utc(c: Column | str) -> Column:
    """A timestamp as ISO 8601 text in UTC; fractions only where there are some."""
    c = F.to_utc_timestamp(c, F.current_timezone())
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.concat(whole, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""), F.lit("+00:00"))


def file_name(path: Column | str) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def punctuation_count(c: Column | str) -> Column:
    """East Asian punctuation marks in the first characters."""
    head = F.substring(c, 1, HEAD)
    return F.length(head) - F.length(F.regexp_replace(head, f"[{CJK_PUNCTUATION}]", ""))


def is_readable(c: Column | str, marks: int = 3) -> Column:
    """Whether text looks like text: marks of East Asian punctuation, a usual template, or ten ASCII words near its start.

    Null, empty and blank text is not readable.
    """
    c = F.col(c) if isinstance(c, str) else c
    head = F.substring(c, 1, HEAD)
    template = _any([head.contains(t) for t in TEMPLATES])
    words = F.regexp_count(head, F.lit(r"(?U)(?<!\S)[\x00-\x08\x0E-\x1F!-\x7F]{3,}+(?!\S)")) >= 10
    return F.coalesce(~is_blank(c) & ((punctuation_count(c) >= marks) | template | words), F.lit(False))


def garbled_ratio(c: Column | str) -> Column:
    """Share of the first characters that are no letter, number, punctuation or separator; 1 for empty and null text."""
    head = F.substring(c, 1, HEAD)
    odd = F.length(F.regexp_replace(head, r"[\p{L}\p{N}\p{P}\p{Z}]", ""))
    return F.when(F.coalesce(F.length(head), F.lit(0)) == 0, F.lit(1.0)).otherwise(odd / F.length(head))


def is_boilerplate(line: Column) -> Column:
    """Whether a line is one of a cover, header or footer."""
    bare = utrim(line)
    packed = F.regexp_replace(bare, r"(?U)\s+", "")
    title = F.ltrim(packed, F.lit("#"))
    heading = packed.startswith("#") & _any([title.startswith(w) for w in (*BOILERPLATE_HEADINGS, *SPACED_HEADINGS)])
    words = _any([bare.contains(w) for w in BOILERPLATE_WORDS] + [packed.contains(w) for w in SPACED_WORDS])
    starts = _any([bare.startswith(w) for w in BOILERPLATE_STARTS])
    page = _any([packed.startswith(a) & packed.endswith(b) & F.substring(packed, 2, F.length(packed) - 2).rlike("^[0-9]+$") for a, b in PAGE_FRAMES] + [bare.rlike(r"(?U)^Page\s+[0-9]+$")])
    rights = F.regexp_replace(F.lower(bare), r"(?U)\s+", " ")
    rights = rights.contains("all rights reserved") | rights.contains("all right reserved") | packed.rlike("©[0-9]{4}")
    return heading | words | starts | page | rights | packed.rlike("^文档版本[0-9]") | F.contains(F.lit(CIRCLED), F.substring(bare, 1, 1)) & (bare != "")


def size_warning(c: Column | str, limit_kb: int = 500) -> Column:
    """A warning for text of more than so many KB in UTF-8, else null."""
    size = F.octet_length(c)
    return F.when(size > limit_kb * 1024, F.format_string("large text: %.1f KB", size / 1024.0))


def strip_comments(c: Column | str) -> Column:
    """Without HTML comments, those that span lines included."""
    return F.regexp_replace(c, r"(?s)<!--.*?-->", "")


def drop_blank_rows(c: Column | str) -> Column:
    """Table rows of empty cells become empty lines."""
    return F.array_join(F.transform(F.split(c, "\n", -1), lambda line: F.when(line.rlike(r"(?U)^\|[|\s]*\|\s*$"), "").otherwise(line)), "\n")


def collapse_newlines(c: Column | str) -> Column:
    """Of three and more line ends in a row two are left."""
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def source_marker(c: Column | str) -> Column:
    """The extension named in a type marker on the first line of converted code, with its dot; null if there is none."""
    found = F.lower(F.regexp_extract(c, r"\A<!--\s*\w+:source_ext=(\.\w+)\s*-->", 1))
    return F.when(F.substring(found, 2, 10).isin(*CODE_TYPES), found)


def strip_marker(c: Column | str) -> Column:
    """Without the marker line, the fence that opens after it and the one that closes at the end."""
    c = F.regexp_replace(c, r"\A<!--\s*\w+:source_ext=[^\n]*-->[ \t]*\r?\n?", "")
    c = F.regexp_replace(c, r"\A\s*(?:```|~~~)[^\n]*\n", "")
    return F.regexp_replace(c, r"\n?(?:```|~~~)\s*\z", "")

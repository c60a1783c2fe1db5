"""What a text consists of: prose, and all that is something else. A small helper inside of tasks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

#: Signs that begin a list entry, and forms of lines that are code, configuration or records.
_MARK = re.compile(r"\s*(?:[-*+•·‣◦▪–—]\s+|\*\*(?=\S)|\(?\d{1,3}[.)、](?!\d)\s*|[（(]?[a-zA-Z一二三四五六七八九十][)）、.]\s+|\[[ xX✓]?\]\s*|[①-⑳⑴-⑽☐☑✓✗]\s*)")
_HEADING = re.compile(r"\s{0,3}#{1,6}\s+\S")
_FENCE = re.compile(r"\s*(`{3,}|~{3,})")
_RULE = re.compile(r"[\s|:\-=_*+~#<>.]+")
_CODE = re.compile(
    r"\s*(?:[{}\[\]()]+[,;]?\s*$|\"[^\"]*\"\s*:|\[\[?[^\]]+\]\]?\s*(?:[#;].*)?$|[\w.\-\"' ]{1,40}:\s*[|>][-+]?\s*$|-\s+[\w.\-]+:|</?\w[^>]*>|<!--|--\s|//|/\*|\*/|\$\$|#!|@\w+|"
    r"(?:select|insert|update|delete|create|alter|drop|grant|comment on|begin|end|commit|declare|return|values|from|where|join|group by|order by|left join|inner join|language|new\.)\b(?=.*[;(=*_]|\s+\S+$)|"
    r"(?:def|class|import|from|const|let|var|function|export|public|private|static|if|for|while|return|try|except|elif|else|print|echo|sudo|curl|docker|git|pip|npm|cd|ls|run|client|host|get|post)\b.*(?:[={;\\]|\(\S*\)|:$|--\w|https?:|\s/\w))",
    re.I,
)
_PAIR = re.compile(r"\s*[\"']?(?P<key>[\w.\-]+(?:[ ][\w.\-]+)?)[\"']?\s*(?:[:=：；]|->)\s*(?P<value>\S.*)?$")
_CLAUSE = re.compile("[。，！？]")
_CODE_END = re.compile(r"(?:[;{}\[(\\]|\),?|=>|\$\w+|\*/)\s*$")
_GAPS = re.compile(r"\s{2,}|\t")
_END = re.compile(r"[.!?…。！？]+[\"'”’»)\]」』）]*(?=\s|$|[^\s\w])|[。！？；]")
_WORD = re.compile(r"[^\W\d_]+(?:[’'\-][^\W\d_]+)*")
_HAN = re.compile(r"[一-鿿]+")
_DIGIT = re.compile(r"\d")
_TREE = frozenset("│├└─┌┬╰")
_RULED = frozenset("|:-=_*+~#<>.")
#: A line that begins with a letter, ends a sentence and holds no sign of code, table or list.
_SENTENCE_LINE = re.compile(r"[^\W\d_](?![.)、）])[^|\t{}\[\]=;_<>\\/@#$*`]*[.!?。！？]\s*")


class Words:
    """Frequent words of each language."""

    def __init__(self, pairs: Iterable[tuple[str, str]]) -> None:
        self.of: dict[str, set[str]] = {}
        for lang, word in pairs:
            self.of.setdefault(lang, set()).add(word.casefold())
        self.han = re.compile("|".join(sorted(map(re.escape, self.of.get("zh", {"的"})), key=len, reverse=True)))
        self.any = set().union(*[w for k, w in self.of.items() if k != "zh"]) if self.of else set()

    def language(self, words: Counter, han: int, letters: int) -> str:
        """The language whose frequent words the text holds most of."""
        if han * 3 > letters:
            return "zh"
        found = {k: sum(words[x] for x in w if x in words) for k, w in self.of.items() if k != "zh"}
        best = max(found, key=lambda k: (found[k], k), default="und")
        return best if found and found[best] else "und"


def _solid(text: str, blanks: Iterable[str]) -> int:
    """Characters of a text that are none of its blank ones."""
    n = len(text)
    for c in blanks:
        n -= text.count(c)
    return n


def _kind_of_line(line: str) -> str:
    """What a line is whatever its words: an entry of a list, a row of a table or record, code, or none of these ("")."""
    if _SENTENCE_LINE.fullmatch(line):
        return ""
    if _MARK.match(line):
        return "entries"
    first = line.lstrip()[:1]
    if first in _TREE:
        return "code"
    if first in _RULED and _RULE.fullmatch(line) or line.count("|") >= 2:
        return "rows"
    if ("  " in line or "\t" in line) and len(cells := _GAPS.split(line.strip())) >= 3 and sum(len(c.split()) for c in cells) <= 4 * len(cells) and len(line) <= 40 * len(cells):
        return "rows"
    if _CODE.match(line) or _CODE_END.search(line):
        return "code"
    m = _PAIR.match(line)
    if not m or m["value"] and _CLAUSE.search(m["value"]):
        return ""
    return "code" if "_" in m["key"] or "." in m["key"] or not m["value"] or len(m["value"].split()) <= 4 and len(m["value"]) <= 60 else ""


def _sentences(text: str) -> Iterable[tuple[str, bool]]:
    at = 0
    for m in _END.finditer(text):
        yield text[at : m.end()], True
        at = m.end()
    if text[at:].strip():
        yield text[at:], False


def _is_prose(sentence: str, ended: bool, words: Words, solid: int) -> bool:
    han = 0 if sentence.isascii() else sum(map(len, _HAN.findall(sentence)))
    if han and han * 2 > solid * 0.6:
        commas = sentence.count(",") + sentence.count("、")
        return han >= 5 and (ended or han >= 12 and "，" in sentence) and commas * 8 < han and (len(words.han.findall(sentence)) * 30 >= han or "，" in sentence)
    if not ended and len(_DIGIT.findall(sentence)) * 6 > solid:
        return False
    tokens = _WORD.findall(sentence.casefold())
    if len(tokens) < 4:
        return False
    hits = sum(map(words.any.__contains__, tokens))
    commas = sentence.count(",") + sentence.count(";")
    return hits * 9 >= len(tokens) and commas * 3 <= len(tokens) + 3 and (ended or len(tokens) >= 6 and hits * 5 >= len(tokens))


def _sentence_chars(lines: list[str], words: Words, blanks: Iterable[str]) -> tuple[int, int]:
    """Non-blank characters of plain lines that form no sentences, and that do."""
    loose = prose = 0
    for s, ended in _sentences("\n".join(lines)):
        n = _solid(s, blanks)
        # entries before the sentence on lines of their own are not part of it
        head, _, tail = s.rpartition("\n") if ended and "\n" in s.strip() else ("", "", s)
        if _is_prose(s, ended, words, n):
            prose += n
        elif head and _is_prose(tail, ended, words, m := _solid(tail, blanks)):
            prose += m
            loose += n - m
        else:
            loose += n
    return loose, prose


def _groups(text: str, blanks: Iterable[str]) -> tuple[list[list[str]], int]:
    """The groups of lines between blank ones, and the non-blank characters of fenced code."""
    fenced, fence, groups = 0, "", [[]]
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    has = "```" in text or "~~~" in text
    marks = [m[1] if ("```" in x or "~~~" in x) and (m := _FENCE.match(x)) else "" for x in lines] if has else []
    closing = {k: i for i, k in enumerate(k[:1] for k in marks) if k}
    for i, line in enumerate(lines):
        if has:
            # a fence that nothing closes is none
            m = _FENCE.match(line) if marks[i] and (fence or closing[marks[i][0]] > i) else None
            if fence or m:
                fenced += _solid(line, blanks)
                if not fence:
                    fence = m[1]
                elif m and m[1][0] == fence[0] and len(m[1]) >= len(fence):
                    fence = ""
                continue
        if not line or line.isspace():
            if groups[-1]:
                groups.append([])
        else:
            groups[-1].append(line)
    return groups, fenced


#: What the characters of a text are counted as.
KINDS = ("entries", "rows", "code", "loose", "prose")


def chars_by_kind(text: str, words: Words) -> dict[str, int]:
    """Non-blank characters of a text in entries of lists, rows of tables or records, code, words that form no sentences, and prose. Headings count as none of them."""
    blanks = [c for c in set(text) if c.isspace()]
    groups, fenced = _groups(text, blanks)
    size = lambda group: sum([_solid(x, blanks) for x in group])
    out = dict.fromkeys(KINDS, 0)
    out["code"] = fenced
    for group in groups:
        if not group:
            continue
        kinds = [None if "#" in x and _HEADING.match(x) else _kind_of_line(x.lstrip("> ") if x.lstrip().startswith(">") else x) for x in group]
        # records of one shape: comma-separated lines with the same number of cells
        commas = [x.count(",") for x in group]
        top, n = Counter(commas).most_common(1)[0] if len(group) >= 2 and any(commas) else (0, 0)
        if top >= 1 and n * 10 >= len(group) * 9 and sum(len(c.split()) for x in group for c in x.split(",")) <= 3.2 * len(group) * (top + 1):
            out["rows"] += size(group)
            continue
        known = [x for x in kinds if x is not None]
        if len(known) > 1 and sum(map(bool, known)) * 10 >= len(known) * 4 and sum(bool(_CODE.match(x) or _CODE_END.search(x) or _PAIR.match(x)) for x in group) * 2 >= len(group):
            out["code"] += size(group)
            continue
        plain: list[str] = []
        for line, kind in zip([*group, ""], [*kinds, "end"], strict=True):
            if kind is None:
                continue
            if not kind:
                plain.append(line.lstrip("> "))
                continue
            if plain:
                loose, prose = _sentence_chars(plain, words, blanks)
                out["loose"] += loose
                out["prose"] += prose
                plain = []
            if kind != "end":
                out[kind] += _solid(line, blanks)
    return out

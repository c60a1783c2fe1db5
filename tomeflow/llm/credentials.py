"""Credentials written out in texts: where they begin, and the texts with them masked.

Lines that hold a quoted string or long token, or a word that introduces a secret, are looked at. Of each such
line the candidates are taken out, and a candidate counts if its Shannon entropy, in the alphabet that it is
written in, is above a threshold adjusted to its length, and it is no hash, identifier, reference or placeholder.
What introduces a candidate decides how strict the threshold is. Texts are searched and masked where Spark reads
them: nothing but what was found is shuffled.
"""

from __future__ import annotations

import base64
import binascii
import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names that introduce a secret, in the languages of the texts, and words after which they name something else.
SECRET_WORDS = (
    r"pass(?:word|wd|wort|phrase|code)?|pwd|pw|kennwort|zugang|mot[ _-]de[ _-]passe|mdp|contraseña|contrasena|clave|parola|senha|"
    r"secret(?:[ _-]?key)?|token|bearer|credentials?|auth|unlock[ _-]code|(?:api|access|auth|secret|private|signing|encryption|tls|ssl|ssh|master|account|shared|service|client|deploy|license)[ _-]?key|"
    r"密码|口令|密钥|令牌|暗号"
)
OTHER_NAMES = re.compile(r"(?i)(?:^|[_\-. ])(?:public|pub|max|min|num|no|use|has|is|require|allow|enable|disable|hash|hashed|encrypted)(?=[_\-. ])")
PLAIN_NAMES = re.compile(r"(?i)(?:public|fingerprint|digest|checksum|sha\d*|md5|commit|revision|build|trace|request|tenant|integrity|thumbnail|image|uuid|guid|etag|nonce|version|(?:^|[_-])id$|hash|file|path|url$|crc|serial)")

_WORD_AT = rf"[\w.\-]*?(?:{SECRET_WORDS})"
_QUOTED = r"\\?\"(?P<dq>(?:[^\"\\\n]|\\(?!\").)*?)\\?\"|(?:\b[NEne])?'(?P<sq>(?:[^'\n]|'')*)'|`(?P<bq>[^`\n]*)`"
_VALUE = rf"(?:{_QUOTED}|(?P<bare>[^\s\"'`|<,;(]\S*))"

#: Endings behind a secret word that leave the name a secret's.
_ENDING = r"(?:[_\-.]?(?:\d{1,4}|v\d|prod|production|dev|test|qa|stage|staging|live|old|new|current|previous|prev|backup|main|primary|secondary|default|value|val|plain|text|clear|raw|b64|base64|admin|root|user|db|app|api|master|slave|replica|read|write|ro|rw))*"
_ASSIGN = re.compile(rf"(?i)(?<![\w\-.])(?P<key>{_WORD_AT}{_ENDING})(?![\w\-])\\?[\"'`]?\s*(?::=|=>|==?|[:：|])\s*{_VALUE}")
_STRING = re.compile(_QUOTED)
_KEYED = re.compile(rf"(?i)(?<![\w\-.])(?P<key>{_WORD_AT}[\w.\-]*)\\?[\"'`]?\s*(?::=|=>|==?|[:：|])\s*{_VALUE}")
#: A long token, and what a secret's key, if it has one, looks like before it.
_LONG = re.compile(r"[A-Za-z0-9+/_\-.~!@#$%^&*?=:\\]{16,}")
_KEY_BEFORE = re.compile(r"(?P<key>[\w.\-]{1,60})\\?[\"'`]?\s*(?::=|=>|==?|[:：|])\s*\\?[\"'`]?$")
_KEY_INSIDE = re.compile(r"(?P<key>[A-Za-z_][\w.\-]{0,59})(?::=|=>|==?|:)(?=[^=/])")
_SPOKEN = re.compile(rf"(?i)(?<![\w\-./$])(?:--)?(?:{SECRET_WORDS}|token)(?:\s+(?:is|ist|lautet|es|est|vaut|to)|为|是)?[\s:：]+(?:{_QUOTED}|(?P<bare>[^\s|<,;()]\S*))")
_SPOKEN_ZH = re.compile(r"(?:密码|口令|密钥|令牌)(?:为|是|：|:)?\s*(?P<bare>[^\s，。；、（）\u4e00-\u9fff\"'`_=:,.|<>{}\[\]][^\s，。；、（）\u4e00-\u9fff\"'`]*)")
#: A value that is named behind it.
_NAMED_AFTER = re.compile(rf"(?i)(?<![^\s\"'`(])[\"'`]?(?P<bare>[^\s\"'`]+)[\"'`]?\s+(?:as|als|como|comme)\s+(?:(?:the|your|das|ihr|la|su|le|votre)\s+)?(?:{SECRET_WORDS})\b|(?:用|以)\s*(?P<sq>[^\s\u4e00-\u9fff]+)\s*(?:作为|为|作)(?:密码|口令|密钥|令牌)")
_HEADER = re.compile(r"(?i)\b(?P<scheme>bearer|token|basic)\s+(?P<bare>[^\s\"'`\\<]+)")
_URL = re.compile(r"(?i)\b[a-z][a-z0-9+.\-]*://[^\s:/@\"'`]*:(?P<bare>[^\s\"'`/]+)@(?=[\w\[])")
_QUERY = re.compile(rf"(?i)(?:[?&;]|\b)(?:{_WORD_AT}|sig)=(?P<bare>[^&;\s\"'`,)]+)")
_SQL_SAYS = re.compile(r"(?i)\b(?:password|identified\s+by|passphrase|secret)\s+(?:E)?'(?P<sq>(?:[^'\n]|'')*)'")
_SET = re.compile(rf"(?i)\bset\s+\w+\s*=\s*'(?P<sq>(?:[^'\n]|'')*)'\s+where\s+\w+\s*=\s*'(?P<key>[^'\n]*)'")
_PAIR = re.compile(rf"(?i)(?:credentials?|log-?in|account|user|\b(?:dba|admin|root)\b|zugang|anmeldung|konto|compte|identifiants?|cuenta|acceso|登录|账号|帐号|用户)[^:：\n]{{0,20}}[:：]\s*[\w.\-@]+\s*/\s*(?P<bare>\S+)")
_SHORT = re.compile(r"(?:\bsshpass\s+-p\s*|\b(?:mysql|mysqldump|mysqladmin|mariadb)\b[^\n]*?\s-p|\b(?:docker|podman|az|helm)\b[^\n]*?\s-p\s+)(?:'(?P<sq>[^'\n]*)'|\"(?P<dq>[^\"\n]*)\"|(?P<bare>[^\s'\"]+))")
_USERPWD = re.compile(r"\bcurl\b[^\n]*?\s(?:-u|--user)\s*[\"']?[^\s:\"']+:(?P<bare>[^\s\"']+)")
_TAG = re.compile(rf"(?i)<(?P<key>[\w.\-]*(?:{SECRET_WORDS}))>(?P<bare>[^<\n]+)</")
_PGPASS = re.compile(r"^\s*[\w.\-*\[\]]+:(?:\d{2,5}|\*):[^:\s]+:[^:\s]+:(?P<bare>\S+)\s*$")
#: Forms of tokens that say themselves what they are.
_ISSUED = re.compile(
    r"(?<![\w/+\-])(?P<bare>(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|github_pat_\w{22,}|glpat-[\w\-]{20,}|xox[abeoprs]-[0-9A-Za-z\-]{20,}|sk-[A-Za-z0-9_\-]{20,}|"
    r"eyJ[A-Za-z0-9_\-]{8,}\.eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}|[A-Za-z]{2,12}_(?:live|test|sk|pk|prod)_[A-Za-z0-9_]{14,}|[a-z]{2,8}-key-[A-Za-z0-9]{16,}|AIza[\w\-]{35}|SG\.[\w\-]{16,}\.[\w\-]{16,})(?![\w/+])"
)
_COLUMNS = re.compile(r"(?i)\binsert\s+into\b[^(\n]*\((?P<names>[^)\n]*)\)")
_TUPLE = re.compile(r"(?i)(?:\bvalues\b\s*|^\s*)\((?P<row>(?:[^()'\n]|'(?:[^'\n]|'')*')*)\)")
_FIELD = re.compile(r"\s*(?:'(?P<sq>(?:[^'\n]|'')*)'|(?P<other>[^,']*))\s*(?:,|$)")
_NAMED = re.compile(rf"(?i)^\s*(?:-\s+)?[\"']?(?:name|key|parameter|variable|setting)[\"']?\s*[:=]\s*[\"']?(?P<key>[\w.\-]*(?:{SECRET_WORDS}))[\"']?,?\s*$")
_ITS_VALUE = re.compile(rf"(?i)^\s*(?:-\s+)?[\"']?(?:value|val|default)[\"']?\s*[:=]\s*{_VALUE}")

_PLACEHOLDER = re.compile(
    r"(?i)^(?:|null|nil|none|~|true|false|yes|no|n/a|tbd|undefined|\|[-+]?|>[-+]?|[*•·.xX#_\-?]+|"
    r"(?:secretref|vault|env|keyring|ssm|aws-sm|gcp-sm|file|op|ref|arn|kms|sops|pass|lookup|secret|secrets|akv|bw)(?::|://).*|"
    r".*(?:redacted|masked|placeholder|change[_\- ]?me|replace[_\- ]|your[_\- ]|[_\- ]here\b|example|dummy|insert[_\- ]|to[_\-]?be[_\-]|hidden|removed|sample|geheim|todo).*|"
    r"\$?\{.*\}[^}]*|\$\([^)]*(?:\).*|$)|\$[A-Za-z_]\w*|\$[A-Za-z_]\w*:.*|<[^<>]*>|\[[^\[\]]*\]|\([^()]*\)|%[A-Za-z_]\w*%|%\([^)]*\)s|&&?[A-Za-z_]\w*\.?|:'?\w+'?|@[A-Za-z_.]+@?|!(?:ref|sub|vault|env)\b.*|"
    r"(?:process\.env|os\.environ|getenv|System\.getenv|read_vault|get_secret|config|settings|secrets|vars?|self|this|env|data)[.\[(].*|(?-i:\.{0,2}/[a-z0-9_./\-]*)|https?://.*|ssh-(?:rsa|ed25519|dss).*|-----.*)$"
)
_SAME_END = re.compile(r"(?i)(?:([x*•0.\-_#])\1{5,}|abcdef1?|123456)")
_UUID = re.compile(r"(?i)[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}")
_HASH = re.compile(r"(?i)(?:sha\d+[-:]|md5[-:])?[0-9a-f]{7,128}")
_DATE_OR_NUMBER = re.compile(r"[\d.,:/\- +TZ%]+")
_BLOB = re.compile(r"(?i)^(?:data:|sha(?:1|256|384|512)[-:]|ssh-|AAAA[BCE])")

#: The alphabets that entropy is measured in, smallest first.
ALPHABETS = ((10, re.compile(r"[0-9]+")), (16, re.compile(r"[0-9a-f]+|[0-9A-F]+")), (32, re.compile(r"[A-Z2-7]+=*")), (36, re.compile(r"[0-9a-z]+")), (64, re.compile(r"[0-9A-Za-z+/_\-]+={0,2}")), (94, re.compile(r".*", re.S)))


def entropy(token: str) -> float:
    """Shannon entropy in bits a character."""
    n = len(token)
    return -sum(k / n * math.log2(k / n) for k in Counter(token).values()) if n else 0.0


def alphabet(token: str) -> int:
    return next(size for size, form in ALPHABETS if form.fullmatch(token))


def surprising(token: str, share: float) -> bool:
    """Entropy above ``share`` of the most that a token of this length can have in its alphabet."""
    return len(token) > 1 and entropy(token) >= share * math.log2(min(len(token), alphabet(token)))


#: The letters that follow each letter in words of the texts' Latin languages, and those of "qu".
_FOLLOW = {x[0]: frozenset(x[1:]) for x in (
    "abcdfgiklmnprstuvwxy babceijlorsuy cacdehiklmorstuy dabcdefilnorstu eabcdefgiklmnopqrstuvwxy faefilorstuy gaeghilnorsu haeilortu iabcdefgklmnoprstvxz "
    "jeu kaeils lacdeilopstuvy mabdeilmopsu nacdefgiklnoprstuvy oabcdefgiklmnoprstuvwx padehiloprstuy qu rabcdefgiklmnoprstuvwy "
    "sacdefghiklmnoprstuy tacdefhilmnoprstuwy uabcdefgilmnoprst vaeio waehinors xaceiptx yeilmnprst zaeio"
).split()}


def pronounceable(part: str, slack: int = 0) -> bool:
    """Letters only: whether they read like a word (usual pairs of letters, vowels among the consonants). ``slack``: so many unusual pairs more."""
    low = unicodedata.normalize("NFKD", part).encode("ascii", "ignore").decode().lower()
    if len(low) < 3:
        return True
    unusual = sum(b not in _FOLLOW[a] for a, b in zip(low, low[1:]))
    if slack and len(low) < 6:
        return unusual <= len(low) // 2
    return unusual <= len(low) // 8 + slack and 0.2 - 0.08 * slack <= len(re.findall("[aeiouy]", low)) / len(low) <= 0.8 and not re.search("[^aeiouy]{6}", low)


_CASED = re.compile(r"[A-ZÀ-Þ]?[a-zß-ÿ]{2,}|[A-ZÀ-Þ]{2,}(?![a-zß-ÿ])|[A-ZÀ-Þ]")
_PART = re.compile(r"[0-9a-f]{7,}(?![0-9A-Za-z])|[A-Za-zÀ-ÿ]+|[0-9]+")


def _worded(letters: str, slack: int = 0) -> bool:
    """Letters only: whether they are words with normal capitals (word, Word, WORD, wordWord)."""
    if letters.islower() or letters.isupper() or letters.istitle():
        return pronounceable(letters, slack)
    parts = _CASED.findall(letters)
    return "".join(parts) == letters and sum(len(x) < 3 for x in parts) <= len(parts) // 4 and all(pronounceable(x, slack) for x in parts)


def identifier(value: str) -> bool:
    """Whether a value is made of words, numbers and hexadecimal ids: names, paths, hosts, versions, slugs."""
    odd = whole = 0
    for run in re.findall("[0-9A-Za-zÀ-ÿ]+", value):
        whole += len(run)
        if re.fullmatch("(?=.*[0-9])[0-9a-f]{7,}|[0-9]+[A-Za-z]{0,3}", run):
            continue
        m = re.fullmatch("([A-Za-zÀ-ÿ]+)[0-9]*", run)
        if not m or (len(m[1]) > 2 and not _worded(m[1], 1)):
            odd += len(run)
    return odd < 0.3 * max(whole, 1)


def _clean(value: str, bare: bool) -> str:
    value = value.strip()
    if bare:
        value = value.rstrip(",;\r").rstrip("\"'`")
        for left, right in ("()", "[]", "{}"):
            if left not in value:
                value = value.rstrip(right).rstrip("\"'`")
    return value


def _kinds(value: str) -> int:
    return sum(bool(re.search(c, value)) for c in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]"))


def usable(value: str, how: str) -> bool:
    """Whether a candidate is a usable secret; ``how`` it was introduced: named, spoken, hinted (by a name with a secret word in it) or alone."""
    least = 6 if how == "named" else 8
    if len(value) < least or (how != "named" and " " in value) or _PLACEHOLDER.match(value) or _SAME_END.search(value):
        return False
    if _DATE_OR_NUMBER.fullmatch(value) or _BLOB.match(value) or any("\u4e00" <= c <= "\u9fff" for c in value):
        return False
    if how in ("alone", "hinted"):
        # the less stands around a value, the nearer to the most that its length allows its entropy must come
        if not value.isascii() or " " in value or _UUID.search(value) or _HASH.fullmatch(value) or "://" in value or identifier(value):
            return False
        if how == "hinted":
            return surprising(value, 0.7)
        return (_kinds(re.sub("[^0-9A-Za-z]", "", value)) >= 2 or len(value) >= 16) and surprising(value, 0.82 if len(value) >= 20 else 0.88 if len(value) >= 12 else 0.95)
    slack = 1 if how == "spoken" or " " in value else 0  # prose goes on behind a spoken name
    if re.fullmatch(r"[A-Za-zÀ-ÿ]+(?:[ _.\-/:][A-Za-zÀ-ÿ]+)*[.,!?:]?", value) and all(_worded(x, slack) for x in re.findall("[A-Za-zÀ-ÿ]+", value)):
        return how == "named" and bool(re.fullmatch(r"[A-Za-z]{12,}", value)) and bool(re.search("[a-z][A-Z].*[a-z][A-Z]", value)) and surprising(value, 0.8)
    if how == "spoken" and not (re.search("[0-9]", value) or _kinds(value) >= 3) and (not value.isascii() or identifier(value)):
        return False
    return surprising(value, 0.62)


def _value(m: re.Match) -> tuple[str, int, int]:
    """The candidate in a match and where it stands in the line."""
    g = m.groupdict()
    name = next(k for k in ("dq", "sq", "bq", "bare") if g.get(k) is not None)
    value = _clean(g[name], name == "bare")
    at = m.start(name) + (len(g[name]) - len(g[name].lstrip()))
    return value, at, at + len(value)


def _decoded(value: str) -> str:
    try:
        return base64.b64decode(value + "=" * (-len(value) % 4), validate=True).decode("utf-8")
    except (ValueError, binascii.Error):
        return ""


def _secret_name(key: str) -> bool:
    return not OTHER_NAMES.search(key)


_ARMOUR = re.compile(r"-----BEGIN .*?(?:-----END [^\n]*|$)")
_PEM_LINE = re.compile(r"[\s>|#\"'*]*(?:-----(?:BEGIN|END) .*|(?:[A-Za-z0-9+/]{64}|[A-Za-z0-9+/]{70}|[A-Za-z0-9+/]{72}|[A-Za-z0-9+/]{76}))[\s\\\"'+,]*")
_WHOLE = re.compile(r"[\s>|#\"'*]*[A-Za-z0-9+/]{4,76}={0,2}[\s\\\"'+,]*")
_BLOB_BEFORE = re.compile(r"(?i)(?:base64,|ssh-[a-z0-9]+ |ecdsa-sha2-\S+ |sha(?:1|256|384|512)[-:= ]|md5[-:= ])[A-Za-z0-9+/=]*$")
_GOES_ON = re.compile(r"[\"'`]\s*[+.\\&]?\s*$")
_HAS_SECRET = re.compile(rf"(?i)(?:{SECRET_WORDS})")
#: Names with a secret word in them that name something about the secret.
_ABOUT = re.compile(r"(?i)(?:ttl|file|path|dir|url|uri|host|name|id|hash|hashed|policy|age|length|len|size|count|limit|type|mode|alg|algorithm|format|version|date|time|expiry|expires|rotation|hint|field|column|label|ref|min|max|user|digest|fingerprint)s?$")


def loose(line: str, before: str, after: str) -> Iterator[tuple[int, int]]:
    """Spans of the quoted strings and long tokens that are secrets by themselves; a name before them only moves the threshold."""
    if _WHOLE.fullmatch(line) and (_PEM_LINE.fullmatch(before) or _PEM_LINE.fullmatch(after)):
        return  # a line of an armoured block: those of private keys are found as blocks, others are public
    text = _ARMOUR.sub(lambda m: " " * len(m[0]), line) if "-----" in line else line
    spans = []
    for m in _STRING.finditer(text):
        value, a, b = _value(m)
        spans.append((value, a, b))
    for m in _LONG.finditer(text):
        a, token = m.start(), m[0]
        at = 0  # names before the value, escapes and what ends a sentence are no part of it
        if "://" in token:  # who may enter is said before the host, what for behind it
            at = min([x for x in (token.find(c, token.index("://") + 3) for c in "/?") if x >= 0], default=len(token))
        else:
            for k in _KEY_INSIDE.finditer(token):
                at = k.end()
        for part in re.finditer(r"[^/?&=#\\]+" if at and "://" in token else r"[^\\]+", token[at:]):
            value = part[0] if part.start() == 0 or token[at + part.start() - 1] != "\\" else part[0][1:]
            start = a + at + part.end() - len(value)
            value = value.rstrip(".,:;!?")
            if len(value) >= 16:
                spans.append((value, start, start + len(value)))
    spans += [_value(m) for m in _KEYED.finditer(text)]
    for value, a, b in spans:
        lead = text[:a]
        if _BLOB_BEFORE.search(lead) or (_GOES_ON.search(before) and not lead.strip(" \t\"'`")):
            continue  # data, or the rest of a string that began on the line above
        key = m["key"] if (m := _KEY_BEFORE.search(lead)) else ""
        if key and PLAIN_NAMES.search(key):
            continue
        hinted = key and _HAS_SECRET.search(key) and _secret_name(key) and not _ABOUT.search(key)
        if usable(value, "hinted" if hinted else "alone"):
            yield a, b


def candidates(line: str, before: str, after: str = "") -> Iterator[tuple[int, int]]:
    """Spans of the usable secrets in a line; ``before`` and ``after`` are the lines around it."""
    for m in _ISSUED.finditer(line):
        value, a, b = _value(m)
        if not _SAME_END.search(value) and surprising(value, 0.62):
            yield a, b
    for m in _ASSIGN.finditer(line):
        value, a, b = _value(m)
        if _secret_name(m["key"]) and usable(value, "named"):
            yield a, b
    for pattern in (_SPOKEN, _SPOKEN_ZH, _NAMED_AFTER):
        for m in pattern.finditer(line):
            value, a, b = _value(m)
            value = value.rstrip(".。")
            if usable(value, "spoken"):
                yield a, a + len(value)
    for m in _HEADER.finditer(line):
        value, a, b = _value(m)
        secret = _decoded(value).partition(":")[2] if m["scheme"].lower() == "basic" else value
        if usable(secret, "spoken"):
            yield a, b
    for pattern in (_URL, _QUERY, _SQL_SAYS, _SHORT, _USERPWD, _TAG, _PGPASS, _PAIR):
        for m in pattern.finditer(line):
            value, a, b = _value(m)
            if usable(value, "named"):
                yield a, b
    for m in _SET.finditer(line):
        value, a, b = _value(m)
        if re.search(rf"(?i)(?:{SECRET_WORDS})$", m["key"]) and _secret_name(m["key"]) and usable(value, "named"):
            yield a, b
    if (named := _NAMED.match(before)) and (m := _ITS_VALUE.match(line)):
        value, a, b = _value(m)
        if _secret_name(re.sub("(?i)^.*?name$", "", named["key"])) and usable(value, "named"):
            yield a, b
    if (columns := _COLUMNS.search(line) or _COLUMNS.search(before)) and (row := _TUPLE.search(line, columns.end() if columns.string is line else 0)):
        fields = [m for m in _FIELD.finditer(row["row"]) if m[0]]
        for name, field in zip(columns["names"].split(","), fields, strict=False):
            if field["sq"] is not None and re.search(rf"(?i)(?:{SECRET_WORDS})$", name.strip(" \"`'")) and _secret_name(name) and usable(field["sq"], "named"):
                yield row.start("row") + field.start("sq"), row.start("row") + field.end("sq")
    yield from loose(line, before, after)


#: Of these, in small letters, or of quoted strings, long tokens and rows a line must hold one to hold a candidate.
_HINTS = tuple(
    "pass|pwd|pw|wort|zugang|secret|token|bearer|basic|credential|auth|code|key|mdp|contrase|clave|parola|senha|密码|口令|密钥|令牌|暗号|login|登录|账号|帐号|用户|account|user|anmeldung|konto|compte|identifiant|cuenta|acceso|"
    "://|?sig=|&sig=|;sig=|-p|-u |identified|set |values|val|default|dba|admin|root|akia|asia|ghp_|gho_|ghu_|ghs_|ghr_|github_pat_|glpat|xox|sk-|eyj|_live_|_test_|_sk_|_pk_|_prod_|aiza|sg.".split("|")
)
_LONG_PART = re.compile(r"[A-Za-z0-9+/_\-.~!@#$%^&*?=:]{16}|[\"'`][^\s\"'`]{8}|^[^\S\n]*\('|^[^\S\n]*[^\s:]+:[0-9*]+:[^\s:]+:", re.M)


@lru_cache
def _hint_words() -> ahocorasick.Automaton:
    words = ahocorasick.Automaton()
    for w in _HINTS:
        words.add_word(w, w)
    words.make_automaton()
    return words


def _lower(text: str) -> str:
    """Small letters, each in the place of its capital."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def line_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """(line, start, end) of the secrets of a text, ``start`` and ``end`` from the beginning of the text; without the blocks of private keys."""
    lines, begin = text.split("\n"), [0]
    for x in lines:
        begin.append(begin[-1] + len(x) + 1)
    hits = {bisect_right(begin, at) - 1 for at, _ in _hint_words().iter(_lower(text))}
    hits |= {bisect_right(begin, m.start()) - 1 for m in _LONG_PART.finditer(text)}
    for i in sorted(hits):
        for a, b in sorted(set(candidates(lines[i], lines[i - 1] if i else "", lines[i + 1] if i + 1 < len(lines) else ""))):
            yield i + 1, begin[i] + a, begin[i] + b


_BEGIN = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
_MARKER = re.compile(r"-----(BEGIN|END) ((?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)-----")
_MATERIAL = re.compile(r"[A-Za-z0-9+/]{16,}={0,2}")
#: A line in the text or in a string with escaped ends of lines, without what may stand around it.
_LINE = re.compile(r"\\[rn]|((?:(?!\\[rn])[^\n])+)")
_AROUND = " \t\r|>\"'#;,\\"
_KEY_LINE = re.compile(r"[A-Za-z0-9+/]+={0,2}|=[A-Za-z0-9+/]{4}")


def _key_lines(text: str) -> list[tuple[int, int, bool]]:
    """Lines that are not blank: where they begin and end, and whether they are of base64 alone."""
    out = []
    for m in _LINE.finditer(text):
        line = re.sub("[\"']\\s*\\+\\s*$", "", m[1] or "").strip(_AROUND)
        if line:
            a = m.start() + m[0].index(line)
            out.append((a, a + len(line), bool(_KEY_LINE.fullmatch(line))))
    return out


def _material(text: str) -> Iterator[tuple[int, int]]:
    """Spans of key material in a block: lines of any length, and long runs within other lines."""
    for a, b, whole in _key_lines(text):
        if whole:
            yield a, b
        else:
            yield from ((a + m.start(), a + m.end()) for m in _MATERIAL.finditer(text[a:b]))


def _material_before(head: str) -> int:
    """Where the material begins that runs up to the end of ``head``; its length if there is none."""
    first, last = len(head), True
    for a, b, whole in reversed(_key_lines(head)):
        line = head[a:b]
        if not whole:
            # of a line with something else before the material, as much as is long
            tail = next((m for m in _MATERIAL.finditer(line) if m.end() == len(line)), None)
            return a + tail.start() if tail else first
        if line[0] == "=":
            continue  # the checksum; the material stands above
        # within a block lines are long; only the last one and one that the text begins in may be short
        if b - a < 16 and a > len(head) - len(head.lstrip(_AROUND + "\n")) and not (last and (b - a) % 4 == 0):
            return first
        first, last = a, False
    return first


def inside(text: str) -> bool:
    """Whether a text may be the middle of a key: nothing but lines of base64, long ones between the first and the last, of high entropy."""
    lines = _key_lines(text)
    solid = "".join(text[a:b] for a, b, _ in lines)
    return bool(lines) and all(w for *_, w in lines) and all(b - a >= 40 for a, b, _ in lines[1:-1]) and len(solid) >= 16 and surprising(solid, 0.85)


def key_blocks(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the material of private keys, from the first marker or, if the text starts inside a block, from the first line of material."""
    open_at = None
    for m in _MARKER.finditer(text):
        if m[1] == "BEGIN":
            open_at = m.start() if open_at is None else open_at
            continue
        if open_at is None:
            first = _material_before(text[: m.start()])
            if first < m.start():
                yield first, m.end()
        else:
            yield open_at, m.end()
        open_at = None
    if open_at is not None:
        rest = text[open_at:]
        end = max([0, *(b for _, b in _material(rest))])
        yield open_at, open_at + max(end, rest.find("-----", 11) + 5)


def text_spans(text: str | None) -> list[tuple[int, int, int, bool]]:
    """(line, start, end, block) of all secrets of a text."""
    if not text:
        return []
    found = [(*x, False) for x in line_spans(text)]
    if "PRIVATE KEY" in text:
        found += [(text.count("\n", 0, a) + 1, a, b, True) for a, b in key_blocks(text)]
    return found


_SPANS = T.ArrayType(T.StructType([*(T.StructField(x, T.IntegerType()) for x in ("line_no", "start", "end")), T.StructField("block", T.BooleanType())]))


@F.pandas_udf(_SPANS)
def _spans(text: pd.Series) -> pd.Series:
    return pd.Series([[{"line_no": n, "start": a, "end": b, "block": k} for n, a, b, k in text_spans(t)] for t in text], dtype=object)


_STATE = T.StructType([T.StructField(x, T.BooleanType()) for x in ("begins_in", "stays_open", "middle")])


@F.pandas_udf(_STATE)
def _state(text: pd.Series) -> pd.DataFrame:
    """Of each text: whether its first marker of a private key ends one, whether its last one begins one, and whether it may be the middle of one."""
    rows = []
    for t in text:
        marks = [m[1] for m in _MARKER.finditer(t)]
        rows.append((bool(marks) and marks[0] == "END", bool(marks) and marks[-1] == "BEGIN", not marks and inside(t)))
    return pd.DataFrame(rows, columns=["begins_in", "stays_open", "middle"])


#: Where a chunk stands in its file.
PLACE = ("source", "file_hash", "chunk_index")


def _may_be_middle(text: Column) -> Column:
    """Whether a text holds nothing but lines of base64."""
    return F.coalesce(text.rlike(r"[A-Za-z0-9+/]{16}") & text.rlike(r"\A[A-Za-z0-9+/=\s|>\"'#;,\\]+\z"), F.lit(False))


def middles(chunks: DataFrame, key: str, text: str) -> DataFrame:
    """Spans (as of blocks) of the chunks that are the middle of a private key: nothing but material, and the chunks before them
    in the file, one after the other, lead to a marker that begins a key or those behind them to one that ends it."""
    rows = chunks.select(F.col(key).alias("_key"), F.col(text).alias("_text"), *PLACE)
    rows = rows.where(F.col("_text").contains("PRIVATE KEY") | _may_be_middle(F.col("_text")))
    rows = rows.select("_key", *PLACE, F.length("_text").alias("_length"), F.regexp_extract("_text", r"\A([\s|>\"'#;,]*)", 1).alias("_blank"), _state("_text").alias("_s")).where("_s.middle or _s.stays_open or _s.begins_in")
    # the rows are few: those with a marker of a private key or of base64 alone
    file = Window.partitionBy("source", "file_hash")
    rows = rows.withColumn("_run", F.col("chunk_index") - F.dense_rank().over(file.orderBy("chunk_index")))
    run = Window.partitionBy("source", "file_hash", "_run").orderBy("chunk_index")
    before = F.last(F.when(~F.col("_s.middle"), F.col("_s.stays_open")), ignorenulls=True).over(run.rangeBetween(Window.unboundedPreceding, -1))
    behind = F.first(F.when(~F.col("_s.middle"), F.col("_s.begins_in")), ignorenulls=True).over(run.rangeBetween(1, Window.unboundedFollowing))
    found = rows.withColumn("_before", before).withColumn("_behind", behind).where("_s.middle and coalesce(_before, _behind, false)")
    line = (F.length("_blank") - F.length(F.regexp_replace("_blank", "\n", "")) + 1).cast("int")
    return found.select("_key", line.alias("line_no"), F.length("_blank").alias("start"), F.col("_length").alias("end"), F.lit(True).alias("block"))


def find_credentials(chunks: DataFrame, key: str = "chunk_id", text: str = "text") -> DataFrame:
    """Spans of secrets: ``key``, ``line_no`` on which one begins (from 1), ``start`` and ``end`` in the text, and whether it is key material (``block``).

    Null, empty and blank texts have none. Repeated rows give repeated results. Of the other columns those of ``PLACE`` are used if all of
    them are there: they tell whether a chunk without any marker is the middle of a private key.
    """
    slim = chunks.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(F.length("_text") > 0)
    found = slim.select("_key", F.inline(_spans("_text")))
    if set(PLACE) <= set(chunks.columns):
        found = found.unionByName(middles(chunks, key, text))
    return found.withColumnRenamed("_key", key)


def credential_lines(chunks: DataFrame, key: str = "chunk_id", text: str = "text") -> DataFrame:
    """``key`` and ``line_no``: each line on which a secret begins, once."""
    return find_credentials(chunks, key, text).select(key, "line_no").distinct()


def masked_text(text: str, spans: list[tuple[int, int, bool]], sign: str) -> str:
    """A text with the letters, digits and other signs of its secrets replaced; white space, quotes and escapes stay, and of blocks all but their material."""
    signs = list(text)
    for a, b, block in spans:
        parts = [(a + p, a + q) for p, q in _material(_MARKER.sub(lambda k: " " * len(k[0]), text[a:b]))] if block else [(a, b)]
        for p, q in parts:
            for x in range(p, q):
                if not signs[x].isspace() and signs[x] not in "\"'\\" and (x == 0 or text[x - 1] != "\\"):
                    signs[x] = sign
    return "".join(signs)


def mask(chunks: DataFrame, key: str = "chunk_id", text: str = "text", sign: str = "x") -> DataFrame:
    """``key``, ``masked`` text and ``n_secrets`` of every row: each secret's signs are replaced one by one, so that lines, quotes
    and lengths stay and the text means what it did to a parser. Null text stays null. ``key`` must identify a row.

    A row is masked where it is read; only those of nothing but base64 are joined with the others of their files.
    """

    @F.pandas_udf("masked string, n_secrets int")
    def hide(texts: pd.Series, more: pd.Series) -> pd.DataFrame:
        out = []
        for t, middle in zip(texts, more, strict=True):
            spans = [(a, b, k) for _, a, b, k in text_spans(t)] + [(s["start"], s["end"], s["block"]) for s in (middle if middle is not None else ())]
            out.append((masked_text(t, spans, sign) if spans else t, len(spans)))
        return pd.DataFrame(out, columns=["masked", "n_secrets"])

    placed = set(PLACE) <= set(chunks.columns)
    rows = chunks.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    nothing = F.lit(None).cast("array<struct<start:int,end:int,block:boolean>>")
    if not placed:
        rows = rows.withColumn("_more", nothing)
    else:
        found = middles(chunks, key, text).groupBy("_key").agg(F.collect_list(F.struct("start", "end", "block")).alias("_more"))  # one a row
        solid = rows.where(_may_be_middle(F.col("_text"))).join(found, "_key", "left")
        rows = rows.where(~_may_be_middle(F.col("_text"))).withColumn("_more", nothing).unionByName(solid)
    return rows.select(F.col("_key").alias(key), hide("_text", "_more").alias("_x")).select(key, "_x.masked", "_x.n_secrets")

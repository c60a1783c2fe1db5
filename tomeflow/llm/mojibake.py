"""Text that was decoded with another encoding than it was written in: which rows hold some, and their original.

A *chain* says what happened to a token (a stretch without white space that holds a character beyond ASCII):
nothing, or written in one encoding and read in another, possibly twice. Undoing a chain gives the token as it
was written, and a character model of the corpus says how likely that is. Expectation-maximization then shares
the evidence: the weight of each chain is learned for every pool (a source and its kind of file), together with
the weights over the whole corpus, and the character model is learned again from the text as the posterior sees
it. A token counts as garbled, and is repaired, by its posterior.

The first pass over the texts counts characters, the second undoes every token and keeps those that some weight
of the chains could make garbled; no list of characters decides. Of the texts nothing else is shuffled. Only the
character model, bounded by the number of code points and character classes, is sent to the tasks.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomeflow.functions.durable import stored

#: Encodings, by the names that Python gives them.
SINGLE_BYTE = ("cp1252", "mac_roman", "cp1250", "cp1251", "cp1253", "cp437", "cp850", "koi8_r", "iso8859_2", "iso8859_15")
MULTI_BYTE = ("gbk", "cp950", "cp932", "euc_kr")
#: (read as, written as) where both are single-byte encodings.
SINGLE_PAIRS = (("mac_roman", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1250", "cp1252"), ("cp1251", "cp1252"), ("koi8_r", "cp1252"), ("cp1253", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "cp437"), ("cp1252", "cp1251"), ("cp1252", "koi8_r"))
#: (read as, written as) of East Asian encodings.
MULTI_PAIRS = (("cp1252", "gb18030"), ("cp1252", "cp950"), ("cp1252", "cp932"), ("cp1252", "euc_kr"), ("mac_roman", "gb18030"), ("cp1251", "gb18030"), ("cp950", "gb18030"), ("gbk", "cp950"), ("cp932", "gb18030"), ("euc_kr", "gb18030"), ("gbk", "cp932"), ("gbk", "euc_kr"))

#: Weight of each garbling chain before anything is known, of all garbling chains together by the recorded status, and the
#: number of corpus tokens that the corpus weights count for in a source.
PRIOR_GARBLED, PRIOR_IF_RECORDED, POOLED = 0.02, 0.2, 3.0
ROUNDS = 3
#: Parts that the rows of a pool are spread over.
PARTS = 8
#: The posterior from which on a token counts as garbled.
SURE = 0.7
#: A chain whose log-likelihood is so far below that of the text as it stands, or of another chain, is out of the question: the
#: weights of a pool of 10^12 tokens differ by less than 28, the rest is room for the model to change.
MARGIN = 36.0
#: Log-likelihood of a character that nobody writes: it stands for what got lost.
GONE = -16.0

#: White space is that of ASCII, for Spark and for Python alike.
_SPACED = r"[^\t-\r ]+"
_TOKEN = re.compile(r"(?<![^\t-\r ])[\x00-\x08\x0e-\x1f!-\x7f]*[^\x00-\x7f][^\t-\r ]*")
_UTF8 = re.compile("(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})+")
_DOUBLE = re.compile("(?:[\xa1-\xfe][\xa1-\xfe]){2,}|(?<![\\w\xa1-\xfe])[\xa1-\xa9][\xa1-\xfe](?![\\w\xa1-\xfe])")
_HIGH = re.compile("[\x80-￿]+")
_BEYOND = re.compile(r"[^\x00-\x7F]+")
_LOST = re.compile("�|锟斤|斤拷|锟拷|ï¿½|烫烫烫|屯屯屯")


@lru_cache
def _bytes_of(encoding: str) -> dict[int, str]:
    """Characters to bytes, the bytes written as characters up to U+00FF. Bytes that the encoding leaves open are control characters."""
    table = {b: chr(b) for b in range(0x80, 0xA0)}
    for b in range(0x80, 0x100):
        try:
            table[ord(bytes([b]).decode(encoding))] = chr(b)
        except UnicodeDecodeError:
            table[b] = chr(b)
    return table


class _Blank(dict):
    """Characters outside of a table become a sign that is no byte."""

    def __missing__(self, key: int) -> str | int:
        self[key] = found = key if key < 0x80 else "￿"
        return found


@lru_cache
def _table(encoding: str) -> _Blank:
    return _Blank(_bytes_of(encoding))


@lru_cache
def _members(encoding: str, lead: str) -> re.Pattern:
    """Whether a text holds, next to each other, a lead byte and a trailing byte of an encoding read as this one."""
    chars = defaultdict(str)
    for c, b in _bytes_of(encoding).items():
        chars["tail" if "\x80" <= b <= "\xbf" else "lead"] += re.escape(chr(c))
        if b >= "\xa1":
            chars["double"] += re.escape(chr(c))
    return re.compile(f"[{chars['lead']}][{chars['tail']}]" if lead == "utf8" else f"[{chars['double']}]{{2}}")


def _restore(pattern: re.Pattern, written: str, text: str, raw: str) -> str:
    """``text`` with every stretch of ``raw`` (the same positions, as bytes) that is valid in the encoding it was written in decoded."""
    out, at = [], 0
    for m in pattern.finditer(raw):
        try:
            good = m[0].encode("latin-1").decode(written)
        except UnicodeDecodeError:
            continue
        out += [text[at : m.start()], good]
        at = m.end()
    return "".join([*out, text[at:]]) if out else text


def _from_utf8_single(text: str, read: str) -> str:
    return _restore(_UTF8, "utf-8", text, text.translate(_table(read))) if _members(read, "utf8").search(text) else text


def _from_multi_single(text: str, read: str, written: str) -> str:
    return _restore(_DOUBLE, written, text, text.translate(_table(read))) if _members(read, "double").search(text) else text


#: What runs that an East Asian encoding read may have been written in.
WRITTEN = {read: ("utf-8", *(w for r, w in MULTI_PAIRS if r == read)) for read in MULTI_BYTE}
#: Lead bytes of the frequent characters, punctuation and letters of each East Asian encoding.
_FREQUENT = {w: re.compile(f"(?:[\x00-\x7f]|{p})+") for w, p in {
    "gb18030": "[\xa1-\xa3\xb0-\xd7][\xa1-\xfe]",
    "gbk": "[\xa1-\xa3\xb0-\xd7][\xa1-\xfe]",
    "cp950": "[\xa1-\xc6][\x40-\x7e\xa1-\xfe]",
    "cp932": "[\x81-\x83\x88-\x97][\x40-\xfc]",
    "euc_kr": "[\xa1-\xa3\xb0-\xc8][\xa1-\xfe]",
}.items()}
#: The letters of the texts' languages that are written in one byte, by that byte's encodings, and the marks that stand beside words in correct text.
_LETTERS_OF = {"cp1252": "äöüßÄÖÜàâçéèêëîïôùûÿœæáíóúñÀÂÇÉÈÊËÎÏÔÙÛŒÆÁÍÓÚÑ"}
_BESIDE = "‘’“”„‚–—…«»°§£€¡¿¢´¨·\xa0\xad"


@lru_cache
def _produced() -> tuple[str, str]:
    """What the listed pairs make of those letters: signs that are odd beside a letter, and marks that are odd only between two."""
    made = set()
    for read, written in SINGLE_PAIRS:
        for c in _LETTERS_OF["cp1252"]:
            try:
                raw = c.encode(written)
            except UnicodeEncodeError:
                continue
            made |= {k for k, b in _bytes_of(read).items() if b.encode("latin-1") == raw and chr(k) != c}
    chars = {chr(k) for k in made if k >= 0x80}
    return "".join(sorted(chars - set(_BESIDE))), "".join(sorted(chars & set(_BESIDE)))


def _odd_signs() -> str:
    """A regular expression: a sign that a single-byte pair may have made, in or at a word, or any that is no letter or usual punctuation inside of one."""
    near, between = ("".join(f"\\u{ord(c):04x}" for c in x) for x in _produced())
    return (
        "[A-Za-z][^\\u0000-\\u007f\\u00c0-\\u024f’‘“”„–—…«»°€\\u00a0\\u00ad\\u3000-\\u303f\\u4e00-\\u9fff\\uff00-\\uffef\\ufffd][A-Za-z]|"
        f"[A-Za-z][{near}]|[{near}][A-Za-z]|[A-Za-z\\u00c0-\\u00ff][{between}][A-Za-z\\u00c0-\\u00ff]|[\\u00a3\\u00a8\\u00b3\\u00b8\\u00c0-\\u00ff]{{2}}"
    )


_ODD = re.compile(_odd_signs())


@lru_cache
def _pair(read: str, written: str) -> dict[int, str]:
    """Characters as one single-byte encoding read them to what they were written as in another; U+FFFF for what nobody wrote."""
    return {k: v if (v := b.encode("latin-1").decode(written, "replace")) != "\ufffd" else "￿" for k, b in _bytes_of(read).items() if k >= 0x80}


def _from_single_single(text: str, read: str, written: str) -> str:
    back = text.translate(_pair(read, written))
    return text if "￿" in back else back


def _undone_run(read: str, written: str, run: str, raw: bytes) -> str:
    """A run beyond ASCII that an East Asian encoding read, decoded as what it was written in, or as it stands."""
    if written == "utf-8":
        kept = len(raw.decode("utf-8", "ignore").encode())
        return raw.decode("utf-8", "replace").replace("?", "\ufffd") if kept > raw.count(b"?") and kept * 4 >= 3 * len(raw) else run
    if b"?" in raw:
        return run
    chars = raw.decode("latin-1")
    # what is restored must consist of frequent characters, and a longer run that does so already is taken as it is
    if not _FREQUENT[written].fullmatch(chars) or read != "cp950" and len(run) > 1 and _FREQUENT[read].fullmatch(chars):
        return run
    try:
        return raw.decode(written)
    except UnicodeDecodeError:
        return run


def _from_multi(text: str, read: str) -> Iterator[tuple[str, str]]:
    """(written as, original) by every encoding that runs beyond ASCII may have been written in."""
    parts = _BEYOND.split(text)
    runs = [(r, r.encode(read, "replace")) for r in _BEYOND.findall(text)]
    for written in WRITTEN[read]:
        back = [_undone_run(read, written, r, raw) for r, raw in runs]
        if any(b != r for b, (r, _) in zip(back, runs, strict=True)):
            yield written, "".join(x for pair in zip(parts, [*back, ""], strict=True) for x in pair)


_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ°’“”„–…€«»¿¡§ß]+")
_IN_WORD = re.compile("[A-Za-z][\u4e00-\u9fff\ue000-\uf8ff]|[\u4e00-\u9fff\ue000-\uf8ff][a-z]|^[\u4e00-\u9fff]$")


def _from_latin_multi(text: str, read: str) -> str:
    """Single characters of an East Asian encoding inside of Latin words, which took the letter after them along."""

    def undo(m: re.Match) -> str:
        raw = m[0].encode(read, "replace")
        back = raw.decode("cp1252", "replace")
        return back if len(m[0]) <= 2 and _LATIN.fullmatch(back) else m[0]

    return _BEYOND.sub(undo, text)


def _low_steps() -> list[tuple[str, object]]:
    out = [(f"{read}<utf-8", lambda t, r=read: _from_utf8_single(t, r)) for read in SINGLE_BYTE]
    return out + [(f"{r}<{w}", lambda t, r=r, w=w: _from_multi_single(t, r, w)) for r, w in MULTI_PAIRS if r in SINGLE_BYTE]


#: What can be undone by characters below the East Asian scripts.
LOW = _low_steps()
ODD = [(f"{r}<{w}", lambda t, r=r, w=w: _from_single_single(t, r, w)) for r, w in SINGLE_PAIRS]
_HAS_LOW, _HAS_HIGH = re.compile("[\x80-\u2e7f]"), re.compile("[\u2e80-\U0010ffff]")


def _undo(text: str, again: bool = False) -> Iterator[tuple[str, str]]:
    """(chain, original) by every chain of one step; only those that were written as UTF-8 if it is a second one."""
    low, high = _HAS_LOW.search(text), _HAS_HIGH.search(text)
    for name, undo in LOW if low else ():
        if not again or name.endswith("<utf-8"):
            yield name, undo(text)
    for read in MULTI_BYTE if high else ():
        yield from ((f"{read}<{w}", back) for w, back in _from_multi(text, read) if not again or w == "utf-8")
    if again:
        return
    if high and _IN_WORD.search(text):
        yield from ((f"{read}<cp1252", _from_latin_multi(text, read)) for read in MULTI_BYTE)
    if _ODD.search(text):
        yield from ((name, undo(text)) for name, undo in ODD)


def originals(token: str) -> dict[str, str]:
    """What the token was, by each chain that can be undone and changes it. Of chains that give the same text the first is named."""
    found: dict[str, str] = {}
    known = {token}
    for name, back in _undo(token):
        if back not in known:
            known.add(back)
            found[name] = back
    for name, back in [*found.items()]:
        if name.endswith("<utf-8") and _HAS_LOW.search(back):
            for again, further in _undo(back, again=True):
                if further not in known:
                    known.add(further)
                    found[f"{again} {name}"] = further
    return found


# -- the character model -------------------------------------------------------------------------------------

_SCRIPTS = ((0x41, 0x5A, "A"), (0x61, 0x7A, "a"), (0x30, 0x39, "0"), (0x80, 0x9F, "C"), (0xC0, 0xDE, "L"), (0xDF, 0x24F, "l"), (0x370, 0x3FF, "G"), (0x400, 0x52F, "R"), (0x3040, 0x30FF, "J"), (0x3100, 0x312F, "B"), (0x4E00, 0x9FFF, "H"), (0xAC00, 0xD7AF, "K"), (0xFF61, 0xFF9F, "W"), (0xE000, 0xF8FF, "P"), (0x1E00, 0x1EFF, "v"))


def script(c: str) -> str:
    """The class of a character that the next one is conditioned on."""
    n = ord(c)
    if n < 0x80 and not c.isalnum():
        return "."
    return next((k for a, b, k in _SCRIPTS if a <= n <= b), "o" if n < 0x2000 else "S")


_CLASS: dict[str, str] = {}


class Model:
    """P(character | class of the one before), smoothed towards P(character)."""

    def __init__(self, counts: dict[tuple[str, str], float]) -> None:
        single: Counter[str] = Counter()
        classes: Counter[str] = Counter()
        for (before, c), n in counts.items():
            single[c] += n
            classes[before] += n
        self.counts, self.classes, self.single = counts, classes, single
        self.total = sum(single.values())
        self.after: dict[str, dict[str, tuple[float, dict]]] = defaultdict(dict)

    def log(self, before: str, c: str) -> float:
        if c == "\ufffd" or "\ue000" <= c <= "\uf8ff" or c >= "\U000e0000":
            return GONE
        # the rest of the mass is spread over the code points that were never seen
        alone = (self.single[c] + 0.05) / (self.total + 0.05 * 150_000)
        return math.log((self.counts.get((before, c), 0.0) + 20 * alone) / (self.classes[before] + 20))

    def score(self, text: str, floor: float = -math.inf) -> float:
        """Log-likelihood of a text; some value under ``floor`` as soon as it is under it."""
        known, out = self.after["."], 0.0
        for c in text:
            if (step := known.get(c)) is None:
                before = next(k for k, v in self.after.items() if v is known)
                step = known[c] = (self.log(before, c), self.after[script(c)])
            out += step[0]
            if out < floor:
                return out
            known = step[1]
        return out + self.log(script(text[-1]) if text else ".", " ")


def _counted(rows: Iterator[tuple[str, float]]) -> Counter:
    out: dict[tuple[str, str], float] = {}
    classes = _CLASS
    for token, n in rows:
        before = "."
        for c in token:
            if c != "\ufffd":
                out[before, c] = out.get((before, c), 0.0) + n
            if (before := classes.get(c)) is None:
                before = classes[c] = script(c)
        out[before, " "] = out.get((before, " "), 0.0) + n
    return Counter(out)


# -- the operator --------------------------------------------------------------------------------------------

#: Characters of tokens that a task holds from one batch to the next.
HELD = 10_000_000
#: What a worker knows of tokens, by run: tasks that follow each other in one process share it.
_DOUBTS: dict[str, dict[str, bool]] = {}


def _tokens(text: str) -> set[str]:
    return set(_TOKEN.findall(text))


def _slim(chunks: DataFrame) -> DataFrame:
    """(chunk_id, pool, source, text) of the rows beyond ASCII; hashes stand for the pool and the source."""
    kind = F.lower(F.trim("doc_type")) if "doc_type" in chunks.columns else F.lit("")
    source = F.coalesce("source", F.lit(""))
    rows = chunks.select("chunk_id", F.xxhash64(source, F.coalesce(kind, F.lit(""))).alias("pool"), F.xxhash64(source).alias("source"), "text")
    return rows.where(F.col("text").rlike(r"[^\x00-\x7F]"))


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of a partition: characters by the class of the one before, and tokens a pool. A token counts once a row."""
    held: Counter[str] = Counter()
    total: Counter = Counter()
    sizes: Counter = Counter()
    for b in batches:
        for pool, source, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            found = _tokens(text)
            held.update(found)
            sizes[pool, source] += len(found)
        if sum(map(len, held)) > HELD:
            total.update(_counted(held.items()))
            held.clear()
    total.update(_counted(held.items()))
    yield from _as_rows(total, sizes)


def _as_rows(counts: dict[tuple[str, str], float], sizes: dict[tuple[int, int], int]) -> Iterator[pa.RecordBatch]:
    names = ["before", "c", "n", "pool", "source"]
    k, m = list(counts), list(sizes)
    yield pa.record_batch([pa.array([x[0] for x in k], pa.string()), pa.array([x[1] for x in k], pa.string()), pa.array([float(counts[x]) for x in k], pa.float64()), pa.nulls(len(k), pa.int64()), pa.nulls(len(k), pa.int64())], names=names)
    yield pa.record_batch([pa.nulls(len(m), pa.string()), pa.nulls(len(m), pa.string()), pa.array([float(sizes[x]) for x in m], pa.float64()), pa.array([x[0] for x in m], pa.int64()), pa.array([x[1] for x in m], pa.int64())], names=names)


_COUNTED = "before string, c string, n double, pool long, source long"


def _summed(counted: DataFrame) -> dict[tuple[str, str], float]:
    """Counts of (class before, character). There are at most as many as code points times classes, whatever the rows."""
    rows = counted.where("c is not null").groupBy("before", "c").agg(F.sum("n").alias("n"))
    return {(r.before, r.c): r.n for r in rows.toLocalIterator()}


def counts_of(tokens: DataFrame) -> dict[tuple[str, str], float]:
    """Counts of (class before, character) over (token, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            total.update(_counted(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)))
        yield from _as_rows(total, {})

    return _summed(tokens.select("token", F.col("n").cast("double")).mapInArrow(count, _COUNTED))


def likely(token: str, model: Model) -> list[tuple[str, str, float]]:
    """(chain, original, log-likelihood) of a token that may be garbled, the token itself ("") first; nothing if no chain can come up to it.

    Chains that are out of the question beside another are left out.
    """
    found = originals(token)
    lost = _LOST.search(token) is not None
    if not found and not lost:
        return []
    clean = best = model.score(token)
    rows = []
    for chain, text in found.items():
        if (log := model.score(text, best - MARGIN)) > best - MARGIN:
            rows.append((chain, text, log))
            best = max(best, log)
    rows = [x for x in rows if x[2] > best - MARGIN]
    if lost:  # nothing that is written correctly looks like this
        rows.append(("lost", token, clean + 30.0))
    return [("", token, clean), *rows] if rows else []


def _doubtful(rows: DataFrame, model: Model) -> DataFrame:
    """(chunk_id, pool, token) of all tokens that may be garbled, each once a row."""
    sent, run = rows.sparkSession.sparkContext.broadcast(dict(model.counts)), uuid.uuid4().hex

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, known = Model(sent.value), _DOUBTS.setdefault(run, {})
        for b in batches:
            ids, pools, tokens = [], [], []
            for i, pool, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                for t in _tokens(text):
                    if (doubt := known.get(t)) is None:
                        doubt = known[t] = bool(likely(t, here))
                    if doubt:
                        ids.append(i)
                        pools.append(pool)
                        tokens.append(t)
            if sum(map(len, known)) > HELD:
                known.clear()
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(pools, pa.int64()), pa.array(tokens, pa.string())], names=["chunk_id", "pool", "token"])

    return rows.withColumn("chunk_id", F.col("chunk_id").cast("long")).mapInArrow(look, "chunk_id long, pool long, token string")


_CHAINS = "array<struct<chain string, text string, log double>>"


def _scored(tokens: DataFrame, model: Model) -> DataFrame:
    """(h, chains) of (h, token): the possible originals and their log-likelihoods, the token itself first."""
    sent, held = tokens.sparkSession.sparkContext.broadcast(dict(model.counts)), []

    @F.pandas_udf(_CHAINS)
    def score(col: pd.Series) -> pd.Series:
        if not held:
            held.append(Model(sent.value))
        return pd.Series([[{"chain": k, "text": v, "log": x} for k, v, x in likely(t, held[0])] for t in col], dtype=object)

    # the filter must not run the function a second time
    return tokens.select("h", score.asNondeterministic()("token").alias("chains")).where(F.size("chains") > 1)


def _rescored(scored: DataFrame, model: Model) -> DataFrame:
    """(h, chains) with the log-likelihoods of another model; the originals stay as they are."""
    sent, held = scored.sparkSession.sparkContext.broadcast(dict(model.counts)), []

    @F.pandas_udf(_CHAINS)
    def score(col: pd.Series) -> pd.Series:
        if not held:
            held.append(Model(sent.value))
        out = []
        for chains in col:
            rows = [{"chain": x["chain"], "text": x["text"], "log": held[0].score(x["text"])} for x in chains]
            out.append([x | {"log": rows[0]["log"] + 30.0} if x["chain"] == "lost" else x for x in rows])
        return pd.Series(out, dtype=object)

    return scored.select("h", score("chains").alias("chains"))


def _expected(rows: DataFrame, share: dict[str, float]) -> DataFrame:
    """Adds ``p`` to each chain: its posterior, from the likelihoods and the weights of the pool."""
    names = F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(float(v)))])
    unseen = min(share.values()) * 0.5

    def weight(chain: Column) -> Column:
        of_corpus = F.when(chain == "", 1 - F.col("prior")).otherwise(F.col("prior") * F.coalesce(names[chain], F.lit(unseen)))
        return (POOLED * of_corpus + F.coalesce(F.col("mass")[chain], F.lit(0.0))) / (POOLED + F.col("size"))

    scored = F.transform("chains", lambda x: F.struct(x["chain"].alias("chain"), (x["log"] + F.log(weight(x["chain"]) + F.lit(1e-12))).alias("log")))
    rows = rows.withColumn("chains", scored).withColumn("best", F.array_max(F.transform("chains", lambda x: x["log"])))
    parts = F.transform("chains", lambda x: F.struct(x["chain"].alias("chain"), F.exp(x["log"] - F.col("best")).alias("p")))
    rows = rows.withColumn("chains", parts).withColumn("all", F.aggregate("chains", F.lit(0.0), lambda a, x: a + x["p"]))
    return rows.withColumn("chains", F.transform("chains", lambda x: F.struct(x["chain"].alias("chain"), (x["p"] / F.col("all")).alias("p")))).drop("best", "all")


def _by_pool(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Rows (pool, h, ...) with the weights of their pool. A pool may hold a third of all rows: its rows are spread, and its weights sent along with each part."""
    spread = weights.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    # the plan can't tell how large maps are that are repeated: they aren't to be broadcast
    return rows.withColumn("part", F.pmod(F.xxhash64("h"), F.lit(PARTS)).cast("int")).join(spread.hint("merge"), ["pool", "part"]).drop("part")


def garbled_tokens(chunks: DataFrame, states: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunk_id, pool, h) of the doubtful tokens of all rows, ``h`` standing for the token, and (pool, h, token, original, chain, p) of those that are
    garbled by their posterior.

    ``chain`` "lost" says that the original can't be recovered; ``original`` is then as much as could be.
    """
    rows = _slim(chunks)
    counted = stored(rows.mapInArrow(_count_rows, _COUNTED), "characters")
    counts = _summed(counted)
    recorded = states.where(F.col("status") == "garbled").where("rel_path is not null").select(F.xxhash64("rel_path").alias("source")).distinct().withColumn("prior", F.lit(PRIOR_IF_RECORDED))
    sizes = counted.where("pool is not null").groupBy("pool", "source").agg(F.sum("n").alias("size")).join(recorded, "source", "left")
    sizes = stored(sizes.select("pool", "size", F.coalesce("prior", F.lit(PRIOR_GARBLED)).alias("prior")), "pools")

    # 96 bits stand for a token: among 10^12 of them no two are expected to be taken for each other
    seen = stored(_doubtful(rows, Model(counts)).select("chunk_id", "pool", F.unhex(F.substring(F.md5("token"), 1, 24)).alias("h"), "token"), "doubtful")
    tokens = stored(seen.groupBy("h").agg(F.first("token").alias("token")), "doubtful-tokens")
    seen = seen.drop("token")
    each_pool = stored(seen.groupBy("pool", "h").agg(F.count("*").alias("n")), "doubtful-in-pools")

    masses, share = None, {"": 1.0, "cp1252<utf-8": 1.0 / 40}
    scored = stored(_scored(tokens, Model(counts)), "scored-0")
    slim = lambda: stored(each_pool.join(scored.select("h", F.transform("chains", lambda x: F.struct(x["chain"].alias("chain"), x["log"].alias("log"))).alias("chains")), "h"), "likelihoods")
    likelihoods, posterior = slim(), None
    for turn in range(ROUNDS):
        weights = sizes.withColumn("mass", F.lit(None).cast("map<string,double>")) if masses is None else sizes.join(masses, "pool", "left")
        weights = weights.withColumn("size", F.lit(0.0) if masses is None else F.col("size"))
        posterior = stored(_expected(_by_pool(likelihoods, weights), share).select("pool", "h", "n", "chains"), f"posterior-{turn}")
        if turn == ROUNDS - 1:
            break
        each = posterior.select("pool", "h", "n", F.inline("chains"))
        mass = stored(each.where("chain <> ''").groupBy("pool", "chain").agg(F.sum(F.col("n") * F.col("p")).alias("mass")), f"mass-{turn}")
        of_chain = {r.chain: r.mass for r in mass.groupBy("chain").agg(F.sum("mass").alias("mass")).toLocalIterator()}
        most = sum(of_chain.values()) + 40.0
        share = {k: (v + 1.0) / most for k, v in of_chain.items()} | {"": 1.0}
        # tokens that no chain explains are clean, and count as such
        garbled = F.aggregate(F.map_values("m"), F.lit(0.0), lambda a, x: a + x)
        masses = mass.groupBy("pool").agg(F.map_from_entries(F.collect_list(F.struct("chain", "mass"))).alias("m"))  # at most one entry a chain
        masses = sizes.select("pool", "size").join(masses, "pool", "left").select("pool", F.when(F.col("m").isNull(), F.create_map(F.lit(""), F.col("size"))).otherwise(F.map_concat("m", F.create_map(F.lit(""), F.col("size") - garbled))).alias("mass"))
        masses = stored(masses, f"weights-{turn}")
        if turn == 0:
            # the corpus as it was written, as far as is known now: garbled tokens leave the counts and their originals enter
            moved = each.where("chain <> '' and p > 0.01").groupBy("h", "chain").agg(F.sum(F.col("n") * F.col("p")).alias("n"))
            texts = scored.select("h", F.col("chains")[0]["text"].alias("was"), F.inline("chains"))
            moved = moved.join(texts, ["h", "chain"])
            change = moved.select(F.col("was").alias("token"), (-F.col("n")).alias("n")).unionByName(moved.where("chain <> 'lost'").select(F.col("text").alias("token"), "n"))
            for k, v in counts_of(change).items():
                counts[k] = max(0.0, counts.get(k, 0.0) + v)
            scored = stored(_rescored(scored, Model(counts)), "scored-1")
            likelihoods = slim()
    p_of = lambda name: F.aggregate(F.filter("chains", lambda x: x["chain"] == name), F.lit(0.0), lambda a, x: a + x["p"])
    best = F.array_max(F.transform("chains", lambda x: F.struct(F.when(x["chain"] == "lost", 0.0).otherwise(x["p"]).alias("p"), x["chain"].alias("chain"))))["chain"]
    final = posterior.select("pool", "h", best.alias("chain"), (1 - p_of("")).alias("p"), (p_of("lost") > 0.5).alias("lost")).where(F.col("p") > SURE)
    texts = scored.select("h", F.col("chains")[0]["text"].alias("token"), F.inline("chains")).select("h", "token", "chain", F.col("text").alias("original"))
    final = final.join(texts, ["h", "chain"]).select("pool", "h", "token", "original", F.when(F.col("lost"), "lost").otherwise(F.col("chain")).alias("chain"), "p")
    return seen, stored(final, "garbled")


def _found(seen: DataFrame, garbled: DataFrame) -> DataFrame:
    """Rows of ``seen`` with what is garbled in their pool."""
    return seen.join(garbled, ["pool", "h"])


def garbled_rows(chunks: DataFrame, states: DataFrame) -> DataFrame:
    """``chunk_id`` of every row with at least one garbled stretch, once. Null, empty and pure ASCII texts are none;
    extra columns are ignored, but for ``doc_type``, which tells pools apart."""
    seen, garbled = garbled_tokens(chunks, states)
    return _found(seen, garbled.select("pool", "h")).select("chunk_id").distinct()


def repaired(chunks: DataFrame, states: DataFrame) -> DataFrame:
    """``chunk_id``, ``repaired`` text, and ``recovered``: whether the whole original is known, of every row with a garbled stretch."""
    seen, garbled = garbled_tokens(chunks, states)
    found = _found(seen, garbled).groupBy("chunk_id").agg(F.collect_list(F.struct("token", "original")).alias("changes"), (F.max((F.col("chain") == "lost").cast("int")) == 0).alias("recovered"))

    @F.pandas_udf("string")
    def apply(texts: pd.Series, changes: pd.Series) -> pd.Series:
        out = []
        for text, pairs in zip(texts, changes, strict=True):
            known = {p["token"]: p["original"] for p in pairs}
            out.append(re.sub(_SPACED, lambda m, k=known: k.get(m[0], m[0]), text))
        return pd.Series(out)

    rows = chunks.select("chunk_id", "text").join(found, "chunk_id")
    return rows.select("chunk_id", apply("text", "changes").alias("repaired"), "recovered")

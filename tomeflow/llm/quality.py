"""Quality statistics of texts, their exact ranks within each language, and outlier scores.

Each text has a handful of statistics. The values of a statistic are ranked within the text's language over the
whole corpus: equal values are counted together first, the distinct ones are range-partitioned and summed up, and
every partition adds the totals of those before it. A rank gives the share of texts of that language with a value
as extreme; the negated logarithms of these tail probabilities, each taken on the side that speaks against prose,
add up to the outlier score. Languages differ in how much of their text is prose, and a small one may hold nothing
but lists, so each value is ranked among the texts of all languages as well.

What tells natural prose from everything else is a score of the same tail probabilities, weighted: the weights and
the cut are learned from a bounded sample of hand labels.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomeflow.functions.durable import stored
from tomeflow.llm import prose
from tomeflow.operators.ordering import running_total

#: The statistics that are ranked, and whether large (1) or small (-1) values speak against prose.
SIDES = {
    "mean_word_length": 1, "symbol_ratio": 1, "digit_ratio": 1, "end_punct_share": -1, "common_share": -1, "distinct_share": -1, "mean_line_length": -1,
    "entries_share": 1, "rows_share": 1, "code_share": 1, "loose_share": 1, "prose_share": -1,
}
_FIELDS = "lang string, n_words long, " + ", ".join(f"{k} double" for k in SIDES)
#: Tail probabilities of a text: of each statistic within its language, and among all texts.
TAILS = (*SIDES, *(f"{k}_of_all" for k in SIDES))
#: Stands for the texts of all languages.
ALL = "*"
#: Labels that the weights are learned from at most.
LABELS = 2000
#: What the weights are before any label is seen (all alike: the score of texts that are as surprising as the average
#: is 0), how many labels they count for, and how often labels that the rest contradicts are set aside.
PRIOR, STRENGTH, REFITS = 0.1, 1.0, 5

_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()\-。，、；：？！“”‘’„«»¿¡…（）《》—–]|_")
_ENDS = frozenset(".!?…。！？；:：;")
_CLOSING = "\"'”’»)]」』）"
_LETTERS = re.compile(r"[^\W\d_一-鿿]+(?:[’'\-][^\W\d_一-鿿]+)*")


class _Signs(dict):
    """The class of a character: blank, digit, Chinese, symbol or none of them."""

    def __missing__(self, c: str) -> str:
        kind = "blank" if c.isspace() else "digit" if c in "0123456789" else "han" if "一" <= c <= "鿿" else "symbol" if _SYMBOL.match(c) else ""
        self[c] = kind
        return kind


_SIGNS = _Signs()


def _measure(text: str, words: prose.Words) -> tuple:
    latin = _LETTERS.findall(text.casefold())
    signs, n_signs, kinds_of_han = _SIGNS, dict.fromkeys(("blank", "digit", "han", "symbol", ""), 0), 0
    for c, k in Counter(text).items():
        kind = signs[c]
        n_signs[kind] += k
        kinds_of_han += kind == "han"
    han = n_signs["han"]
    n, solid = len(latin) + han, len(text) - n_signs["blank"]
    count = Counter(latin)
    lang = words.language(count, han, max(1, n))
    common = len(words.han.findall(text)) if lang == "zh" else sum(count[w] for w in words.of.get(lang, ()) if w in count)
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    ended = sum(x[-1] in _ENDS or x[-1] in _CLOSING and x.rstrip(_CLOSING)[-1:] in _ENDS for x in lines)
    kinds = prose.chars_by_kind(text, words)
    # a text of nothing but headings goes with the text that they stand over, signs without any word are loose
    whole = sum(kinds.values()) or kinds.update({"prose" if n else "loose": 1}) or 1
    return (
        lang, n, round((sum(map(len, latin)) + han) / n, 4) if n else 0.0, round(n_signs["symbol"] / solid, 4), round(n_signs["digit"] / solid, 4),
        round(ended / len(lines), 4), round(min(1.0, common / n), 4) if n else 0.0, round((len(count) + kinds_of_han) / n, 4) if n else 0.0,
        round(solid / len(lines), 4), *[round(kinds[k] / whole, 4) for k in prose.KINDS],
    )


def statistics(documents: DataFrame, common_words: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the statistics of each text, in the language whose frequent words it holds most of ("und": of none).

    Null, empty and blank texts have zero words and null for the rest. Repeated rows give repeated results; other
    columns are ignored. ``common_words`` (lang, word) is a fixed small table: it is sent to every task.
    """
    words = prose.Words([(r.lang, r.word) for r in common_words.where("word is not null and lang is not null").toLocalIterator()])

    @F.pandas_udf(_FIELDS)
    def measure(texts: pd.Series) -> pd.DataFrame:
        rows = [_measure(t, words) if t is not None and t.strip() else (None, 0, *[None] * len(SIDES)) for t in texts]
        return pd.DataFrame(rows, columns=[f.split()[0] for f in _FIELDS.split(", ")])

    return documents.select(F.col(key), measure(text).alias("s")).select(key, "s.*")


def tails(stats: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and the surprise (negated logarithm of the tail probability) of each of ``TAILS`` of the rows that have statistics; ``key`` must identify a row."""
    values = F.array(*[F.struct(F.lit(k).alias("stat"), F.round(F.col(k), 4).alias("value")) for k in SIDES])
    long = stats.where("lang is not null").select(key, "lang", F.inline(values))
    counts = stored(long.groupBy("lang", "stat", "value").agg(F.count("*").alias("n")), "values")
    # the texts of all languages are ranked as one more group
    everywhere = counts.groupBy("stat", "value").agg(F.sum("n").alias("n")).select(F.lit(ALL).alias("lang"), "stat", "value", "n")
    ranked = running_total(counts.unionByName(everywhere), ["lang", "stat"], ["value"], "n", "through")
    sizes = ranked.groupBy("lang", "stat").agg(F.max("through").alias("size"))  # a row a language and statistic
    up = F.array(*[F.lit(k) for k, side in SIDES.items() if side > 0])
    tail = F.when(F.array_contains(up, F.col("stat")), (F.col("size") - F.col("through") + F.col("n")) / F.col("size")).otherwise(F.col("through") / F.col("size"))
    surprise = stored(ranked.join(sizes, ["lang", "stat"]).select("lang", "stat", "value", (-F.log(tail)).alias("own")), "surprises")
    of_all = surprise.where(F.col("lang") == ALL).select("stat", "value", F.col("own").alias("of_all"))
    both = surprise.where(F.col("lang") != ALL).join(of_all, ["stat", "value"])
    sums = [F.sum(F.when(F.col("stat") == k, F.col(c))).alias(k if c == "own" else f"{k}_of_all") for c in ("own", "of_all") for k in SIDES]
    return long.join(both, ["lang", "stat", "value"]).groupBy(key).agg(*sums)


def outlier_scores(stats: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and ``score`` of the rows that have statistics: the sum of the surprises within the language; ``key`` must identify a row."""
    return tails(stats, key).select(key, F.round(sum(F.col(k) for k in SIDES), 6).alias("score"))


def quality(documents: DataFrame, common_words: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics and ``score`` of every row; null score for texts without words or signs."""
    stats = stored(statistics(documents, common_words, key, text), "text-statistics")
    return stats.join(outlier_scores(stats, key), key, "left")


def _fitted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and, last, the constant of a logistic regression, drawn towards equal weights."""
    x = np.column_stack([x, np.ones(len(x))])
    before = np.append(np.full(x.shape[1] - 1, PRIOR), 0.0)
    w = before.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + STRENGTH * (w - before)
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + STRENGTH * np.eye(len(w)), slope)
    return w


def weights(found: DataFrame, labels: DataFrame, key: str = "doc_id") -> tuple[list[float], float]:
    """The weight of each of ``TAILS`` and the constant, learned from at most ``LABELS`` labels (``key``, kind).

    Labels without a kind and those of other texts say nothing. Hand labels may be wrong: those that the weights learned
    from the rest contradict are set aside, and the weights learned again. Without labels all weights are alike.
    """
    moments = found.agg(*[F.avg(k).alias(f"m{i}") for i, k in enumerate(TAILS)], *[F.stddev_pop(k).alias(f"s{i}") for i, k in enumerate(TAILS)]).first()
    n = len(TAILS)
    mean, spread = np.array([moments[i] or 0.0 for i in range(n)]), np.array([moments[n + i] or 0.0 for i in range(n)])
    sample = labels.where("kind is not null").select(key, (F.col("kind") != "prose").cast("double").alias("_other")).orderBy(F.xxhash64(key), "_other").limit(LABELS)
    rows = found.join(F.broadcast(sample), key).select("_other", *TAILS).collect()  # at most LABELS rows
    y = np.array([r[0] for r in rows])
    x = (np.array([r[1:] for r in rows], dtype=np.float64).reshape(len(rows), n) - mean) / np.maximum(spread, 1e-9)
    kept = np.ones(len(rows), dtype=bool)
    for _ in range(REFITS):
        w = _fitted(x[kept], y[kept])
        kept = (x @ w[:-1] + w[-1] > 0) == (y > 0.5)
    scaled = w[:-1] / np.maximum(spread, 1e-9)
    return scaled.tolist(), float(w[-1] - scaled @ mean)


def prose_scores(documents: DataFrame, common_words: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score`` of each text that isn't blank: the weighted sum of its surprises, above 0 for what is no prose."""
    stats = stored(statistics(documents, common_words, key, text), "text-statistics")
    found = stored(tails(stats, key), "text-tails")
    weight, constant = weights(found, labels, key)
    return found.select(key, sum((F.col(k) * F.lit(w) for k, w in zip(TAILS, weight, strict=True)), F.lit(constant)).alias("score"))


def not_prose(documents: DataFrame, common_words: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` of each text that is something else than prose for the most part: those whose score is above 0.

    Null, empty and blank texts have no score. ``key`` must identify a row; other columns are ignored. An empty table
    gives an empty table.
    """
    return prose_scores(documents, common_words, labels, key, text).where("score > 0").select(key)

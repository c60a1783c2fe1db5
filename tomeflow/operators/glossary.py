"""Expansion of questions by the glossary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expand(questions: DataFrame, glossary: DataFrame, key: str = "query_id", text: str = "question") -> DataFrame:
    """``key``, ``text`` and ``expanded``: the question with the full forms and aliases of its terms appended.

    A term of ASCII counts where no letter, digit or underscore stands next to it, any other wherever it stands;
    case is ignored. Additions follow the order of the terms, each once, without those equal to the term. Null
    questions stay null; a question without terms is its own expansion. ``key`` must identify a row. The glossary
    is a hand-kept list: its rows (term, full, aliases) become literals of the plan.
    """
    entries = glossary.where("term is not null and trim(term) <> ''").orderBy("term").toLocalIterator()
    additions = [F.array().cast("array<string>")]
    asked = F.lower(F.col(text))
    for r in entries:
        term = r.term.lower()
        quoted = "\\Q" + term + "\\E"
        found = asked.rlike(rf"(^|[^\p{{L}}\p{{N}}_]){quoted}($|[^\p{{L}}\p{{N}}_])") if term.isascii() else asked.contains(term)
        names = [x for x in dict.fromkeys([r.full, *(r.aliases or [])]) if x and x.strip() and x.lower() != term]
        if names:
            additions.append(F.when(found, F.array(*map(F.lit, names))).otherwise(F.array().cast("array<string>")))
    more = F.array_distinct(F.flatten(F.array(*additions)))
    return questions.select(key, text, F.when(F.col(text).isNull(), None).otherwise(F.concat_ws(" ", F.array(text), more)).alias("expanded"))

"""The library's functions for ``spark.sql``.

Expressions become SQL functions, which Catalyst sees through; parsers become table functions, for
``SELECT ... FROM docs, LATERAL chunk_sql(text)``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tomeflow.functions.text import CJK_PUNCTUATION, HEAD


def register(spark: SparkSession) -> list[str]:
    """Registers the functions in the session and gives their names."""
    from tomeflow.operators import chunking
    from tomeflow.operators.clean import _body

    head = f"substring(t, 1, {HEAD})"
    native = {
        "utrim": ("STRING", r"regexp_replace(t, '(?U)^\\s+|\\s+$', '')"),
        "cjk_punctuation": ("INT", f"length({head}) - length(regexp_replace({head}, '[{CJK_PUNCTUATION}]', ''))"),
        "garbled_ratio": ("DOUBLE", rf"CASE WHEN coalesce(length({head}), 0) = 0 THEN 1.0D ELSE length(regexp_replace({head}, '[\\p{{L}}\\p{{N}}\\p{{P}}\\p{{Z}}]', '')) / length({head}) END"),
        "strip_comments": ("STRING", "regexp_replace(t, '(?s)<!--.*?-->', '')"),
        "file_extension": ("STRING", r"lower(regexp_extract(t, '\\.([^./\\\\]+)$', 1))"),
    }
    for name, (kind, body) in native.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS {kind} RETURN {body}")

    @F.pandas_udf(T.StringType())
    def without_boilerplate(texts: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or not t.strip() else _body(t, True) for t in texts], dtype=object)

    spark.udf.register("without_boilerplate", without_boilerplate)
    kinds = {"chunk_sql": "sql", "chunk_yaml": "yaml", "chunk_ini": "ini", "chunk_json": "json", "chunk_doc": "doc"}
    for name, kind in kinds.items():

        class Chunks:
            KIND = kind

            def eval(self, text: str) -> Iterator[tuple[int, str]]:
                for i, piece in enumerate(chunking.chunk_text(text, self.KIND)):
                    yield i, piece

        spark.udtf.register(name, F.udtf(Chunks, returnType="chunk_index int, text string"))
    return [*native, "without_boilerplate", *kinds]

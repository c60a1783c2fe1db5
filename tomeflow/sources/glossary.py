"""The glossary: terms, their full forms and other names."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "term string, full string, aliases array<string>"


def load_glossary(spark: SparkSession, path: str) -> DataFrame:
    """(term, full, aliases) of a YAML file that maps terms to a full form or to ``{full, aliases}``.

    A missing or malformed file gives an empty glossary; aliases that are no strings are left out. The file is a
    hand-kept list and read on the driver, anew at every call.
    """
    try:
        import yaml

        data = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except Exception:  # noqa: BLE001 - a glossary never stops a search
        data = None
    rows = []
    for term, value in data.items() if isinstance(data, dict) else ():
        if isinstance(value, str):
            rows.append((str(term), value, []))
        elif isinstance(value, dict):
            aliases = value.get("aliases")
            rows.append((str(term), str(value["full"]) if value.get("full") else None, [a for a in aliases if isinstance(a, str)] if isinstance(aliases, list) else []))
    return spark.createDataFrame(rows, SCHEMA)

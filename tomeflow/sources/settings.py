"""Settings with defaults, from the environment or from a file of key=value lines."""

from __future__ import annotations

import dataclasses
import os
from dataclasses import dataclass
from pathlib import Path

PREFIX = "TOMEFLOW_"


@dataclass(frozen=True)
class Settings:
    """Defaults of the whole pipeline. A blank or unreadable value in the environment leaves the default."""

    chunk_size: int = 1200
    chunk_overlap: int = 300
    embedding_max_tokens: int = 512
    max_markdown_kb: int = 500
    large_file_mb: int = 50
    file_timeout_s: int = 600
    top_k: int = 5
    threshold: float = 0.5
    garbled_marks: int = 3
    strip_boilerplate: bool = True
    glossary_path: str = ""
    trust_mtime: bool = True

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, file: str | None = None) -> Settings:
        """The environment comes before the file, the file before the defaults."""
        values = _read(file) | {k: v for k, v in (os.environ if env is None else env).items() if v.strip()}
        out = {}
        for f in dataclasses.fields(cls):
            raw = values.get(PREFIX + f.name.upper(), "").strip()
            if not raw:
                continue
            try:
                out[f.name] = raw.lower() in ("1", "true", "yes", "on") if f.type == "bool" else {"int": int, "float": float, "str": str}[f.type](raw)
            except ValueError:
                continue
        return cls(**out)

    def warnings(self) -> list[str]:
        """What is allowed but unwise."""
        out = []
        if self.chunk_size < 2 * self.chunk_overlap:
            out.append(f"chunk_size {self.chunk_size} should be at least twice chunk_overlap {self.chunk_overlap}")
        if not 0 <= self.threshold <= 1:
            out.append(f"threshold {self.threshold} should lie between 0 and 1")
        if self.top_k < 1:
            out.append(f"top_k {self.top_k} gives no answers")
        if self.chunk_size > self.embedding_max_tokens:
            out.append(f"chunks of {self.chunk_size} characters may be longer than the {self.embedding_max_tokens} tokens that are embedded")
        return out


def _read(file: str | None) -> dict[str, str]:
    if not file or not Path(file).exists():
        return {}
    lines = (x.strip() for x in Path(file).read_text(encoding="utf-8").splitlines())
    return {k.strip(): v.strip().strip("\"'") for k, sep, v in (x.partition("=") for x in lines if x and not x.startswith("#")) if sep}

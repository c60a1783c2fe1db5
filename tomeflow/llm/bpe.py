"""Exact incremental byte-pair encoding along shared prefixes.

For every prefix of a piece, byte-pair encoding ends in one definite last token, and the tokens before it
are the encoding of the rest of the prefix. So a trie of pieces needs one state a node: the last token and
where it begins. Sorted pieces visit that trie depth first; ``Prefixes`` keeps the states of the current
path only, and every prefix that pieces share is encoded once.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import regex

#: The vocabulary's own split into pieces, and the white space that it knows.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = "\t\n\v\f\r \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"

_PIECE = regex.compile(PATTERN.replace(r"\S", f"[^{WHITE}]").replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]"))
#: No piece spans two of these segments, so a text is cut into segments first and each distinct one is split once.
_SEGMENT = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def default_path() -> str:
    """The vocabulary byte_bpe_50k of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and, for each token, the components at its left and right edge over time."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = _byte_letters()
        vocab: dict[str, int] = model["vocab"]
        usable = {t: i for t, i in vocab.items() if all(c in letters for c in t)}
        self.ids = {bytes(letters[c] for c in t): i for t, i in usable.items()}
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.merged[left, right] = (rank, whole)
            parts.setdefault(whole, (rank, left, right))
        self.parts = parts
        single = {bytes([b]) for b in range(256)}
        self.ids = {t: i for t, i in self.ids.items() if i in parts or t in single}
        self.endings = {t[k:] for t in self.ids for k in range(len(t))}
        self.firm: dict[tuple[int, int], bool] = {}
        self._edges: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The components that stand at an edge of a token while it is built, each with the merge that ends it."""
        if (known := self._edges.get((token, side))) is None:
            known, until, now = [], 1 << 60, token
            while True:
                known.append((now, until))
                if now not in self.parts:
                    break
                until, now = self.parts[now][0], self.parts[now][1 + side]
            self._edges[token, side] = known
        return known

    def stays(self, a: int, b: int) -> bool:
        """Whether the bytes of two tokens, side by side, are encoded as just these two.

        They are not if some merge across the seam comes before the merges that end the components which it joins.
        Among equal merges the left one is first.
        """
        if (known := self.firm.get((a, b))) is None:
            known = True
            for x, x_until in self.edge(a, 1):
                for y, y_until in self.edge(b, 0):
                    if (m := self.merged.get((x, y))) and m[0] < x_until and m[0] <= y_until:
                        known = False
                        break
                if not known:
                    break
            self.firm[a, b] = known
        return known


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary a Python worker."""
    return Vocabulary(path)


class Prefixes:
    """The states along one path of the trie; ``push`` moves to the next piece in sorted order."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.path, self.last, self.start, self.count = b"", [-1], [0], [0]

    def push(self, piece: bytes) -> int:
        """Goes to ``piece``, reusing the states of the prefix shared with the piece before; gives its number of tokens."""
        ids, endings, firm, stays = self.vocab.ids, self.vocab.endings, self.vocab.firm, self.vocab.stays
        before, keep, most = self.path, 0, min(len(self.path), len(piece))
        while keep < most and before[keep] == piece[keep]:
            keep += 1
        last, start, count = self.last, self.start, self.count
        del last[keep + 1 :], start[keep + 1 :], count[keep + 1 :]
        for end in range(keep + 1, len(piece) + 1):
            at, possible = end - 1, []
            while at >= 0 and (tail := piece[at:end]) in endings:
                if (token := ids.get(tail)) is not None:
                    possible.append((at, token))
                at -= 1
            for at, token in reversed(possible):
                if at == 0 or (ok := firm.get((last[at], token))) or (ok is None and stays(last[at], token)):
                    last.append(token)
                    start.append(at)
                    count.append(count[at] + 1)
                    break
            else:
                raise ValueError("a byte is missing from the vocabulary")
        self.path = piece
        return count[-1]

    def tokens(self) -> list[int]:
        """The encoding of the piece last pushed, read back from its last token."""
        out, at = [], len(self.path)
        while at:
            out.append(self.last[at])
            at = self.start[at]
        out.reverse()
        return out


class Pieces:
    """Numbers the distinct pieces of a block of texts, and writes each text as a row of these numbers."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.segments: dict[str, tuple[int, ...]] = {}

    def split(self, segment: str) -> tuple[int, ...]:
        number = self.number
        return tuple([number.setdefault(p, len(number)) for p in _PIECE.findall(segment)])

    def codes(self, text: str | None) -> np.ndarray:
        known, out = self.segments, []
        for segment in _SEGMENT.findall(text or ""):
            if (got := known.get(segment)) is None:
                got = known[segment] = self.split(segment)
            out += got
        return np.array(out, dtype=np.int32)

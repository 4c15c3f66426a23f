"""Exact chunk-wise tokenisation: cut texts where no token can cross, encode each distinct chunk once.

The word patterns of the tokenizers used here never let a match run over a
single blank between two visible characters, or over a single line feed
between two visible characters. So a text may be cut there, each distinct
chunk encoded once by the library, and the ids joined: the result equals
encoding the whole text in one call (tested), and the cost per repeated word
is one dictionary lookup.
"""

from __future__ import annotations

import re
from collections.abc import Callable

# Cuts before a blank that has a visible character on both sides. The class is
# wider than any library's notion of white space, which only means fewer cuts.
_CUT = re.compile("(?<=[^\\s᠎​﻿])(?= [^\\s᠎​﻿])")
_ODD = re.compile("[\\s᠎​﻿]")
_SEEN = 1 << 22


class ChunkCodes:
    """Codes (bytes) of text chunks, kept across batches of a Python worker.

    ``encode`` maps a list of chunks to their codes. A chunk is kept from its
    second sight on (words met once are most of all distinct words); at most
    ``limit`` chunks of at most 48 characters are kept, so memory is bounded
    whatever the text. Where a full cache no longer serves the text at hand,
    it starts anew.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = 600_000):
        self.encode, self.limit = encode, limit
        self.cache: dict[str, bytes] = {}
        self.seen = bytearray(_SEEN)
        self.odd: set[str] = {"", " "}

    def codes(self, texts: list[str], cut: Callable[[str], list[str]] | None = None) -> list[bytes]:
        """The joined codes of each text's chunks.

        ``cut`` gives a text's chunks where any cut at white space is right;
        by default texts are cut as this module's docstring says.
        """
        parts = [(cut or self.cut)(t) for t in texts]
        wanted = set().union(*parts)
        missing = list(wanted.difference(self.cache))
        if cut is None and (odd := self._odd(missing)):
            parts = [p if odd.isdisjoint(p) else _pieces(t) for t, p in zip(texts, parts)]
            wanted = set().union(*parts)
            missing = list(wanted.difference(self.cache))
        known, passing, anew = self.cache, {}, False
        if missing:
            anew = len(known) >= self.limit and 4 * len(missing) > 3 * len(wanted)
            seen = self.seen
            for chunk, code in zip(missing, self.encode(missing)):
                place = hash(chunk) & (_SEEN - 1)
                if not seen[place]:
                    seen[place] = 1
                    passing[chunk] = code
                elif len(known) < self.limit and len(chunk) <= 48:
                    known[chunk] = code
                else:
                    passing[chunk] = code
            known.update(passing)
        code = known.__getitem__
        out = [b"".join(map(code, part)) for part in parts]
        if anew:
            known.clear()
            self.seen = bytearray(_SEEN)
        else:
            for chunk in passing:
                del known[chunk]
        return out

    def _odd(self, missing: list[str]) -> set[str]:
        """Chunks of plain cuts that hold white space other than a leading blank or a single line feed.

        A text whose plain cut holds one is cut by the pattern, now and later.
        """
        odd = set(_with_white_space(missing)) - self.odd
        if odd:
            if len(self.odd) > self.limit:  # both anew: a cached odd chunk must be known as odd
                self.odd = {"", " "}
                self.cache.clear()
            self.odd |= {c for c in odd if len(c) <= 48}
        return odd

    def cut(self, text: str) -> list[str]:
        """Chunks that keep their leading blank; line feeds stand alone."""
        if "\0" in text:
            return _pieces(text)
        parts = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return parts if self.odd.isdisjoint(parts) else _pieces(text)


def _pieces(text: str) -> list[str]:
    return [c for c in _CUT.split(text) if c]


def _with_white_space(chunks: list[str]) -> list[str]:
    """Chunks with white space other than a leading blank, looked for in one text of all of them."""
    joined = "\0".join([c[1:] if c[:1] == " " else c for c in chunks if c != "\n"])
    if not _ODD.search(joined):
        return []
    return [c for c in chunks if c != "\n" and _ODD.search(c, 1 if c[:1] == " " else 0)]


def words(text: str) -> list[str]:
    """Cuts at blanks and line feeds, which are dropped (for vocabularies that skip white space)."""
    return text.replace("\n", " ").split(" ")

"""Ids from the tokenizers library, per worker, through the exact chunk cache."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from flightlens.llm.chunks import ChunkCodes, words

#: ASCII marks that may follow a word: no letter, digit or white space, and no apostrophe (patterns join it to letters).
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: The blank before a word in the byte alphabet.
_BLANK = "\u0120"
#: Words that the model is given in one text.
_TOGETHER = 64
#: Runs of marks whose codes a worker keeps.
_KEPT_MARKS = 10_000


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def _codes(path: str, drops_white_space: bool) -> tuple[ChunkCodes, list[str]]:
    """The codes of chunks, and the strings of the special tokens (the library matches them in the raw text)."""
    tokenizer = _tokenizer(path)
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import WhitespaceSplit

    tokenizer.encode_special_tokens = True  # no chunk holds one that is to be a token
    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    # The same model over words that are written in its own alphabet, apart by blanks: no pattern to match.
    bare_words = Tokenizer(tokenizer.model)
    bare_words.pre_tokenizer = WhitespaceSplit()
    # What shows a word of ASCII letters in a row of ids: the blank its first token holds, or the mark of its last.
    suffix = tokenizer.model.end_of_word_suffix if drops_white_space else None
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    edge = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
    for token, i in vocabulary.items():
        edge[i] = bool(suffix) and token.endswith(suffix) if drops_white_space else token.startswith(_BLANK)
    marks: dict[str, bytes] = {}

    def packed(ids) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def model_codes(words: list[str]) -> list[bytes]:
        """Codes of words that are one pretoken of ASCII letters each."""
        out: list[bytes] = []
        groups = [words[at:at + _TOGETHER] for at in range(0, len(words), _TOGETHER)]
        for group, e in zip(groups, bare_words.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            at = np.flatnonzero(edge[ids])
            cuts = [0, *(4 * at + 4).tolist()] if drops_white_space else [*(4 * at).tolist(), 4 * len(ids)]
            if len(cuts) == len(group) + 1 and cuts[0] == 0 and cuts[-1] == 4 * len(ids):
                raw = ids.tobytes()
                out += [raw[a:b] for a, b in zip(cuts, cuts[1:])]
            else:  # words without an edge
                out += [packed([t.id for t in tokenizer.model.tokenize(w)]) for w in group]
        return out

    def encode(chunks: list[str]) -> list[bytes]:
        # The pattern parts letters from the marks that follow them, so both have codes of their own.
        stems = [c.rstrip(_MARKS) for c in chunks]
        known = codes.cache
        # One pretoken of ASCII letters: straight to the library's BPE model. Normaliser and
        # pre-tokenizer only lower it, or write its blank as the byte alphabet does.
        found = {s: known.get(s) for s in stems
                 if s.isascii() and (s.isalpha() or s[:1] == " " and s[1:].isalpha())}
        new = [s for s, code in found.items() if code is None]
        if drops_white_space:
            texts = [s.strip(" ").lower() for s in new]
        else:
            new.sort(key=_leading_blank)  # those with an edge together
            texts = [_BLANK + s[1:] if s[0] == " " else s for s in new]
        found.update(zip(new, model_codes(texts)))
        out: list = [None] * len(chunks)
        other = []
        for i, (chunk, stem) in enumerate(zip(chunks, stems)):
            code = found.get(stem)
            if code is None:
                other.append(i)
            elif stem == chunk:
                out[i] = code
            else:
                end = chunk[len(stem):]
                mark = marks.get(end)
                if mark is None:
                    mark = packed(tokenizer.encode(end, add_special_tokens=False).ids)
                    if len(marks) < _KEPT_MARKS and len(end) <= 48:
                        marks[end] = mark
                out[i] = code + mark
        for at in range(0, len(other), 4096):
            part = other[at:at + 4096]
            whole = tokenizer.encode_batch_fast([chunks[i] for i in part], add_special_tokens=False)
            for i, e in zip(part, whole):
                out[i] = packed(e.ids)
        return out

    codes = ChunkCodes(encode)
    return codes, specials


def _leading_blank(chunk: str) -> bool:
    return chunk[0] == " "


@lru_cache(maxsize=4)
def _with_specials(path: str):
    """The library as it is; a second vocabulary in memory, so only made where a text holds a special token."""
    return _tokenizer(path)


def ids_bytes(texts: list[str], path: str, drops_white_space: bool, specials: bool = False) -> list[bytes]:
    """Each text's ids as little-endian unsigned 32-bit integers.

    ``drops_white_space``: the vocabulary's word pattern skips white space and
    its normaliser acts within words, so texts are cut at every blank and line
    feed; else only where ``chunks`` proves that no token crosses.

    ``specials``: the string of a special token in a text is that token, as in
    the library's ``encode(text, add_special_tokens=False)``; such texts are
    encoded whole. Else it is ordinary text.
    """
    out = {}
    chunk_codes, strings = _codes(path, drops_white_space)
    if specials:
        out = {i: np.array(_with_specials(path).encode(t, add_special_tokens=False).ids, "<u4").tobytes()
               for i, t in enumerate(texts) if any(s in t for s in strings)}
    plain = [t for i, t in enumerate(texts) if i not in out] if out else texts
    codes = iter(chunk_codes.codes(plain, words if drops_white_space else None))
    return [out[i] if i in out else next(codes) for i in range(len(texts))]

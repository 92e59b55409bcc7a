"""Byte-level BPE through the tokenizers library, with each distinct word encoded once per worker.

A byte-level BPE pre-tokenizer always starts a new piece at a single space between two other characters,
and at both sides of a single line break between two other characters.  Texts are cut there and nowhere
else, so the ids are those of the whole text.  A word of letters alone is one piece and goes to the model.  A run that holds any other white space is encoded as it is.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
from tokenizers import Tokenizer

#: Words remembered by a worker, in two generations: when the newer is full, it replaces the older.
#: It bounds space and changes no id.  Words at the start of a line have a memory of their own, a quarter of that size.
REMEMBERED = 800_000
LONGEST = 64


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


_LETTERS = _byte_letters()
#: Letters up to here are letters for every Unicode version; words of others take the tokenizer's own way.
_COMMON = "\u0250"
#: The pre-tokenizer's pieces of an ASCII word, the space before it included.
_PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^ A-Za-z0-9]+")
#: Special tokens start with this sign; they are cut out before pre-tokenizing.
_SPECIAL = "<"


class _Memory(dict):
    """Ids of words; a word of letters alone is one piece, other ASCII words are joined from their pieces."""

    def __init__(self, owner: Encoder, prefix: str):
        super().__init__()
        self.owner, self.prefix = owner, prefix
        self.mark = _LETTERS[32] if prefix else ""
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        owner = self.owner
        if word in self.older:
            ids = self.older[word]
        elif word.isascii():
            if word.isalpha():
                ids = owner.ids(self.mark + word)
            elif _SPECIAL in word:
                ids = owner.direct(self.prefix + word)
            else:
                pieces = _PIECES.findall(self.prefix + word)
                if len(pieces) == 1:
                    ids = owner.piece(pieces[0])
                else:
                    ids = b"".join([owner.later[p[1:]] if p[0] == " " else owner.first[p] for p in pieces])
        elif max(word) < _COMMON and word.isalpha():
            ids = owner.piece(self.prefix + word)
        elif word[-1] in ",." and max(word) < _COMMON and word[:-1].isalpha():
            ids = self[word[:-1]] + owner.first[word[-1]]
        else:
            ids = owner.direct(self.prefix + word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED // (2 if self.prefix else 8):
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Ids of texts as little-endian 32-bit integers."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.first = _Memory(self, "")
        self.later = _Memory(self, " ")

    def ids(self, letters: str) -> bytes:
        """Ids of a single pre-tokenizer piece in the letters of its bytes."""
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def piece(self, text: str) -> bytes:
        """Ids of a single pre-tokenizer piece."""
        return self.ids(text.encode("utf-8").decode("latin-1").translate(_LETTERS))

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        out: list[bytes] = []
        lines = text.split("\n")
        run = [lines[0]]
        for line in lines[1:]:
            before = run[-1]
            if before and line and not before[-1].isspace() and not line[0].isspace():
                self._run("\n".join(run), out)
                out.append(self.first["\n"])
                run = [line]
            else:
                run.append(line)
        self._run("\n".join(run), out)
        return b"".join(out)

    def _run(self, text: str, out: list[bytes]) -> None:
        words = text.split()
        if words and " ".join(words) == text:
            out.append(self.first[words[0]])
            out.extend(map(self.later.__getitem__, words[1:]))
        else:
            out.append(self.direct(text))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget() -> None:
    """Free the worker's encoders; an operator calls this that needs none and finds those of one before it."""
    _encoders.clear()

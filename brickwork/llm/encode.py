"""Token ids of whole texts inside tasks, by the tokenizers library with a memory of words.

Both vocabularies cut a text before every run of white space, so the ids of a text are those of its words
joined.  A word's ids come from the tokenizer once and are remembered (``MEMORY`` words a worker, then
the memory starts anew).  Texts whose white space is not single blanks or line ends between words are
given to the tokenizer whole, as are texts that spell one of the vocabulary's control tokens, which keep their ids.
"""

from __future__ import annotations

import re
from array import array


from brickwork.llm.common import remembered

MEMORY = 700_000
_PLAIN = re.compile("(\n?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")
_SPACE = re.compile(r"[^\S\n]|.\n", re.DOTALL)


class _Whole(Exception):
    """The text must be encoded in one piece."""


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes printable bytes as themselves and the others as letters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in printable)
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids (Spark's executors and Arrow are little-endian throughout)."""
    return array("I", ids).tobytes()


class Words(dict):
    """Word to little-endian unsigned 32-bit ids; the first occurrence asks the tokenizer."""

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self.memory = memory
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.blank = " ".translate(self.letters)
        self.marks = {m: _packed(self._model(m)) for m in ".,;:!?"}
        self.spaced = self.tokenizer.normalizer is None  # else white space is dropped and case folded
        self.controls = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _model(self, token: str, blank: bool = False) -> list[int]:
        if not token.isascii() or "\n" in token:
            token = token.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.tokenize(self.blank + token if blank else token)]

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.memory:
            self.clear()
        if plain := _PLAIN.fullmatch(word):
            line, letters, mark = plain.groups()
            if mark:
                found = self[line + letters] + self.marks[mark]
            elif self.spaced:
                found = _packed(self._model(line) + self._model(letters) if line else self._model(letters, True))
            elif line or letters != letters.lower():
                found = self[letters.lower()]
            else:
                found = _packed(self._model(letters))
        elif not self.spaced:
            found = self.whole(word)
        elif not word or word == "\n" or _SPACE.search(word):
            raise _Whole
        else:
            found = self.whole(word if word[0] == "\n" else " " + word)
        self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(c in text for c in self.controls):
            return self.whole(text)
        if not self.spaced:
            return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))
        first, *rest = text.replace("\n", " \n").split(" ")
        try:
            if not first or first[0] == "\n":
                raise _Whole
            return self["\n" + first][4:] + b"".join(map(self.__getitem__, rest))
        except _Whole:
            return self.whole(text)


def words(path: str, memory: int = MEMORY) -> Words:
    """One memory a Python worker."""
    return remembered(("words", path, memory), lambda: Words(path, memory))

"""Cuts texts into the pieces that byte-level vocabularies encode one by one, exactly as the pattern matches them."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import regex

from carelens.llm.common import Remembered

#: A space before the end or before white space: here the pattern may join the space with what comes before it.
_SPACE_RUN = re.compile(r" (?:\s|\Z)")
_BEFORE_WORD = re.compile(r" (?=\S)")


@lru_cache(maxsize=8)
def compiled(pattern: str):
    return regex.compile(pattern)


class Pieces:
    """Per-chunk results, remembered.

    The pattern always begins a new match at a space that is followed by a character other than white space: no
    alternative holds such a space except as its first character, and ``\\s+(?!\\S)`` stops before it. So a text is cut
    there first, at little cost, and the pattern runs only on chunks (mostly words) that were not seen lately.

    ``of_piece`` gives the result of a piece, ``joined`` that of several. A piece that is a word after a space is remembered as
    the chunk of this word, so it is held once.
    """

    def __init__(self, pattern: str, of_piece: Callable[[str], object], joined: Callable[[list], object], size: int):
        self.find, self.of_piece, self.joined = compiled(pattern).findall, of_piece, joined
        self.later = Remembered(lambda chunk: self._chunk(" " + chunk), size)

    def _chunk(self, chunk: str):
        pieces = self.find(chunk)
        if len(pieces) == 1:
            return self.of_piece(chunk)
        return self.joined([self.later[p[1:]] if p[0] == " " and p[1:].strip() else self.of_piece(p) for p in pieces])

    def __call__(self, text: str) -> list:
        """The results of the text's chunks, in order."""
        if _SPACE_RUN.search(text) is None:
            head, *rest = text.split(" ")
        else:
            head, *rest = _BEFORE_WORD.split(text)
        return [self._chunk(head), *map(self.later.__getitem__, rest)]

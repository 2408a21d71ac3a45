"""Cutting texts where no tokenizer here can join anything, and remembering
what each piece gave.

A *unit* starts at a blank (U+0020) after a character that is not white space
(or at the text's start).  The split pattern of the byte-level vocabularies
always cuts there, and so does a sentencepiece model none of whose pieces has
its blank mark after another character; so a text's tokens are its units'
tokens in a row, and a unit that occurs again need not be encoded again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Texts are worked through in slices of about this many characters.
SLICE = 1 << 20

#: A unit store forgets everything beyond this many different units.
UNITS_KEPT = 400_000

_RUN = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def units(text: str, led: bool = False) -> list[str]:
    """The units of ``text``, or of a blank and ``text`` if ``led``."""
    if text.startswith(" ") or _RUN.search(text):
        return _CUT.split(" " + text if led else text)
    first, *rest = text.split(" ")
    return [" " + first if led else first, *[" " + w for w in rest]]


def sliced_units(text: str, led: bool = False, size: int = SLICE) -> Iterator[list[str]]:
    """The units of a text in lists of bounded size, cut between units."""
    at = 0
    while True:
        cut = text.find(" ", at + size)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.find(" ", cut + 1)
        yield units(text[at:] if cut < 0 else text[at:cut], led)
        if cut < 0:
            return
        at, led = cut + 1, True

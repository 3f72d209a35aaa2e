"""Pre-tokens on which every tokenizer library agrees: Latin letters and ASCII signs."""

from __future__ import annotations

import struct
import sys
import unicodedata

_TOP = 0x180  # end of Latin Extended-A; all of it is stable under NFC


def _of_category(first: str) -> str:
    return "".join(
        chr(c) for c in range(_TOP) if unicodedata.category(chr(c)).startswith(first)
    )


#: Contents of a character class: the letters below U+0180, without the one whose lower case
#: is two characters.
LETTERS = _of_category("L").replace("\u0130", "")
#: Contents of a character class: printable ASCII without letters, digits and apostrophe.
SIGNS = "".join(
    "\\" + chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"
)


def _byte_table() -> dict[int, str]:
    """Printable stand-ins of bytes in byte-level vocabularies: a printable Latin-1
    character stands for itself, the others take the code points from U+0100 on in order."""
    spare = iter(range(0x100, sys.maxunicode))
    return {
        b: chr(b) if 0x21 <= b <= 0x7E or (0xA1 <= b <= 0xFF and b != 0xAD) else chr(next(spare))
        for b in range(0x100)
    }


_BYTES = _byte_table()


def byte_level(text: str) -> str:
    """A pre-token as byte-level models spell it."""
    if text.isascii() and text.isalpha():
        return text
    return text.encode("utf-8").decode("latin-1").translate(_BYTES)


_CODES = {ord(stand_in): b for b, stand_in in _BYTES.items()}


def byte_values(entry: str) -> bytes:
    """The bytes that an entry of a byte-level vocabulary spells."""
    return entry.translate(_CODES).encode("latin-1")


def packed(ids: list[int]) -> bytes:
    """Ids as unsigned 32-bit integers, little-endian."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Cache(dict):
    """Computed values by text: at most ``entries`` of texts up to ``chars`` long, all
    forgotten when full."""

    def __init__(self, entries: int, chars: int):
        super().__init__()
        self.entries, self.chars = entries, chars

    def compute(self, text: str):
        raise NotImplementedError

    def __missing__(self, text: str):
        value = self.compute(text)
        if len(text) <= self.chars:
            if len(self) >= self.entries:
                self.clear()
            self[text] = value
        return value

"""Terms of UTF-8 texts: runs of the characters that a table keeps, with A to Z lower-cased."""

from __future__ import annotations

import string
from collections.abc import Iterator

#: Bytes of a text that are split at a time.
PIECE = 1 << 20


def term_table(ascii_kept: str) -> bytes:
    """A table for bytes.translate: kept ASCII characters and all bytes from 0x80 on stay, A to Z become a to z, all others blanks."""
    lowered = {ord(c): ord(c.lower()) for c in ascii_kept}
    return bytes(x if x >= 0x80 else lowered.get(x, 0x20) for x in range(256))


LETTERS = term_table(string.ascii_letters)
LETTERS_AND_DIGITS = term_table(string.ascii_letters + string.digits)


def terms_of(text: bytes | None, table: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists; a long text is split piece by piece, so that its terms aren't held together. Null has none."""
    data = (text or b"").translate(table)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + piece)
        end = len(data) if end < 0 else end
        yield (data if at == 0 and end == len(data) else data[at:end]).split()
        at = end

"""Terms of a text as byte strings: maximal runs of kept characters, A-Z lower-cased."""

from __future__ import annotations

from collections.abc import Iterator

PIECE = 1 << 20
LETTERS = b"abcdefghijklmnopqrstuvwxyz"


def splitter(also: bytes = b"") -> bytes:
    """The translation table that keeps ASCII letters, all bytes of other characters and
    ``also``, and turns every other byte into a space."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for c in LETTERS:
        table[c] = table[c - 32] = c
    for c in also:
        table[c] = c
    return bytes(table)


def pieces(data: bytes | None, table: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole UTF-8 text in order, a bounded piece at a time (null: none)."""
    if not data:
        return
    data = data.translate(table)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE) if start + PIECE < len(data) else -1
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


class Numbers(dict):
    """Numbers of terms in order of their first use."""

    def __missing__(self, term: bytes) -> int:
        value = self[term] = len(self)
        return value

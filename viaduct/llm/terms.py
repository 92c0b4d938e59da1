"""Terms of texts: maximal runs of letters A-Z and a-z, digits and what is not ASCII; only A-Z is lower-cased.

Everything works on UTF-8 bytes: one table lower-cases and blanks separators, so a text is split without a pattern.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Long texts are split in pieces of about so many bytes.
PIECE_BYTES = 1_000_000
#: For bytes.translate: capitals become small, every other ASCII character but letters and digits becomes a space.
_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEPT else 32 for b in range(256))


def raw_texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def term_pieces(raw: bytes | None, limit: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The terms of a text in order, some at a time; a term is never cut."""
    if not raw:
        return
    plain, start = raw.translate(_TABLE), 0
    while len(plain) - start > limit and (end := plain.find(b" ", start + limit)) >= 0:
        yield plain[start:end].split()
        start = end
    yield plain[start:].split()

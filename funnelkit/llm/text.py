"""Words of a text as UTF-8 bytes.

``term_words``: A-Z lower-cased, maximal runs of characters outside
``\x00-\x2F\x3A-\x60\x7B-\x7F`` (digits, a-z and everything non-ASCII).
Every byte of a non-ASCII character is at least 0x80, so the class can be
applied to bytes.  ``space_words``: maximal runs of characters other than
space and ``\x09-\x0D``, which is what ``bytes.split()`` splits on.
"""

from __future__ import annotations

import pyarrow as pa

_TERM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

#: a word of a lower-cased text
TERM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: DuckDB: the same words of a column ``text``
TERM_WORDS_SQL = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each string (None for null)."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def term_words(text: bytes | None) -> list[bytes]:
    return text.translate(_TERM).split() if text else []


def space_words(text: bytes | None, lower: bool = False) -> list[bytes]:
    if not text:
        return []
    return (text.translate(_LOWER) if lower else text).split()


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit (reflected, polynomial 0xEDB88320)."""
    bits = (f"flatten(list_transform(range(1, length({text}) + 1), lambda i: list_transform(range(0, 8), "
            f"lambda k: ((ascii(substr({text}, i::INT, 1)) >> k::INT) & 1)::BIGINT)))")
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), "
            "lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295)")

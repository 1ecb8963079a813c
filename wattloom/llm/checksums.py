"""CRC-32 in DuckDB's SQL, which has no such function."""

from __future__ import annotations

import zlib


def _table() -> list[int]:
    """The table of the reflected polynomial, from the checksums of single bytes."""
    return [zlib.crc32(bytes([255 - k])) ^ 0xFF000000 for k in range(256)]


def crc32_sql(text: str) -> str:
    """An expression for the unsigned CRC-32 of a text's UTF-8 bytes."""
    step = f"xor(crc >> 8, ({_table()}::bigint[])[(xor(crc, byte) & 255) + 1])"
    spelled = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::bigint)"
    return f"xor(list_reduce({spelled}, lambda crc, byte: {step}, 4294967295::bigint), 4294967295::bigint)"

"""Pieces of SQL that several counterparts use."""

from __future__ import annotations


def _crc_table() -> list[int]:
    """The table of the reflected polynomial 0xEDB88320, one entry per byte."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def crc32(data: str) -> str:
    """crc32 of a list of bytes."""
    full = 0xFFFFFFFF
    step = f"xor(a >> 8, {_crc_table()}[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce(list_transform({data}, lambda z: z::bigint), lambda a, b: {step}, {full}::bigint), {full})"


def latin_bytes(text: str) -> str:
    """UTF-8 bytes of a text of code points below 256."""
    point = "unicode(c)"
    return f"flatten(list_transform(string_split({text}, ''), lambda c: case when {point} < 128 then [{point}] else [192 + {point} // 64, 128 + {point} % 64] end))"


def ascii_lower(text: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"translate({text}, '{upper}', '{upper.lower()}')"

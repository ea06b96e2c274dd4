"""Pieces of DuckDB SQL that several oracles share."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: one row with the byte table of the reversed CRC-32 polynomial, made by shifting
CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda a, b: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c
    FROM (SELECT unnest(range(256)) AS i)))"""


def crc32_of(hex_text: str) -> str:
    """The unsigned CRC-32 of the bytes whose upper-case hex text is ``hex_text``; needs ``crc_table`` in FROM."""
    return (f"CAST(xor(list_reduce(list_prepend(4294967295, list_transform(range(length({hex_text}) // 2), "
            f"lambda k: CAST('0x' || substr({hex_text}, 2 * k + 1, 2) AS BIGINT))), "
            "lambda crc, b: xor(crc >> 8, tab[(xor(crc, b) & 255) + 1])), 4294967295) AS BIGINT)")


def lowered(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"

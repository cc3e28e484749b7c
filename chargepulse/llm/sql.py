"""Pieces of DuckDB SQL that several oracles share."""

_STEP = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"

#: A one-row relation: the 256 remainders of CRC-32, from its polynomial.
CRC_TABLE = ("SELECT list(v ORDER BY i) AS crc_table FROM "
             f"(SELECT i, list_reduce(list_prepend(i, range(8)), lambda x, y: {_STEP}) AS v FROM range(256) r(i))")


def crc32_of(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string expression, where ``crc_table`` is in scope."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
            "lambda x, y: xor(x >> 8, crc_table[1 + (xor(x, y) & 255)])), 4294967295)")

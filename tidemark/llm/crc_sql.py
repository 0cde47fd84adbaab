"""CRC-32 of decimal numbers in DuckDB SQL, bit by bit from a table of the 256 bytes."""

#: Common table expressions; the last, ``crc``, has one row with the list ``v``.
CRC = f"""b0 AS (SELECT CAST(range AS BIGINT) AS b, CAST(range AS BIGINT) AS v FROM range(256)),
{", ".join(f"b{k + 1} AS (SELECT b, xor(v >> 1, 3988292384 * (v & 1)) AS v FROM b{k})" for k in range(8))},
crc AS (SELECT list(v ORDER BY b) AS v FROM b8)"""


def crc32(number: str) -> str:
    """Unsigned CRC-32 of a number's decimal text, or null; ``crc`` must be among the tables."""
    codes = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))"
    step = "xor(a >> 8, list_extract(crc.v, CAST(xor(a & 255, c) + 1 AS BIGINT)))"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, c: {step}))"

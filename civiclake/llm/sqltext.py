"""Fragments of the SQL that queries are checked against."""

#: CRC-32 of a decimal number, bit by bit; ``{0}`` is its text.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split({0}, '')]),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, i: xor(r // 2, (r % 2) * 3988292384))), 4294967295)"""

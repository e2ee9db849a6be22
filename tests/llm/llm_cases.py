"""Rows that every operator has to take."""

# Null and empty texts, ties and repeated rows, a null id, other scripts, and
# a text far longer than the rest.
ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (5, "one"), (None, "no id here"), (6, "café 日本 😀 ﬁ"),
       (7, "word " * 30_000), (8, "x" * 60_000), (9, "a b c d e f g h"), (10, "a b c d e f g h"),
       (11, "A B C D E F G H"), (12, "a▁b  c"), (13, "\x00 nul \r\n line")]

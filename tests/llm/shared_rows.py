"""Constants that the tests of the corpus operators share."""

SMALL = "/root/testdata/sf0.001"

#: Rows that every operator must bear: nulls, empty, blank, ties, repeated rows, long texts.
ODD = [
    (1, None, None),
    (2, "", "a"),
    (3, " \t\n ", "a"),
    (4, "one two three four five six", "b"),
    (4, "one two three four five six", "b"),
    (5, "one two three four five six", None),
    (None, "no id here at all", "b"),
    (6, "x" * 60000 + "\n" + "long words " * 3000, "c"),
    (7, "é ü 中文 😀\r\nsecond line\x00 end", "c"),
]

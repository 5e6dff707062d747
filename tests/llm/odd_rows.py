#: Nulls, empty and blank texts, ties, repeated rows, a long text, and one that is not ASCII.
ODD = [
    (None, "one two three four five six seven"),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (4, "one"),
    (5, "Été à la plage \U0001f600 ß"),
    (6, "word " * 20_000),
    (7, "one two three four five six seven"),
]

"""Rows that every operator must take."""

LONG = " ".join(f"word{i % 97}x{i}" for i in range(40_000))
#: nulls, empty and blank texts, ties, repeated rows, a very long text
AWKWARD = [
    (1, None, None, None), (2, "", "en", "src0"), (3, " \n\t ", None, "src1"), (4, "Hello world again", "en", None),
    (4, "Hello world again", "en", None), (None, "no id here at all my friend", "en", "src0"), (6, LONG, "en", "src0"),
    (7, LONG + " tail", "en", "src0"), (8, "Ünïcode — 中文 😀 text", "de", "src2"), (9, "12345 !!! ???", None, "src3"),
    (-5, "Hello world again", "en", "src9"), (2**62 + 1, "big id", "en", "src0"),
]


def rows(df, *cols):
    """Collected rows as tuples (optionally selected columns)."""
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
